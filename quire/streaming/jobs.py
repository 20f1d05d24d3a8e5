"""Remote conversion jobs: a state machine for each job with timers in event time, and the same outcomes from a table of events.

Events (job, at, seq, kind, detail) come from whoever speaks to the server; the machine says what to do next (submit, poll, fetch) and how each job ends
(done, failed). A job's events are put in order by time before the machine sees them, so the order of arrival within the watermark does not matter.

Kinds of events: wanted, submitted, submit_error, rejected, status (detail pending, processing, done, or error and its message), poll_error, result
(detail is the text) and result_error. Others, and those that a job's phase does not ask for, change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "job string, at long, action string, detail string"
EVENT = "at long, seq long, kind string, detail string"
STATE = "phase string, started long, failures int, due long, over long"


@dataclass(frozen=True)
class Limits:
    """Milliseconds and counts. The defaults are those of the service's client."""

    poll: int = 5_000  # between a status and the next question
    total: int = 600_000  # from the submission until the job must be done
    errors: int = 10  # failed questions in a row
    attempts: int = 3  # to submit, and to fetch
    pauses: tuple[int, ...] = (10_000, 20_000, 30_000)  # before the next attempt
    retain: int = 86_400_000  # how long a job that is over is remembered, so that its late events are known as such


TIMEOUT, NO_ANSWER, NOT_SENT, NOT_FETCHED, EMPTY = "timeout", "too many failed questions", "not sent", "not fetched", "empty result"


@dataclass(frozen=True)
class Job:
    phase: str = "new"  # new, submitting, waiting, fetching, over
    started: int = -1
    failures: int = 0
    due: int = -1  # when the next action of the phase is to be asked for
    over: int = -1


Action = tuple[int, str, str | None]


def ended(job: Job, at: int, how: str, detail: str | None) -> tuple[Job, list[Action]]:
    return replace(job, phase="over", due=-1, over=at), [(at, how, detail)]


def failed_attempt(job: Job, at: int, limits: Limits, why: str) -> tuple[Job, list[Action]]:
    failures = job.failures + 1
    if failures >= limits.attempts:
        return ended(job, at, "failed", why)
    return replace(job, failures=failures, due=at + limits.pauses[min(failures, len(limits.pauses)) - 1]), []


def stepped(job: Job, at: int, kind: str, detail: str | None, limits: Limits) -> tuple[Job, list[Action]]:
    """The job after an event, and what follows from it."""
    if job.phase == "new" and kind == "wanted":
        return replace(job, phase="submitting"), [(at, "submit", None)]
    if job.phase in ("new", "submitting"):
        if kind == "submitted":
            return Job("waiting", at, 0, at), []
        if kind == "submit_error":
            return failed_attempt(replace(job, phase="submitting"), at, limits, NOT_SENT)
        if kind == "rejected":
            return ended(job, at, "failed", detail)
    elif job.phase == "waiting":
        if kind == "status":
            if detail == "done":
                return replace(job, phase="fetching", failures=0, due=-1), [(at, "fetch", None)]
            if detail is not None and detail.startswith("error"):
                return ended(job, at, "failed", detail)
            return replace(job, failures=0, due=at + limits.poll), []
        if kind == "poll_error":
            if job.failures + 1 >= limits.errors:
                return ended(job, at, "failed", NO_ANSWER)
            return replace(job, failures=job.failures + 1, due=at + limits.poll), []
    elif job.phase == "fetching":
        if kind == "result":
            return ended(job, at, "done", detail) if detail else ended(job, at, "failed", EMPTY)
        if kind == "result_error":
            return failed_attempt(job, at, limits, NOT_FETCHED)
    return job, []


ASKS = {"submitting": "submit", "waiting": "poll", "fetching": "fetch"}


def advanced(job: Job, events: list[tuple], until: int, limits: Limits) -> tuple[Job, list[Action], list[tuple]]:
    """The job at a time, what happened on the way, and the events that are still to come. Of one time events come first, then questions, then the end of the time."""
    events, out = sorted(events, key=lambda e: e[:2]), []
    while True:
        deadline = job.started + limits.total if job.phase == "waiting" else None
        near = [t for t in (events[0][0] if events else None, job.due if job.due >= 0 else None, deadline) if t is not None]
        if not near or min(near) > until:
            return job, out, events
        at = min(near)
        if events and events[0][0] == at:
            _, _, kind, detail = events.pop(0)
            job, made = stepped(job, at, kind, detail, limits)
        elif job.due == at:
            job, made = replace(job, due=-1), [(at, ASKS[job.phase], None)]
        else:
            job, made = ended(job, at, "failed", TIMEOUT)
        out += made


class JobMachine(StatefulProcessor):
    def __init__(self, limits: Limits) -> None:
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", STATE)
        self.events = handle.getListState("events", EVENT)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found = [(r.ms, r.seq, r.kind, r.detail) for r in rows]
        self.events.appendList(found)
        for at in {e[0] for e in found}:
            self.handle.registerTimer(at)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        job = Job(*self.job.get()) if self.job.exists() else Job()
        events = [tuple(e) for e in self.events.get()] if self.events.exists() else []
        until = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        if job.phase == "over" and job.over + self.limits.retain <= until and not events:
            self.job.clear()
            return
        job, made, left = advanced(job, events, until, self.limits)
        self.job.update((job.phase, job.started, job.failures, job.due, job.over))
        if left:
            self.events.put(left)
        else:
            self.events.clear()
        for at in (job.due, job.started + self.limits.total if job.phase == "waiting" else -1, job.over + self.limits.retain if job.phase == "over" else -1):
            if at >= 0:
                self.handle.registerTimer(at)
        for at, action, detail in made:
            yield Row(job=key[0], at=at, action=action, detail=detail)

    def close(self) -> None:
        pass


def actions(events: DataFrame, delay: str = "10 seconds", limits: Limits | None = None) -> DataFrame:
    """(job, at, action, detail) of a stream of events, whose at is a timestamp; what comes out has milliseconds. delay bounds how late events come."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    timed = events.withWatermark("at", delay).withColumn("ms", F.unix_millis("at"))
    return timed.groupBy("job").transformWithState(JobMachine(limits or Limits()), OUTPUT, "Append", "EventTime")


def outcomes(events: DataFrame, limits: Limits | None = None) -> DataFrame:
    """(job, at, outcome, detail) of a table of events with at in milliseconds, taken as complete: done, failed, or the phase in which a job still is, with a null time.

    The phases end at the first event that ends them, which windows over each job's events find; only times and kinds are looked at.
    """
    limits = limits or Limits()
    place = F.struct("at", "seq")
    d = events.select("job", "at", "seq", "kind", "detail").withColumn("place", place)
    by_job = Window.partitionBy("job")
    upto = by_job.orderBy("at", "seq").rowsBetween(Window.unboundedPreceding, 0)
    first = lambda cond: F.min(F.when(cond, F.col("place"))).over(by_job)
    is_ = lambda *kinds: F.col("kind").isin(*kinds)
    nth = lambda cond, n: cond & (F.count_if(cond).over(upto) == n)
    d = d.withColumn("unsent", first(is_("rejected"))).withColumn("third", nth(is_("submit_error"), limits.attempts)).withColumn("third", first(F.col("third")))
    d = d.withColumn("refused", F.least("unsent", "third")).withColumn("sent", first(is_("submitted")))
    d = d.withColumn("sent", F.when(F.col("refused").isNull() | (F.col("sent") < F.col("refused")), F.col("sent")))
    waits = (F.col("place") > F.col("sent")) & (F.col("at") <= F.col("sent.at") + limits.total)
    d = d.withColumn("asked", F.coalesce(waits, F.lit(False))).withColumn("answers", F.count_if(F.col("asked") & is_("status")).over(upto))
    row = Window.partitionBy("job", "answers").orderBy("at", "seq").rowsBetween(Window.unboundedPreceding, 0)
    lost = F.col("asked") & is_("poll_error")
    d = d.withColumn("lost", lost & (F.count_if(lost).over(row) == limits.errors))
    says: Column = F.col("asked") & is_("status") & F.coalesce(F.col("detail").startswith("error"), F.lit(False))
    d = d.withColumn("broken", first(F.col("lost") | says)).withColumn("ready", first(F.col("asked") & is_("status") & (F.col("detail") == "done")))
    d = d.withColumn("ready", F.when(F.col("broken").isNull() | (F.col("ready") < F.col("broken")), F.col("ready")))
    d = d.withColumn("fetching", F.coalesce(F.col("place") > F.col("ready"), F.lit(False)))
    got = F.col("fetching") & is_("result")
    d = d.withColumn("unread", nth(F.col("fetching") & is_("result_error"), limits.attempts))
    d = d.withColumn("last", F.when(F.col("ready").isNotNull(), first(got | F.col("unread"))))
    end = F.when(F.col("sent").isNull(), F.col("refused")).when(F.col("ready").isNull(), F.col("broken")).otherwise(F.col("last"))
    d = d.withColumn("end", end)
    here = F.when(F.col("place") == F.col("end"), F.struct("kind", "detail"))
    one = d.groupBy("job").agg(F.max(here).alias("e"), *[F.first(c).alias(c) for c in ("sent", "ready", "end")], F.max(is_("wanted", "submit_error")).alias("tried"))
    kind = F.col("e.kind")
    timed_out = F.col("sent").isNotNull() & F.col("ready").isNull() & F.col("end").isNull()
    done = (kind == "result") & F.coalesce(F.col("e.detail") != "", F.lit(False))
    open_ = F.when(F.col("ready").isNotNull(), "fetching").when(F.col("tried"), "submitting").otherwise("new")
    outcome = F.when(timed_out, "failed").when(F.col("end").isNull(), open_).when(done, "done").otherwise("failed")
    why = (
        F.when(timed_out, TIMEOUT).when(kind.isin("rejected", "status"), F.col("e.detail")).when(kind == "submit_error", NOT_SENT).when(kind == "poll_error", NO_ANSWER)
        .when(kind == "result_error", NOT_FETCHED).when(done, F.col("e.detail")).when(kind == "result", EMPTY)
    )
    return one.select("job", F.when(timed_out, F.col("sent.at") + limits.total).otherwise(F.col("end.at")).alias("at"), outcome.alias("outcome"), why.alias("detail"))
