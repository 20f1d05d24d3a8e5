"""Conversion jobs: the machine's rules, batch outcomes against the machine, a stream of replayed events against both."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quire import queries
from quire.streaming import jobs

SF = "/root/testdata/sf0.001"
FAR = 10**12


def played(events, limits=None, until=FAR):
    return jobs.advanced(jobs.Job(), list(events), until, limits or jobs.Limits())[:2]


def test_a_job_that_goes_well():
    job, out = played([(0, 1, "wanted", "f.pdf"), (900, 2, "submitted", None), (950, 3, "status", "pending"), (6000, 4, "poll_error", None), (12_000, 5, "status", "done"), (13_000, 6, "result", "text")])
    assert out == [(0, "submit", None), (900, "poll", None), (5950, "poll", None), (11_000, "poll", None), (12_000, "fetch", None), (13_000, "done", "text")] and job.phase == "over"


def test_limits():
    start = [(0, 1, "submitted", None)]
    assert played(start)[1][-1] == (600_000, "failed", jobs.TIMEOUT)
    lost = [(5_000 * k, 9 + k, "poll_error", None) for k in range(1, 11)]
    assert played(start + lost)[1][-1] == (50_000, "failed", jobs.NO_ANSWER)
    assert played(start + lost[:9] + [(48_000, 99, "status", "processing")] + [(50_000 + k, 100 + k, "poll_error", None) for k in range(9)])[1][-1] == (600_000, "failed", jobs.TIMEOUT)
    assert played(start + [(600_000, 2, "status", "done")], until=600_000)[0].phase == "fetching"  # an answer of the last moment counts
    assert played(start + [(600_001, 2, "status", "done")])[0].phase == "over"
    assert played([(k, k, "submit_error", None) for k in (1, 2)])[1] == [(20_002, "submit", None)]
    assert played([(k, k, "submit_error", None) for k in (1, 2, 3)])[1][-1] == (3, "failed", jobs.NOT_SENT)
    assert played([(1, 1, "rejected", "HTTP 413")])[1] == [(1, "failed", "HTTP 413")]
    ready = [*start, (10, 2, "status", "done")]
    assert played([*ready, (20, 3, "result", "")])[1][-1] == (20, "failed", jobs.EMPTY)
    assert played([*ready, *[(20 + k, 3 + k, "result_error", None) for k in range(3)]])[1][-1] == (22, "failed", jobs.NOT_FETCHED)
    assert played([*start, (10, 2, "status", "error: no GPU")])[1][-1] == (10, "failed", "error: no GPU")


def random_events(seed, n_jobs=40):
    rng, rows = random.Random(seed), []
    for j in range(n_jobs):
        at = rng.randint(0, 5000)
        for seq in range(rng.randint(1, 30)):
            kind = rng.choices(["wanted", "submitted", "submit_error", "rejected", "status", "poll_error", "result", "result_error", "other"], [1, 3, 2, 0.3, 6, 9, 2, 2, 1])[0]
            detail = {"status": rng.choices(["pending", "processing", "done", "error: x", None], [3, 3, 1, 0.5, 1])[0], "result": rng.choice(["text", "", None]), "rejected": "HTTP 400"}.get(kind)
            rows.append((f"j{j}", at, seq, kind, detail))
            at += rng.choice([0, 0, 1, 3000, 5000, 90_000])
    return rows


def by_machine(rows, limits):
    out = {}
    for job in {r[0] for r in rows}:
        state, made = played([r[1:] for r in rows if r[0] == job], limits)
        end = [m for m in made if m[1] in ("done", "failed")]
        out[job] = (end[0][0], end[0][1], end[0][2]) if end else (None, state.phase, None)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_outcomes_as_the_machine_finds_them(spark, seed):
    rows, limits = random_events(seed), jobs.Limits(errors=3)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "job string, at long, seq long, kind string, detail string")
    assert {r.job: (r.at, r.outcome, r.detail) for r in jobs.outcomes(df, limits).collect()} == by_machine(rows, limits)


def test_outcomes_of_the_events_table(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    rows = [tuple(r) for r in queries.job_events(spark, SF).collect()]
    found = {r.job: (r.ms, r.outcome, r.detail) for r in queries.QUERIES["conversion_jobs"](spark, SF).collect()}
    assert found == by_machine(rows, jobs.Limits(errors=4)) and len({o for _, o, _ in found.values()}) >= 3


def test_a_stream_of_replayed_events(spark, tmp_path):
    """Events come in several batches, out of order within the delay; the actions are those of the machine, each once."""
    limits, zero = jobs.Limits(errors=3, retain=10_000_000), datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = sorted(random_events(9, 12), key=lambda r: r[1])
    mixed = [r for k in range(0, len(rows), 10) for r in random.Random(k).sample(rows[k : k + 10], len(rows[k : k + 10]))]
    source = tmp_path / "events"
    parts = [mixed[k : k + 60] for k in range(0, len(mixed), 60)] + [[("last", 10**9, 0, "other", None)], [("last", 2 * 10**9, 1, "other", None)]]
    for k, part in enumerate(parts):
        df = spark.createDataFrame([(j, zero + timedelta(milliseconds=at), s, kind, d) for j, at, s, kind, d in part], "job string, at timestamp, seq long, kind string, detail string")
        df.coalesce(1).write.mode("append").parquet(str(source))
        for f in source.glob("*.parquet"):
            if not f.name.startswith("n"):
                f.rename(source / f"n{k:03d}.parquet")
                os.utime(source / f"n{k:03d}.parquet", (10**9 + k, 10**9 + k))
    events = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    query = jobs.actions(events, "20 minutes", limits).writeStream.format("memory").queryName("job_actions").outputMode("append").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None
    base = int(zero.timestamp() * 1000)
    found = sorted((r.job, r.at - base, r.action, r.detail or "") for r in spark.table("job_actions").filter("job <> 'last'").collect())
    want = sorted((job, at, action, detail or "") for job in {r[0] for r in rows} for at, action, detail in played([r[1:] for r in rows if r[0] == job], limits)[1])
    assert found == want
    ends = {j: (at, a) for j, at, a, _ in found if a in ("done", "failed")}
    table = spark.createDataFrame(rows, "job string, at long, seq long, kind string, detail string")
    assert ends == {r.job: (r.at, r.outcome) for r in jobs.outcomes(table, limits).filter(F.col("outcome").isin("done", "failed")).collect()}
