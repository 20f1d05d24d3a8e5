"""Runs that can be watched and cancelled: counters by observed metrics, progress by the tasks of tagged jobs."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Run:
    """Jobs started inside `with run:` (in that thread) belong to the run; other threads may ask for its progress or cancel it.

    A cancelled write leaves what its committer leaves: tables without the files of this run, and stores as they were.
    """

    def __init__(self, spark: SparkSession, name: str = "run") -> None:
        self.sc, self.tag, self.cancelled = spark.sparkContext, f"quire-{name}-{uuid.uuid4().hex}", False
        self.observations: dict[str, Observation] = {}
        self.over = threading.Event()

    def __enter__(self) -> Run:
        self.over.clear()
        self.sc.addJobTag(self.tag)
        return self

    def __exit__(self, *_: object) -> None:
        self.over.set()
        self.sc.removeJobTag(self.tag)

    def cancel(self) -> None:
        """Stops the run's jobs, and those that it starts before it ends, as a write may consist of several."""
        self.cancelled = True
        self.sc.cancelJobsWithTag(self.tag)
        threading.Thread(target=self._cancel_later, daemon=True).start()

    def _cancel_later(self) -> None:
        while not self.over.wait(0.2):
            self.sc.cancelJobsWithTag(self.tag)

    def check(self) -> None:
        """Raises if the run was cancelled: for runs of several jobs, between them."""
        if self.cancelled:
            raise InterruptedError(f"cancelled: {self.tag}")

    def progress(self) -> tuple[int, int]:
        """(done, all): tasks of the run's jobs so far. Skipped stages, whose results are there already, do not count."""
        tracker = self.sc._jsc.sc().statusTracker()
        done = total = 0
        for job in tracker.getJobIdsForTag(self.tag):
            info = tracker.getJobInfo(job)
            for stage in info.get().stageIds() if info.isDefined() else []:
                found = tracker.getStageInfo(stage)
                if found.isDefined() and found.get().currentAttemptId() >= 0:
                    done, total = done + found.get().numCompletedTasks(), total + found.get().numTasks()
        return done, total

    def counted(self, df: DataFrame, name: str = "rows", error: str | None = "error", **more: Column) -> DataFrame:
        """df, of which an action counts successes, errors and more on its way; counters() has them when it is over."""
        failed = F.col(error).isNotNull() if error else F.lit(False)
        self.observations[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return df.observe(self.observations[name], F.count_if(~failed).alias("successes"), F.count_if(failed).alias("errors"), *[c.alias(k) for k, c in more.items()])

    def counters(self) -> dict[str, dict]:
        """The counters by name; it waits for actions that have not ended."""
        return {name: o.get for name, o in self.observations.items()}
