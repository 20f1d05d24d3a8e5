"""Answers of models that are paid for once: they are stored by key and step before anything uses them, in batches that are whole or absent.

A batch is one file, put aside first and then named after its requests. A run asks only for what the log lacks; a task that is tried again finds the batches
that it wrote and asks for the rest, so a lost executor costs one batch for each of its tasks at most.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.plans import registry
from quire.sources import store

BATCH = 10  # answers that are stored at once
KEY = "book_name string, file string"
ENTRY = "step string, answer string, error string, asked_at timestamp"


def entries(spark: SparkSession, folder: str, key: str = KEY) -> DataFrame:
    """(key, step, answer, error, asked_at): every answer that was stored. Several of one key and step are those of failed runs and the last one."""
    schema = f"{key}, {ENTRY}"
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/answers")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{folder}/answers")


def settled(found: DataFrame, step: str, names: list[str]) -> DataFrame:
    """(key, answer, error): one entry for each key of a step, one without an error if there is one, else the latest."""
    own = found.filter(F.col("step") == step)
    best = F.min_by(F.struct("answer", "error"), F.struct(F.col("error").isNotNull().alias("a"), (-F.unix_micros("asked_at")).alias("b"), F.coalesce("answer", "error").alias("c")))
    return own.groupBy(*names).agg(best.alias("_r")).select(*names, "_r.*")


def missing(requests: DataFrame, folder: str, step: str, key: str = KEY) -> DataFrame:
    """The requests whose key has no answer of the step without an error."""
    names = StructType.fromDDL(key).names
    done = entries(requests.sparkSession, folder, key).filter((F.col("step") == step) & F.col("error").isNull()).select(*names).distinct()
    return requests.join(done, names, "left_anti")


def ask(requests: DataFrame, call: Callable[[str], str], folder: str, step: str, key: str = KEY, prompt: str = "prompt", batch: int = BATCH, pause: float = registry.FIRST_PAUSE) -> int:
    """Asks for the requests that the log misses, stores the answers, errors too, and says how many were asked for. Of requests with one key the first prompt counts."""
    names, columns = StructType.fromDDL(key).names, [*StructType.fromDDL(key).names, "_prompt"]
    open_ = missing(requests, folder, step, key).groupBy(*names).agg(F.min(prompt).alias("_prompt"))
    # The same rows come in the same order whenever a task is tried again, so its batches have the same names.
    dealt = open_.sortWithinPartitions(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = store.FolderStore({"root": folder})
        for found in batches:
            rows = found.select(columns).to_pylist()
            for at in range(0, len(rows), batch):
                part = rows[at : at + batch]
                name = hashlib.sha1(json.dumps([step, *part], default=str, sort_keys=True).encode()).hexdigest()
                yield pa.RecordBatch.from_arrays([pa.array([stored(kept, f"answers/{step}/{name}.json", part)], pa.int64())], names=["asked"])

    def stored(kept: store.FolderStore, path: str, part: list[dict]) -> int:
        if kept.has(path):
            return 0
        lines = []
        for row in part:
            answer, error = registry.asked(call, row.pop("_prompt"), pause)
            lines.append(json.dumps({**row, "step": step, "answer": answer, "error": error, "asked_at": datetime.now(timezone.utc).isoformat()}, default=str, ensure_ascii=False))
        aside = f"{store.STAGING}/{uuid.uuid4().hex}.json"
        kept.put(aside, ("\n".join(lines) + "\n").encode())
        if kept.has(path):  # the same batch of another attempt was faster
            kept.remove(aside)
        else:
            kept.move(aside, path)
        return len(part)

    return dealt.mapInArrow(run, "asked long").agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0]


def answered(requests: DataFrame, call: Callable[[str], str], folder: str, step: str, key: str = KEY, prompt: str = "prompt", batch: int = BATCH, pause: float = registry.FIRST_PAUSE) -> DataFrame:
    """requests with answer and error from the log, which was asked to have them all; reading the result again asks for nothing."""
    ask(requests, call, folder, step, key, prompt, batch, pause)
    names = StructType.fromDDL(key).names
    return requests.join(settled(entries(requests.sparkSession, folder, key), step, names), names)


def step_counts(spark: SparkSession, folder: str, key: str = KEY) -> DataFrame:
    """(step, answered, failed, asked): keys with an answer, keys with errors alone, and entries in all."""
    names = StructType.fromDDL(key).names
    by_key = entries(spark, folder, key).groupBy("step", *names).agg(F.max(F.col("error").isNull()).alias("fine"), F.count("*").alias("n"))
    return by_key.groupBy("step").agg(F.count_if("fine").alias("answered"), F.count_if(~F.col("fine")).alias("failed"), F.sum("n").alias("asked"))
