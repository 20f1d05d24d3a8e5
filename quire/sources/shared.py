"""The folder that driver and executors share, and tables that are computed once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which is also made the checkpoint folder; a local session without one gets a temporary one."""
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    shared = sc.getConf().get("spark.checkpoint.dir") or (known.get() if known.isDefined() else None)
    if not shared:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="quire-shared-")
    if known.isEmpty():
        sc.setCheckpointDir(shared)
    return shared


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def computed(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder: for a small table that a plan uses many times."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
