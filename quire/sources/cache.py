"""A read-through cache of a store: contents in a Parquet table by their hash, and a manifest of the versions of each path.

A file whose path, size and time the manifest has is read from the cache; only the others are fetched, and a content that some path had before is
not stored again. Manifest and contents are only added to, contents first, so a run that fails in between leaves no entry without its content.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.sources import store
from quire.sources.shared import computed

MANIFEST = "path string, bytes long, modified timestamp, sha256 string, fetched_at timestamp"
OBJECTS = "sha256 string, content binary"


def table(spark: SparkSession, cache: str, name: str, schema: str) -> DataFrame:
    """A table of the cache, empty before the first run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{cache}/{name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{cache}/{name}")


def manifest(spark: SparkSession, cache: str) -> DataFrame:
    return table(spark, cache, "manifest", MANIFEST)


def misses(listed: DataFrame, cache: str) -> DataFrame:
    """The files of a listing of which the cache has no version of this size and time."""
    known = manifest(listed.sparkSession, cache).select("path", "bytes", "modified").distinct()
    return listed.join(known, ["path", "bytes", "modified"], "left_anti")


def filled(listed: DataFrame, cache: str, root: str, **options: str) -> int:
    """Fetches what the cache misses of a listing, and says how many files that were."""
    spark = listed.sparkSession
    wanted = misses(listed, cache).select("path", "bytes", "modified")
    if wanted.isEmpty():
        return 0
    got = store.fetched(wanted, root, **options).withColumn("sha256", F.sha2("content", 256))
    run = f"{cache}/incoming-{uuid.uuid4().hex}"
    # The fetched contents are written once and read for both tables, so no file is asked for twice.
    got.write.parquet(run)
    got = spark.read.parquet(run)
    new = got.join(table(spark, cache, "objects", OBJECTS).select("sha256"), "sha256", "left_anti")
    new.groupBy("sha256").agg(F.first("content").alias("content")).write.mode("append").parquet(f"{cache}/objects")
    entries = got.select("path", "bytes", "modified", "sha256", F.current_timestamp().alias("fetched_at"))
    entries.write.mode("append").parquet(f"{cache}/manifest")
    fetched = got.count()
    path = spark._jvm.org.apache.hadoop.fs.Path(run)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return fetched


def read_through(listed: DataFrame, cache: str, root: str, **options: str) -> DataFrame:
    """listed with sha256 and content, from the cache, after what it misses was fetched."""
    listed = computed(listed)  # the store's folders are listed once
    filled(listed, cache, root, **options)
    spark = listed.sparkSession
    latest = Window.partitionBy("path", "bytes", "modified").orderBy(F.desc("fetched_at"), "sha256")
    known = manifest(spark, cache).withColumn("_n", F.row_number().over(latest)).filter("_n = 1").select("path", "bytes", "modified", "sha256")
    return listed.join(known, ["path", "bytes", "modified"]).join(table(spark, cache, "objects", OBJECTS), "sha256").select(*listed.columns, "sha256", "content")


def expired(spark: SparkSession, cache: str, versions: int = 1) -> DataFrame:
    """(path, sha256, fetched_at) of the entries beyond the latest versions of each path."""
    latest = Window.partitionBy("path").orderBy(F.desc("fetched_at"), F.desc("modified"), "sha256")
    return manifest(spark, cache).withColumn("_n", F.row_number().over(latest)).filter(F.col("_n") > versions).select("path", "sha256", "fetched_at")


def compacted(spark: SparkSession, cache: str, target: str, versions: int = 1) -> None:
    """Writes the cache without expired entries, and without contents that no entry names, as a cache of its own."""
    latest = Window.partitionBy("path").orderBy(F.desc("fetched_at"), F.desc("modified"), "sha256")
    kept = manifest(spark, cache).withColumn("_n", F.row_number().over(latest)).filter(F.col("_n") <= versions).drop("_n")
    table(spark, cache, "objects", OBJECTS).join(kept.select("sha256").distinct(), "sha256", "left_semi").write.parquet(f"{target}/objects")
    kept.write.parquet(f"{target}/manifest")
