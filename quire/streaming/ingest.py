"""Incremental ingest of page files: a file stream whose batches go through the same stages. An extension; there is no event time, so no watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.sources.files import _parts, book_of


def ingest(spark: SparkSession, root: str, stage: str, out: str, checkpoint: str, apply: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Starts a query that takes new files of root/<book>/<stage> once, applies the stages, and writes each batch as its own part of out.

    A batch that is run again after a failure replaces its part.
    """
    pages = spark.readStream.schema("value string").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(f"{root}/*/{stage}")
    path = F.input_file_name()
    pages = pages.select(book_of(path, stage).alias("book_name"), _parts(path)["file"].alias("file"), F.col("value").alias("text"))

    def batch(df: DataFrame, number: int) -> None:
        apply(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
