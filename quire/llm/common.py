"""What the operators of this subpackage share: tables, folds, checkpoints, batches of texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructField, StructType
from pyspark.sql.window import Window

FOLDS = 4
HELD_OUT = 2
ROWS_AT_ONCE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str) -> Column:
    """True for the fold that no model may learn from: crc32 of the id's text, mod 4, is 2."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % FOLDS == HELD_OUT


def kept_fold(doc_id: str) -> Column:
    """held_out() with a null id counted as not held out."""
    return F.coalesce(held_out(doc_id), F.lit(False))


def sampled(hashed: Column, share: Column) -> Column:
    """True for about that share of the values of a 64-bit hash, exactly for all from 1 on: the threshold is a whole long, so that any bound on the
    number of rows holds at any size of the table."""
    return (share >= 1) | (hashed < F.floor((share - 0.5) * float(1 << 64)).cast("decimal(20,0)"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset the session must be local (tests),
    and a temporary one is set."""
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or (known.get() if known.isDefined() else None)
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="quire-checkpoints-")
    if known.isEmpty():
        sc.setCheckpointDir(folder)
    return folder


def reliable(df: DataFrame) -> DataFrame:
    """df computed once and stored in the shared checkpoint folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, name: str) -> str:
    """name, or name with underscores after it, that no column of df has in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame) -> DataFrame:
    """df written as a Parquet table in the shared folder and read again: reliable() for rows with texts, which Parquet compresses."""
    folder = f"{shared_folder(df.sparkSession)}/quire-table-{uuid.uuid4().hex}"
    df.select(*[F.col(f"`{f.name}`").cast("string") if f.dataType == NullType() else F.col(f"`{f.name}`") for f in df.schema]).write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def numbered(df: DataFrame, order: Column, name: str) -> DataFrame:
    """df with a long column name: 0, 1, 2... in the order, which no two rows share. Rows are dealt out by ranges and numbered within
    each, and the counts of the ranges, as many as there are partitions, add up to offsets."""
    part = fresh(df, "_part")
    dealt = reliable(df.repartitionByRange(order).withColumn(part, F.spark_partition_id()))
    offsets, total = [], 0
    for r in sorted(dealt.groupBy(part).count().collect()):
        offsets += [F.lit(r[0]), F.lit(total)]
        total += r[1]
    before = F.element_at(F.create_map(*offsets), F.col(part)) if offsets else F.lit(0)
    return dealt.withColumn(name, (before + F.row_number().over(Window.partitionBy(part).orderBy(order)) - 1).cast("long")).drop(part)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt out over a fixed number of partitions, which adaptive execution leaves as they are: for few rows of which each gives many."""
    return df.repartition(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def in_batches(texts: Iterable[str], limit: int) -> Iterator[list[str]]:
    """Lists of texts of about limit characters each; a longer text is alone in its list."""
    batch: list[str] = []
    size = 0
    for text in texts:
        if batch and size + len(text) > limit:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text) + 1
    if batch:
        yield batch


def with_texts(df: DataFrame, text: str, fields: str, start: Callable[[], Callable[[list[str | None]], list]]) -> DataFrame:
    """df's columns but the text, and the fields ("name type, ..."), which a function of a batch's texts computes.

    start() runs once in each task and returns the function, which gives one array or list for each field. The other columns pass
    through as Arrow data, so their nulls and long integers stay as they are. A column of df with the name of a field is replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    added = StructType.fromDDL(fields)
    names = [c for c in df.columns if c != text and c not in added.names]
    rows = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias(fresh(df, "_text")))
    schema = StructType([*[StructField(f.name, f.dataType) for f in rows.schema.fields[:-1]], *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = start()
        types = to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                made = apply(part.column(len(names)).to_pylist())
                columns = [part.column(i).cast(types.field(i).type) for i in range(len(names))]
                columns += [pa.array(x, type=types.field(len(names) + i).type, from_pandas=False) for i, x in enumerate(made)]
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return rows.mapInArrow(run, schema)
