"""Vectors and collections: chunks become points, which are upserted by a deterministic id."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as T
from quire.plans import fulltext

# The offsets of the kinds' indices and the dimensions of the models.
OFFSETS = {"text": 0, "image": 100_000, "table": 200_000}
MODELS = (
    ("e5-small", "intfloat/multilingual-e5-small", "huggingface", 384),
    ("e5-base", "intfloat/multilingual-e5-base", "huggingface", 768),
    ("e5-large", "intfloat/multilingual-e5-large", "huggingface", 1024),
    ("minilm-l12", "sentence-transformers/paraphrase-multilingual-MiniLM-L12-v2", "huggingface", 384),
    ("gigachat-embed", "Embeddings", "gigachat", 1024),
    ("neuroapi-small", "text-embedding-3-small", "neuroapi", 1536),
    ("neuroapi-large", "text-embedding-3-large", "neuroapi", 3072),
)
API_CHARACTERS = 1900


def models(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MODELS), "model string, id string, provider string, dim int")


def dimension(model: str) -> int:
    for name, _, _, dim in MODELS:
        if name == model:
            return dim
    raise KeyError(f"no such model: {model}")


def hashed_vector(text: str, dim: int) -> np.ndarray:
    """A stand-in for a model: words hashed to signed places, unit length. It is deterministic and says nothing about meaning."""
    import zlib

    out = np.zeros(dim, np.float32)
    for word in text.lower().split():
        h = zlib.crc32(word.encode())
        out[h % dim] += 1 if h >> 31 else -1
    norm = np.linalg.norm(out)
    return out / norm if norm else out


PROVIDERS: dict[str, Callable[[list[str], int], list[np.ndarray]]] = {
    "huggingface": lambda texts, dim: [hashed_vector(t, dim) for t in texts],
    "gigachat": lambda texts, dim: [hashed_vector(t[:API_CHARACTERS], dim) for t in texts],
    "neuroapi": lambda texts, dim: [hashed_vector(t, dim) for t in texts],
}


def dense(chunks: DataFrame, model: str = "e5-small", text: str = "embedding_text", batch: int = 32) -> DataFrame:
    """chunks with dense (array of float), by the model's provider, which is set up once in each task. E5 models read "passage: " first."""
    dim, provider = dimension(model), next(p for m, _, p, _ in MODELS if m == model)
    prefix = "passage: " if model.startswith("e5") else ""

    @F.pandas_udf("array<float>")
    def embed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = PROVIDERS[provider]
        for texts in parts:
            full = [t if t.startswith(prefix) else prefix + t for t in texts.fillna("")]
            vectors = [v for k in range(0, len(full), batch) for v in run(full[k : k + batch], dim)]
            if len(vectors) != len(full):
                raise ValueError(f"{len(full)} texts, but {len(vectors)} vectors")
            yield pd.Series(vectors)

    return chunks.withColumn("dense", embed(text))


def unit(vector):
    """An array column at unit length; a zero vector stays."""
    norm = F.sqrt(F.aggregate(F.transform(vector, lambda x: x.cast("double") * x), F.lit(0.0), lambda a, x: a + x))
    return F.when(norm > 0, F.transform(vector, lambda x: (x / norm).cast("float"))).otherwise(vector)


def points(chunks: DataFrame, kind: str = "text", mode: str = "compat") -> DataFrame:
    """chunks (book_name, source_file, chunk_index, text, headers, page_numbers, ...) as points: id, text to embed, and payload.

    The index counts the chunks of a book by file and chunk_index, which counts from 0 in each file, from the kind's offset. Page numbers are strings; fields that are empty are null.
    """
    # Files are numbered by their counts alone: no text takes part in a window.
    sizes = chunks.groupBy("book_name", "source_file").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("book_name").orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(F.col("book_name").alias("_book"), F.col("source_file").alias("_file"), F.coalesce(before, F.lit(0)).alias("_start"))
    joined = chunks.join(starts, F.col("book_name").eqNullSafe(F.col("_book")) & F.col("source_file").eqNullSafe(F.col("_file")))
    d = joined.withColumn("idx", (F.col("_start") + F.col("chunk_index") + OFFSETS[kind]).cast("int"))
    optional = [F.nullif(F.col(c), F.lit("")).alias(c) for c in ("table_id", "figure_id", "author", "title", "year") if c in chunks.columns]
    lists = [F.when(F.size(c) > 0, F.col(c)).alias(c) for c in ("table_refs", "figure_refs") if c in chunks.columns]
    payload = F.struct(
        "book_name", "source_file", F.lit(kind).alias("chunk_type"), "text", F.transform("page_numbers", lambda x: x.cast("string")).alias("page_numbers"), "full_content", *optional, *lists
    )
    return d.select(T.point_id(F.col("book_name"), F.col("idx"), F.col("text")).alias("id"), "idx", T.embedding_text(F.col("text"), F.col("headers"), mode).alias("embedding_text"), payload.alias("payload"))


def image_points(described: DataFrame, mode: str = "compat") -> DataFrame:
    """described (book_name, image, description) as points of the images' kind, by name within their book; the text is the description."""
    by_name = F.row_number().over(Window.partitionBy("book_name").orderBy("image"))
    light = described.select("book_name", "image").distinct().withColumn("chunk_index", (by_name - 1).cast("int"))
    named = T.author_and_title(F.col("book_name"))
    rows = described.join(light, ["book_name", "image"]).select(
        "book_name", F.lit("images").alias("source_file"), "chunk_index", F.col("description").alias("text"), F.lit(None).cast("map<int,string>").alias("headers"),
        F.array().cast(f"array<{T.PAGE}>").alias("page_numbers"), F.col("description").alias("full_content"), named.author.alias("author"), named.title.alias("title"),
    )
    return points(rows, "image", mode)


def vector_run(points: DataFrame, model: str, with_sparse: bool = True) -> DataFrame:
    """Points of any kind with their vectors. A provider that gives another number of vectors than it got texts ends the run. The sparse ones are weighted by
    the frequencies of words in these points."""
    d = dense(points, model)
    return fulltext.with_sparse(d) if with_sparse else d


def upserted(old: DataFrame, new: DataFrame, seq: str | None = None) -> DataFrame:
    """old with the points of new in place of those with their ids; of points of new with one id the last by seq, then by their content. Nothing is deleted."""
    content = F.to_json(F.struct(*new.columns)).desc()
    order = Window.partitionBy("id").orderBy(*([F.desc(seq)] if seq else []), content)
    last = new.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")
    return old.join(last.select("id"), "id", "left_anti").unionByName(last)


def dimension_check(points: DataFrame, model: str, vector: str = "dense") -> DataFrame:
    """(model, wanted, least, largest, fits)."""
    wanted = dimension(model)
    d = points.agg(F.min(F.size(vector)).alias("least"), F.max(F.size(vector)).alias("largest"))
    return d.select(F.lit(model).alias("model"), F.lit(wanted).alias("wanted"), "least", "largest", ((F.col("least") == wanted) & (F.col("largest") == wanted)).alias("fits"))


class Collections:
    """Collections as folders of Parquet under one root; a snapshot is a copy under its name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self.hadoop.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.conf)

    def names(self) -> list[str]:
        fs = self._fs()
        return sorted(s.getPath().getName() for s in fs.listStatus(self._path())) if fs.exists(self._path()) else []

    def _current(self, name: str) -> str | None:
        fs, at = self._fs(), self._path(name, "versions")
        found = sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []
        whole = [v for v in found if fs.exists(self._path(name, "versions", v, "_SUCCESS"))]  # a write that failed leaves its folder without one
        self._next = int(found[-1]) + 1 if found else 0
        return f"{self.root}/{name}/versions/{whole[-1]}" if whole else None

    def write(self, name: str, points: DataFrame, recreate: bool = False) -> None:
        """Upserts points into a new version; the last version is read, never overwritten."""
        now = self._current(name)
        out = points if recreate or now is None else upserted(self.spark.read.parquet(now), points)
        out.write.parquet(f"{self.root}/{name}/versions/{self._next:08d}")

    def read(self, name: str) -> DataFrame:
        now = self._current(name)
        if now is None:
            raise KeyError(f"no such collection: {name}")
        return self.spark.read.parquet(now)

    def info(self, name: str) -> dict:
        df = self.read(name)
        return {"name": name, "points": df.count(), "columns": df.columns}

    def delete(self, name: str) -> bool:
        return self._fs().delete(self._path(name), True)

    def snapshot(self, name: str, label: str) -> None:
        self.read(name).write.parquet(f"{self.root}/{name}/snapshots/{label}")

    def snapshots(self, name: str) -> list[str]:
        fs, at = self._fs(), self._path(name, "snapshots")
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def restore(self, name: str, label: str) -> None:
        self.write(name, self.spark.read.parquet(f"{self.root}/{name}/snapshots/{label}"), recreate=True)

    def drop_snapshot(self, name: str, label: str) -> bool:
        return self._fs().delete(self._path(name, "snapshots", label), True)
