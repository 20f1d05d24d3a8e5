"""Resampling of documents by importance for a target distribution of hashed n-grams, by external sort-count.

A text's features are its words and its pairs of consecutive words. One pass over the texts writes the features' buckets as packed streams of 16-bit
numbers with the offsets of the documents in them. The streams are sorted and run-length encoded for the counts of corpus and target; the
logarithmic ratio of the two distributions is a bucket's gain. A second pass over the streams, not the texts, gathers gains and adds them up
by document. Gumbel noise from a hash of the id makes the highest scores a draw without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from quire.llm.common import fresh, numbered, stored

BUCKETS = 10_000
SHARE = 25  # per cent of the documents with enough words
LEAST_WORDS = 20
SEED = 7
SCALE = 1000
FEATURES_A_STREAM = 1 << 20
BYTES_AT_ONCE = 1 << 20

# Bytes of words: digits, letters in lower case and all that is not ASCII. The others part words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def bucket_stream(text: str, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """The buckets of a text's words and pairs of words, in pieces, as 16-bit numbers."""
    data = text.encode("utf-8", "replace").translate(_WORD_BYTES)
    crc = zlib.crc32
    before: int | None = None  # the checksum of the last word of the piece before
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= BYTES_AT_ONCE else data.find(b" ", at + BYTES_AT_ONCE)
        end = len(data) if end < 0 else end
        words = data[at:end].split()
        at = end
        if not words:
            continue
        ones = [crc(w) for w in words]
        pairs = [crc(b" " + w, c) for w, c in zip(words[1:], ones)]
        if before is not None:
            pairs.append(crc(b" " + words[0], before))
        before = ones[-1]
        yield (np.array(ones + pairs, np.uint32) % buckets).astype("<u2")


def streams(df: DataFrame, text: str, buckets: int = BUCKETS) -> DataFrame:
    """(rows, ends, stream), stored: the rows of df without their text, the place in the stream where each one's features end, and the stream. A stream
    takes rows until it has FEATURES_A_STREAM features."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if not 1 <= buckets <= 1 << 16:
        raise ValueError("buckets are numbered by 16 bits")
    names = [c for c in df.columns if c != text]
    source = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").cast("string").alias(fresh(df, "_text")))
    # Each column of the rows is a list of its own, so that nulls and types stay as they are.
    lists = [StructField(f"c{i}", ArrayType(f.dataType)) for i, f in enumerate(source.schema.fields[:-1])]
    schema = StructType([*lists, *StructType.fromDDL("ends array<long>, stream binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(schema)
        kept, ends, pieces, total = [], [], [], 0

        def flushed() -> pa.RecordBatch:
            rows = pa.Table.from_batches(kept).combine_chunks()
            columns = []
            for i in range(len(names)):
                column = rows.column(i).combine_chunks()
                column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column).cast(types.field(i).type))
            columns += [pa.array([ends], types.field(len(names)).type), pa.array([b"".join(pieces)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, schema=types)

        for batch in batches:
            bare = batch.select(list(range(len(names))))
            first = 0
            for i, value in enumerate(batch.column(len(names))):
                for piece in bucket_stream(value.as_py() or "", buckets):
                    pieces.append(piece.tobytes())
                    total += len(piece)
                ends.append(total)
                if total >= FEATURES_A_STREAM:
                    kept.append(bare.slice(first, i + 1 - first))
                    yield flushed()
                    kept, ends, pieces, total, first = [], [], [], 0, i + 1
            if first < batch.num_rows:
                kept.append(bare.slice(first))
        if ends:
            yield flushed()

    return stored(source.mapInArrow(run, schema).withColumn("at", F.monotonically_increasing_id()))


def run_lengths(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers of a stream and how often each occurs: sorted, then run-length encoded."""
    ordered = np.sort(stream, kind="stable")  # a radix sort for 16 bits
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)
    return ordered[starts], np.diff(np.append(starts, len(ordered)))


def counts(written: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in the streams. A task merges the runs of its streams, and Spark those of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                stream = np.frombuffer(value.as_buffer(), "<u2")
                for at in range(0, len(stream), 8 * FEATURES_A_STREAM):
                    keys, times = run_lengths(stream[at : at + 8 * FEATURES_A_STREAM])
                    total[keys] += times
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in written.select("stream").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The floored thousandfold logarithm of each bucket's share in the target over that in the corpus, with one more count for each bucket."""
    s, t, n = int(corpus.sum()), int(target.sum()), len(corpus)
    ratio = lambda own, aim: (float(aim + 1) * float(s + n)) / (float(own + 1) * float(t + n))
    return np.array([math.floor(SCALE * math.log(ratio(int(own), int(aim)))) for own, aim in zip(corpus, target)], np.int32)


def sums_by_document(stream: np.ndarray, ends: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """The sum of gains between the places where documents end. The stream is looked up in parts, so a long document needs no more memory."""
    starts = np.concatenate([[0], ends[:-1]])
    real = np.flatnonzero(ends > starts)
    own_starts, own_ends, own = starts[real], ends[real], np.zeros(len(real), np.int64)
    for low in range(0, len(stream), FEATURES_A_STREAM):
        high = min(low + FEATURES_A_STREAM, len(stream))
        a, b = np.searchsorted(own_ends, low, "right"), np.searchsorted(own_starts, high, "left")
        own[a:b] += np.add.reduceat(gain[stream[low:high]], np.maximum(own_starts[a:b], low) - low, dtype=np.int64)
    out = np.zeros(len(ends), np.int64)
    out[real] = own
    return out


def weighed(written: DataFrame, like: DataFrame, gain: np.ndarray) -> DataFrame:
    """The columns of like with n_features, weight and at, a number that no two rows share, for each document of the streams."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = like.columns
    schema = StructType([*like.schema.fields, *StructType.fromDDL("n_features long, weight long, at decimal(38,0)").fields])
    shared = like.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, types = shared.value, to_arrow_schema(schema)
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                ends = np.asarray(one.column(len(names)).flatten(), np.int64)
                stream = np.frombuffer(one.column(len(names) + 1)[0].as_buffer(), "<u2")
                sizes = np.diff(np.concatenate([[0], ends]))
                weight = sums_by_document(stream, ends, gain) // np.maximum(sizes, 1)
                at = (int(one.column(len(names) + 2)[0].as_py()) << 40) if len(ends) else 0
                columns = [one.column(i).flatten().cast(types.field(i).type) for i in range(len(names))]
                columns += [pa.array(sizes), pa.array(weight), pa.array([at + i for i in range(len(ends))], pa.decimal128(38, 0))]
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return written.select(*[f"c{i}" for i in range(len(names))], "ends", "stream", "at").mapInArrow(run, schema)


def noise(doc_id: str, seed: int = SEED) -> Column:
    """The floored thousandfold Gumbel variate of a hash of seed and id; a null id counts as an empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """docs without the text, with n_features, weight, score and rank: share per cent of those with at least LEAST_WORDS words are drawn, the
    highest scores first, and rank (1, 2, 3...) says in which order; it is null for the others.

    Ties go to the smaller id, a null id last; rows with one id and score come in any fixed order. A null, empty or wordless text has no features
    and weight 0 and is not drawn. Repeated rows are documents of their own with the same score. An empty table gives no rows, and an empty target takes
    all buckets for equally likely there. A column of docs with the name of a result is replaced.
    """
    source = docs.drop("n_features", "weight", "score", "rank", "at")
    written = streams(source, text, buckets)
    aim = streams(target.select(F.col(f"`{text}`")), text, buckets)
    gain = gains(counts(written, buckets), counts(aim, buckets))
    scored = weighed(written, source.drop(text), gain).withColumn("score", (F.col("weight") + noise(doc_id, seed)).cast("long"))
    # A text of w words has 2 w - 1 features.
    eligible = F.col("n_features") >= 2 * LEAST_WORDS - 1
    key = F.col(f"`{doc_id}`")
    # The drawn documents are the first ones of this order, so that ranks need no join.
    order = F.struct((~eligible).alias("a"), F.when(eligible, -F.col("score")).alias("b"), key.isNull().alias("c"), key.alias("d"), F.col("at").alias("e"))
    placed = numbered(scored, order, "_place")
    drawn = share * placed.filter(eligible).count() // 100
    return placed.withColumn("rank", F.when(F.col("_place") < drawn, F.col("_place") + 1)).drop("_place", "at")
