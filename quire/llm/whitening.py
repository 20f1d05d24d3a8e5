"""Embedding whitening by matrix-free block subspace iteration.

Vectors become whole numbers, which are stored once, packed. With their exact sums the rows are centred in whole numbers too. Each pass over
the rows multiplies the covariance, which is never formed, by a block of directions: every task adds up its rows' part of X'(XQ), and
Spark adds the parts. Orthogonalisation and the Rayleigh-Ritz step on the small block run on the driver, until the residuals certify
all components. A block that would need too many passes is widened by further directions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.llm.common import fresh, stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LIMIT = 1 << 62  # whole numbers saturate there
GUARD = 4  # directions of the first block for each component
MAX_BLOCK = 512
MAX_PASSES = 400
TOLERANCE = 1e-13  # of a residual, in units of the largest eigenvalue
FLOOR = 1e-10  # residuals that get no smaller any more are taken from here on
PATIENCE = 6  # passes without progress before that
SLOW = 12  # passes ahead from which on the block is widened
RANK = 1e-12  # components with a smaller share of the largest eigenvalue have no direction of their own
ENTRIES_AT_ONCE = 1 << 20


@dataclass
class Fit:
    n: int
    sums: list[int]  # of each dimension, exact
    directions: np.ndarray  # dimension x component
    values: np.ndarray  # eigenvalues, falling
    trace: float
    passes: int
    residuals: np.ndarray  # of each component, in units of the largest eigenvalue
    identity_error: float = float("nan")

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace


def packed(df: DataFrame, vector: str) -> DataFrame:
    """df's columns but the vector, with x (64-bit whole numbers, packed) and width, without the rows whose vector is null or has null or non-finite entries."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [c for c in df.columns if c not in (vector, "x", "width")]
    rows = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{vector}`").cast("array<double>").alias(fresh(df, "_vector")))
    schema = StructType([*rows.schema.fields[:-1], *StructType.fromDDL("x binary, width int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(schema)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                column = batch.column(len(names)).slice(at)
                ends = np.asarray(column.offsets, np.int64)
                count = max(1, int(np.searchsorted(ends, ends[0] + ENTRIES_AT_ONCE, "right")) - 1)
                yield whole(batch.slice(at, count), types)
                at += count

    def whole(part: pa.RecordBatch, types: pa.Schema) -> pa.RecordBatch:
        column = part.column(len(names))
        ends = np.asarray(column.offsets, np.int64)
        ends, entries = ends - ends[0], column.values.slice(ends[0], ends[-1] - ends[0])
        c = entries.fill_null(float("nan")).to_numpy(zero_copy_only=False)
        fine = np.isfinite(c)
        bad = np.concatenate([[0], np.cumsum(~fine)])
        kept = np.asarray(column.is_valid()) & (bad[ends[1:]] == bad[ends[:-1]])
        with np.errstate(over="ignore"):
            x = (np.clip(np.floor(SCALE * np.where(fine, c, 0.0)), -LIMIT, LIMIT).astype(np.int64) + SHIFT).astype("<i8")
        chosen = np.flatnonzero(kept)
        out = [part.column(i).take(pa.array(chosen)).cast(types.field(i).type) for i in range(len(names))]
        out.append(pa.array([x[ends[i] : ends[i + 1]].tobytes() for i in chosen], pa.binary()))
        out.append(pa.array(np.diff(ends)[chosen], pa.int32()))
        return pa.RecordBatch.from_arrays(out, schema=types)

    return rows.mapInArrow(run, schema)


def matrix(column: pa.Array) -> np.ndarray:
    """Packed rows of one width as a matrix of whole numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), -1)


def spread_out(n: int, x: np.ndarray, sums: list[int]) -> np.ndarray:
    """n x - S, exact: 64-bit whole numbers, or Python's where those could overflow."""
    largest = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if 2 * largest < 1 << 63:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(n: int, x: np.ndarray, sums: list[int]) -> np.ndarray:
    return spread_out(n, x, sums).astype(np.float64) / n


def squares(y: np.ndarray) -> list[int]:
    """The exact sum of squares of each row."""
    largest = int(np.abs(y).max(initial=0))
    if y.dtype == object or largest * largest * max(y.shape[1], 1) >= 1 << 63:
        y = y.astype(object)
    return [int(v) for v in (y * y).sum(axis=1)]


def added_up(rows: DataFrame, width: int, start: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of start(x), a matrix of width columns for a block of rows x: one small matrix from each task, added up by Spark."""
    names = [f"c{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            step = max(1, 8 * ENTRIES_AT_ONCE // max(1, len(batch.column(0)[0].as_py()) if batch.num_rows else 1))
            for at in range(0, batch.num_rows, step):
                part = start(matrix(batch.column(0).slice(at, step)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), *[pa.array(c, pa.float64()) for c in total.T]], names=["i", *names])

    parts = rows.select("x").mapInArrow(run, ", ".join(["i int", *[f"{c} double" for c in names]]))
    found = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    order = np.argsort(np.asarray(found.column("i")))
    return np.column_stack([np.asarray(found.column(c))[order] for c in names])


def exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of each dimension. Halves of 32 bits are added apart, so that nothing overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(d, np.int64), np.zeros(d, np.int64), 0
        for batch in batches:
            step = max(1, 8 * ENTRIES_AT_ONCE // d)
            for at in range(0, batch.num_rows, step):
                x = matrix(batch.column(0).slice(at, step))
                high += (x >> 32).sum(axis=0)
                low += (x & 0xFFFFFFFF).sum(axis=0)
                n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(high), pa.array(low), pa.array([n] * d, pa.int64())], names=["i", "high", "low", "n"])

    parts = rows.select("x").mapInArrow(run, "i int, high long, low long, n long")
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = sorted(parts.groupBy("i").agg(total("high"), total("low"), F.sum("n").alias("n")).collect())
    return found[0].n, [int(r.high) * (1 << 32) + int(r.low) for r in found]


def iterate(product: Callable[[np.ndarray], np.ndarray], d: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(eigenvalues, eigenvectors, residuals, passes) of the k largest of a symmetric operator of d dimensions, of which only products with blocks are asked."""
    rng = np.random.default_rng(17)
    q = np.linalg.qr(rng.standard_normal((d, min(d, GUARD * k))))[0]
    best, idle, seen = np.inf, 0, []
    for passes in range(1, MAX_PASSES + 1):
        z = product(q)
        t = q.T @ z
        values, turn = np.linalg.eigh((t + t.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, image = q @ turn, z @ turn
        largest = max(abs(values[0]), np.finfo(float).tiny)
        residuals = np.linalg.norm(image[:, :k] - ritz[:, :k] * values[:k], axis=0) / largest
        worst = residuals.max()
        idle = 0 if worst < 0.5 * best else idle + 1
        best = min(best, worst)
        seen.append(worst)
        if worst <= TOLERANCE or (worst <= FLOOR and idle >= PATIENCE):
            return values[:k], ritz[:, :k], residuals, passes
        width = q.shape[1]
        q = np.linalg.qr(image)[0]
        if width < min(d, MAX_BLOCK) and len(seen) >= 4:
            rate = (seen[-1] / seen[-4]) ** (1 / 3)
            if rate >= 1 or np.log(TOLERANCE / worst) / np.log(rate) > SLOW:
                more = rng.standard_normal((d, min(width, d - width, MAX_BLOCK - width)))
                q, seen = np.linalg.qr(np.column_stack([q, more]))[0], []
    raise RuntimeError(f"after {MAX_PASSES} passes the largest residual is still {best:g}")


def fitted(rows: DataFrame, d: int, k: int) -> Fit:
    """Learns from all packed rows, which have d entries each."""
    n, sums = exact_sums(rows, d)
    trace = float(added_up(rows, 1, lambda x: np.square(centred(n, x, sums)).sum().reshape(1, 1))[0, 0]) / n

    def product(q: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = centred(n, x, sums)
            return y.T @ (y @ q)

        return added_up(rows, q.shape[1], part) / n

    if not trace > 0:
        return Fit(n, sums, np.zeros((d, 0)), np.zeros(0), trace, 0, np.zeros(0))
    values, directions, residuals, passes = iterate(product, d, min(k, d))
    real = int((values > RANK * values[0]).sum())
    return Fit(n, sums, directions[:, :real], values[:real], trace, passes, residuals[:real])


def projected(fit: Fit, x: np.ndarray) -> np.ndarray:
    return centred(fit.n, x, fit.sums) @ fit.directions / np.sqrt(fit.values)


def distance_from_identity(rows: DataFrame, fit: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity. The rows are centred again before they are multiplied."""
    k = len(fit.values)
    if not k:
        return 0.0
    mean = added_up(rows, k, lambda x: projected(fit, x).sum(axis=0, keepdims=True))[0] / fit.n

    def part(x: np.ndarray) -> np.ndarray:
        w = projected(fit, x) - mean
        return w.T @ w

    return float(np.abs(added_up(rows, k, part) / fit.n - np.eye(k)).max())


def whitened(df: DataFrame, vector: str, components: int = COMPONENTS) -> DataFrame:
    """df's columns but the vector, for each row and component with component (from 1), n, deviation (a decimal), whitened, explained and identity_error.

    Rows go whose vector is null or has a null or non-finite entry, and so do those of another length than most (of two lengths as frequent the
    longer counts; vectors without entries go too). Whole numbers over 62 bits saturate; a deviation of over 38 digits is null. Repeated rows
    stay, each with its result. Components without variance (fewer rows or dimensions than components, or equal vectors) have no rows, so an
    empty table and one of equal vectors give none. Of equal eigenvalues any directions are taken. A column of df with the name of a result is replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    results = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    names = [c for c in df.columns if c not in (vector, *StructType.fromDDL(results).names, "x", "width")]
    source = df.select(*[F.col(f"`{c}`") for c in [*names, vector]])
    schema = StructType([*source.schema.fields[:-1], *StructType.fromDDL(results).fields])
    rows = stored(packed(source, vector))
    widest = rows.filter("width > 0").groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    if widest is None:
        return df.sparkSession.createDataFrame([], schema)
    rows = rows.filter(F.col("width") == widest.width)
    fit = fitted(rows, widest.width, components)
    fit.identity_error = distance_from_identity(rows, fit)
    shared = df.sparkSession.sparkContext.broadcast(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, types = shared.value, to_arrow_schema(schema)
        k, d = len(fit.values), len(fit.sums)
        for batch in batches:
            step = max(1, 8 * ENTRIES_AT_ONCE // d)
            for at in range(0, batch.num_rows if k else 0, step):
                part = batch.slice(at, step)
                x = matrix(part.column(len(names)))
                each = pa.array(np.repeat(np.arange(len(x)), k))
                exact = [v if v < 10**38 else None for v in squares(spread_out(fit.n, x, fit.sums))]
                made = [
                    np.tile(np.arange(1, k + 1), len(x)), np.full(len(x) * k, fit.n), pa.array(exact, pa.decimal128(38, 0)).take(each), projected(fit, x).ravel(), np.tile(fit.explained, len(x)), np.full(len(x) * k, fit.identity_error),
                ]
                columns = [part.column(i).take(each).cast(types.field(i).type) for i in range(len(names))]
                columns += [c if isinstance(c, pa.Array) else pa.array(c, type=types.field(len(names) + i).type) for i, c in enumerate(made)]
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return rows.select(*[F.col(f"`{c}`") for c in names], "x").mapInArrow(run, schema)
