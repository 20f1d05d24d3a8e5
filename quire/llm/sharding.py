"""Shards by a k-d tree over metadata: nodes are split at distributed weighted medians along their widest dimension.

Points are the different texts with the sum of their rows' bytes; a text that outweighs the tolerance is a point for each of 4096 hashes of its rows' ids, so
that a group of copies of any size can be divided, while smaller ones stay together. A point's key along a dimension is the dimension's value in DIGITS bits,
then a hash of the text, then that of the ids, so that ties have an order. All nodes of a level are split together, by radix descent: points
are counted (as bytes) in DIGITS-bit bins by node, the bin where the running weight crosses the goal is opened, and so on down the key. The
first count takes all dimensions at once and so tells the widest. Only histograms, of a bounded number of bins for each node,
reach the driver; no row does. A node is an expression of the cuts above it, so that rows and points are stored once. Everything is DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import numbered, reliable

DIGITS = 12
DIGITS_OF_TEXT = 2
BITS = DIGITS * (DIGITS_OF_TEXT + 2)
STEPS = 64  # of a continuous dimension
TOLERANCE = 1e-3
REPEATED = 0.1  # share of a shard from which rows that repeat one another (one text, one id) are divided
ROWS_A_RUN = 4096
BROADCAST_VALUES = 10_000


@dataclass
class Node:
    """The shards first to first + shards - 1; a node that is split has an axis, the line on it and two parts."""

    first: int
    shards: int
    axis: str = ""
    line: int = 0
    parts: tuple[Node, Node] | None = None

    def column(self) -> Column:
        """The first shard of the node that a point lies in."""
        if not self.parts:
            return F.lit(self.first)
        return F.when(F.col(self.axis) < self.line, self.parts[0].column()).otherwise(self.parts[1].column())

    def leaves(self) -> list[Node]:
        return [leaf for part in self.parts for leaf in part.leaves()] if self.parts else [self]


def choice(pairs: dict[int, int]) -> Column:
    """The value for the row's node; null without one."""
    return F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in pairs.items() for x in pair]), F.col("node").cast("long"))


def by_node(rows: list) -> dict[int, list[tuple[int, float]]]:
    found: dict[int, list[tuple[int, float]]] = {}
    for r in rows:
        found.setdefault(r.node, []).append((r.bin, float(r.weight)))
    return {n: sorted(bins) for n, bins in found.items()}


def crossing(bins: list[tuple[int, float]], left: float) -> tuple[int, float, float]:
    """The bin in which the running weight reaches what is left, with what is left before it and its own weight."""
    for bin_, weight in bins:
        if weight >= left:
            break
        left -= weight
    else:
        left += weight
    return bin_, left, weight


def kd_tree(points: DataFrame, axes: list[str], shards: int, grain: float) -> Node:
    """The tree whose leaves have nearly equal weights. points: weight, and a key of BITS bits for each axis. Cuts are exact to the grain, or to a point's weight."""
    root = Node(0, shards)
    while splitting := {n.first: n for n in root.leaves() if n.shards > 1}:
        here = points.withColumn("node", root.column()).filter(F.col("node").isin(list(splitting)))
        every = F.explode(F.array(*[F.struct(F.lit(i).alias("axis"), F.shiftrightunsigned(a, BITS - DIGITS).alias("bin")) for i, a in enumerate(axes)]))
        counts = here.select("node", "weight", every.alias("at")).groupBy("node", "at.axis", "at.bin").agg(F.sum("weight").alias("weight")).collect()
        prefix, left, line = {}, {}, {}
        for k, n in splitting.items():
            bins = [by_node([r for r in counts if r.axis == i]).get(k, []) for i in range(len(axes))]
            widest = max(range(len(axes)), key=lambda i: bins[i][-1][0] - bins[i][0][0] if bins[i] else -1)
            n.axis = axes[widest]
            goal = sum(w for _, w in bins[widest]) * (n.shards // 2) / n.shards
            if goal:
                prefix[k], left[k], _ = crossing(bins[widest], goal)
        key = F.coalesce(*[F.when(F.col("node").isin([k for k in prefix if splitting[k].axis == a]), F.col(a)) for a in axes])
        for shift in range(BITS - 2 * DIGITS, -1, -DIGITS):
            unknown = {k: p for k, p in prefix.items() if k not in line}
            if not unknown:
                break
            opened = here.filter(F.shiftrightunsigned(key, shift + DIGITS) == choice(unknown))
            bins = by_node(opened.groupBy("node", F.shiftrightunsigned(key, shift).bitwiseAND((1 << DIGITS) - 1).alias("bin")).agg(F.sum("weight").alias("weight")).collect())
            for k in unknown:
                at, left[k], weight = crossing(bins[k], left[k])
                prefix[k] = (prefix[k] << DIGITS) | at
                if left[k] <= grain or weight - left[k] <= grain or not shift:
                    line[k] = (prefix[k] + (2 * left[k] > weight)) << shift  # the nearer side
        for k, n in splitting.items():
            half = n.shards // 2
            n.line = line.get(k, 0)
            n.parts = Node(n.first, half), Node(n.first + half, n.shards - half)
    return root


def scaled(value: Column, low: Column, high: Column) -> Column:
    """A dimension's value as one of 2^DIGITS steps from low to high; nulls lie at the low end."""
    part = F.when(high > low, (value.cast("double") - low) / (high - low)).otherwise(0.0)
    return F.coalesce(F.floor(part * ((1 << DIGITS) - 1)), F.lit(0)).cast("long")


def ranked(texts: DataFrame, name: str) -> DataFrame:
    """texts with the column name replaced by the rank of its value, nulls first."""
    values = reliable(numbered(texts.select(name).distinct(), F.col(name).asc_nulls_first(), "rank").withColumnRenamed(name, "of"))
    small = F.broadcast(values) if values.count() <= BROADCAST_VALUES else values
    return texts.join(small, F.col(name).eqNullSafe(F.col("of"))).drop(name, "of").withColumnRenamed("rank", name)


def kd_shards(rows: DataFrame, ranks: list[str], measures: list[str], weight: str, copies: str, doc_id: str, number: str, shards: int) -> DataFrame:
    """rows with shard (0 to shards - 1) and place (a hash by which the rows of a shard can be dealt out), by a k-d tree with leaves of nearly equal weight.

    rows should be stored. copies: a long column, equal for rows to be kept together, which have the dimensions of their smallest values; number: one that differs
    between all rows. ranks are dimensions by the order of their values, measures numeric ones, taken in STEPS steps. Dimensions come in this order where
    they are equally wide. Nulls lie at the low end. An empty table gives no rows.
    """
    dimensions = [*ranks, *measures]
    total = float(rows.agg(F.sum(weight)).first()[0] or 0)
    grain = TOLERANCE * total / shards
    texts = rows.groupBy(copies).agg(F.sum(weight).alias("weight"), *[F.min(d).alias(d) for d in dimensions])
    for d in ranks:
        texts = ranked(texts, d)
    texts = reliable(texts)
    ends = texts.agg(*[f(d).cast("double").alias(f"{n}{i}") for i, d in enumerate(dimensions) for f, n in ((F.min, "low"), (F.max, "high"))]).first()
    steps = lambda d, c: F.floor(c / ((1 << DIGITS) // STEPS)) * ((1 << DIGITS) // STEPS) if d in measures else c
    dims = [steps(d, scaled(F.col(d), F.lit(ends[f"low{i}"]), F.lit(ends[f"high{i}"]))).alias(f"d{i}") for i, d in enumerate(dimensions)]
    texts = texts.select(copies, "weight", *dims)
    axes = [f"k{i}" for i in range(len(dimensions))]
    text_hash = F.pmod(F.col(copies), F.lit(1 << (DIGITS * DIGITS_OF_TEXT)))

    def keyed(df: DataFrame) -> DataFrame:
        """The keys from the dimensions, the text's hash and that of the id."""
        low = F.shiftleft(text_hash, DIGITS).bitwiseOR(F.col("own"))
        return df.withColumns({k: F.shiftleft(F.col(f"d{i}").cast("long"), BITS - DIGITS).bitwiseOR(low) for i, k in enumerate(axes)})

    # At most shards / TOLERANCE texts, or pairs of a text and an id, outweigh the grain: a bound for the broadcasts.
    hot = reliable(texts.filter(F.col("weight") > grain))
    copied = rows.join(F.broadcast(hot.drop("weight")), copies)
    repeated = reliable(copied.groupBy(copies, doc_id).agg(F.sum(weight).alias("weight")).filter(F.col("weight") > REPEATED * total / shards).select(F.col(copies).alias("_c"), F.col(doc_id).alias("_d")))
    again = (F.col(copies) == F.col("_c")) & F.col(doc_id).eqNullSafe(F.col("_d"))
    # Rows that repeat one another are told apart by their number.
    place = F.when(F.col("_c").isNull(), F.xxhash64(doc_id, copies, F.lit(1))).otherwise(F.xxhash64(number, F.lit(1)))
    copied = copied.join(F.broadcast(repeated), again, "left").withColumn("place", place).drop("_c", "_d").withColumn("own", F.pmod("place", F.lit(1 << DIGITS)))
    single = texts.join(hot.select(copies), copies, "left_anti").withColumn("own", F.lit(0).cast("long"))
    parts = copied.groupBy(copies, "own", *[f"d{i}" for i in range(len(axes))]).agg(F.sum(weight).alias("weight"))
    points = reliable(keyed(single.unionByName(parts)).select("weight", *axes))
    shard = kd_tree(points, axes, shards, grain).column().cast("int")
    alone = rows.join(F.broadcast(hot.select(copies)), copies, "left_anti").join(single.drop("weight"), copies).withColumn("place", F.xxhash64(doc_id, copies, F.lit(1)))
    return keyed(alone.unionByName(copied)).select(*rows.columns, "place", shard.alias("shard"))


def slots(df: DataFrame, shard: str, place: str, number: str, rows: int) -> DataFrame:
    """df with slot: gapless from 0 within each shard.

    A shard is dealt by a hash of place into runs of about ROWS_A_RUN rows, each numbered in one task; the runs' sizes add up to offsets. rows is the number of df's rows in a shard.
    """
    runs = max(1, -(-rows // ROWS_A_RUN))
    dealt = df.withColumn("_run", F.pmod(F.xxhash64(F.col(place), F.lit(2)), F.lit(runs)).cast("int"))
    before = Window.partitionBy(shard).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(shard, "_run").count()
    offsets = sizes.select(shard, "_run", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(shard, "_run").orderBy(F.xxhash64(F.col(place), F.lit(3)), place, number)
    numbered = dealt.withColumn("_at", F.row_number().over(inside) - 1)
    return numbered.join(offsets, [shard, "_run"]).withColumn("slot", (F.col("_offset") + F.col("_at")).cast("long")).drop("_run", "_offset", "_at")


def sharded(df: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text", ranks: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    size is the text's UTF-8 bytes (null: none) plus 8. The law is bytes: shards have nearly equal sizes. Dimensions are the metadata columns of ranks that df
    has, the bytes of a text (by their logarithm) and its bytes a character, which tells scripts apart. Rows with equal texts share the smallest of each, so
    copies stay together but where a boundary cuts a group. Rows with a null text, id or metadata and repeated rows count like others; an empty table gives
    no rows; other columns are not read.
    """
    n_bytes = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")
    ranks = tuple(r for r in ranks if r in df.columns)
    rows = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (n_bytes + 8).alias("size"),
        F.crc32(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("text_crc32"),
        *[F.col(f"`{r}`").cast("string").alias(f"rank{i}") for i, r in enumerate(ranks)],
        F.log2(n_bytes + 8).alias("bytes"),
        (n_bytes / F.greatest(F.coalesce(F.char_length(F.col(f"`{text}`")), F.lit(0)), F.lit(1))).alias("density"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("copies"),
    )
    rows = reliable(rows.withColumn("number", F.monotonically_increasing_id()))
    placed = kd_shards(rows, [f"rank{i}" for i in range(len(ranks))], ["bytes", "density"], "size", "copies", "doc_id", "number", shards)
    numbered_rows = slots(reliable(placed.select("doc_id", "size", "text_crc32", "number", "place", "shard")), "shard", "place", "number", -(-rows.count() // shards))
    return numbered_rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
