"""Exact top-k search among 64-bit codes by incremental multi-index hashing.

A code is cut into segments, each an index; their number follows from the number of codes, so that a segment has about as many possible values as there
are codes. In the round with segment radius s a query probes, in every index, the values at exactly s bits from its own segment. After it the query has met
every code of which some segment lies within s bits, so by the pigeonhole principle every code within segments * (s + 1) - 1 bits. The query is done once its
k-th verified distance is no more than that; the others go on with s + 1, the best rows so far and their bound. A code counts for a query once: in the
round of its nearest segment, by the first such segment. A round deals out no more probes than an index has possible values, about a
quarter of the number of codes, at any radius. Equal codes are one entry with their smallest ids, and equal queries one query.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import reliable, spread

HALF = 16  # masks are listed for so many bits; those of wider segments join two lists


def sign_code(vector: str) -> Column:
    """64 bits, the i-th set if the vector's i-th number is above 0; null for a null vector. Missing numbers count as not above."""
    bit = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when(F.get(F.col(vector), i) > 0, F.expr("1L")).otherwise(F.expr("0L")))
    powers = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.expr("1L"), i))
    merged = F.aggregate(F.zip_with(bit, powers, lambda b, p: b * p), F.expr("0L"), lambda a, x: a.bitwiseOR(x))
    return F.when(F.col(vector).isNotNull(), merged)


def cuts(codes: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment for a table of so many codes. Two bits less than the number's logarithm: entries are cheaper than probes."""
    width = min(2 * HALF, max(4, round(log2(max(codes, 2))) - 2))
    number = -(-64 // width)
    at = [round(64 * i / number) for i in range(number + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


def segment(code: Column, cut: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(code, cut[0]).bitwiseAND((1 << cut[1]) - 1)


def masks(width: int, s: int) -> list[int]:
    """The numbers of width bits of which s are set."""
    return [x for x in range(1 << width) if x.bit_count() == s]


def listed(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>") if values else F.lit(None).cast("array<long>")


def nearest(rows: DataFrame, keep: int) -> DataFrame:
    """(query, found): the keep rows (distance, id) that come first, from (query, distance, id)."""
    order = Window.partitionBy("query").orderBy("distance", "id")
    best = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)  # limited before the shuffle too
    return best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("distance", "id"))).alias("found"))


def probes(queries: DataFrame, segments: list[tuple[int, int]], s: int) -> DataFrame:
    """(query, worst, j, value): for each query and segment the values at s bits from its own."""
    out = None
    for wide in sorted({w for _, w in segments}):
        own = F.array(*[F.struct(F.lit(j).alias("j"), segment(F.col("query"), cut).alias("own")) for j, cut in enumerate(segments) if cut[1] == wide])
        rows = queries.select("query", "worst", F.explode(own).alias("at")).select("query", "worst", "at.j", "at.own")
        if wide <= HALF:
            each = rows.withColumn("mask", F.explode(listed(masks(wide, s)))) if s <= wide else rows.limit(0).withColumn("mask", F.lit(0).cast("long"))
        else:
            each = None
            for low in range(max(0, s - (wide - HALF)), min(s, HALF) + 1):
                part = rows.withColumn("low", F.explode(listed(masks(HALF, low)))).withColumn("high", F.explode(listed(masks(wide - HALF, s - low))))
                part = part.withColumn("mask", F.col("low").bitwiseOR(F.shiftleft("high", HALF))).drop("low", "high")
                each = part if each is None else each.unionByName(part)
        if each is not None:
            each = each.select("query", "worst", "j", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
            out = each if out is None else out.unionByName(each)
    return out


def met(queries: DataFrame, index: DataFrame, segments: list[tuple[int, int]], s: int) -> DataFrame:
    """(query, distance, id) of the codes whose nearest segment lies at s bits, no further than the query's bound, each once."""
    other = F.col("query").bitwiseXOR(F.col("code"))
    new = F.lit(True)
    for j, cut in enumerate(segments):
        off = F.bit_count(segment(other, cut))
        new = new & F.when(F.col("p.j") > j, off > s).when(F.col("p.j") < j, off >= s).otherwise(True)
    on = (F.col("p.j") == F.col("i.j")) & (F.col("p.value") == F.col("i.value")) & (F.bit_count(other) <= F.col("worst")) & new
    # The number of probes is not bounded, and adaptive execution would judge it by the few rows before the explode: no broadcast.
    found = probes(queries, segments, s).alias("p").hint("merge").join(index.alias("i").hint("merge"), on)
    return found.select("query", F.bit_count(other).alias("distance"), F.explode("ids").alias("id"))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, id, distance): for each row of queries (id, code) the k nearest rows (id, code), itself left out.

    Order is by distance, then id; rank starts at 1. With fewer than k other rows there are fewer results. Rows with a null id or code neither search nor are found;
    a query repeated is answered as often; rows with the query's own id are left out; other columns are not read. An empty table on either side gives no rows.
    """
    rows = rows.filter("id is not null and code is not null").select("id", "code")
    asking = queries.filter("id is not null and code is not null").select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    keep = k + 1  # one of them may be the query itself
    least = Window.partitionBy("code").orderBy("id")
    few = rows.distinct().withColumn("place", F.row_number().over(least)).filter(F.col("place") <= keep)
    points = reliable(few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    size = points.agg(F.count("*").alias("codes"), F.sum(F.size("ids")).alias("ids")).first()
    wanted = min(keep, size.ids or 0)
    segments = cuts(size.codes)
    entries = F.array(*[F.struct(F.lit(j).alias("j"), segment(F.col("code"), cut).alias("value")) for j, cut in enumerate(segments)])
    index = points.select("code", "ids", F.explode(entries).alias("at")).select("at.j", "at.value", "code", "ids")
    nothing = F.array().cast(f"array<struct<distance:int,id:{rows.schema['id'].dataType.simpleString()}>>")
    left = asking.select("query").distinct().withColumn("found", nothing).withColumn("worst", F.lit(64))
    answers = None
    # A stored table keeps constraints on columns that it has lost, over which a union stumbles; new names for its columns end them.
    renewed = lambda df: df.select(F.col("query").alias("asked"), F.col("found").alias("found"))
    s = 0
    while wanted:
        left = reliable(spread(left, "query"))
        if left.isEmpty():
            break
        known = left.select("query", F.explode("found").alias("x")).select("query", "x.distance", "x.id")
        best = nearest(met(left, index, segments, s).unionByName(known), keep)
        # The bound of a query is its last place's distance; without enough rows there is none, and it is not done.
        bound = F.when(F.size("found") >= wanted, F.element_at("found", -1)["distance"])
        best = reliable(left.select("query").join(best, "query", "left").select("query", F.coalesce("found", nothing).alias("found")).withColumn("bound", bound))
        proved = F.col("bound") < len(segments) * (s + 1)
        answers = renewed(best.filter(proved)) if answers is None else answers.unionByName(renewed(best.filter(proved)))
        left = best.filter(~F.coalesce(proved, F.lit(False))).select("query", "found", F.coalesce("bound", F.lit(64)).alias("worst"))
        s += 1
    if answers is None:
        answers = renewed(left.select("query", "found")).limit(0)
    each = asking.join(answers, F.col("query") == F.col("asked")).select("query_id", F.slice(F.filter("found", lambda x: x.id != F.col("query_id")), 1, k).alias("found"))
    return each.select("query_id", F.posexplode("found").alias("at", "x")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("id"), F.col("x.distance").cast("int").alias("distance"))
