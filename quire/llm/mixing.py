"""Mixing sources to target weights, in blocks of a fixed number of words.

The words of a source, its documents laid end to end in a hashed order, are packed into blocks. A source's target fixes its number of slots. Each slot
draws its output shard by a hash, so each shard has multinomial source counts, given those totals. The counts number the
slots of each source, shard after shard; slots go through a pseudorandom permutation of the source's block indices, pass after pass, so no block is taken more than
once more than another, and blocks are joined by index. The places of a shard are permuted in the same way. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import numbered, reliable, spread

BLOCK = 128
SHARE = 1.5
LIMIT = 2.0
SHARD_SLOTS = 8192
ROWS_A_RUN = 4096
SLOTS_A_CHUNK = 1024
BROADCAST_SOURCES = 10_000
ROUNDS = 4
WALK = 256
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """sizes (source, source_size) with rank (by code point, null last), weight (3, 1, 2, repeating) and target.

    The targets are share of all words, dealt by weight; a target stops at limit times its source's size and the excess is dealt again, until none is above: so it is the lesser
    of that limit and a common level times the weight. One row for each source.
    """
    ranked = numbered(sizes, F.col("source").asc_nulls_last(), "rank")
    ranked = ranked.withColumn("weight", F.element_at(F.array(F.lit(3.0), F.lit(1.0), F.lit(2.0)), (F.col("rank") % 3 + 1).cast("int")))
    ranked = reliable(ranked.withColumn("cap", F.col("source_size") * limit))
    level, total = 0.0, None
    while True:
        full = F.col("cap") < F.lit(level) * F.col("weight")
        sums = ranked.agg(F.sum("source_size").alias("words"), F.sum(F.when(full, F.col("cap"))).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("rest")).first()
        total = (sums.words or 0) * share
        higher = (total - (sums.full or 0.0)) / sums.rest if sums.rest else level
        if higher <= level:
            break
        level = higher
    return ranked.withColumn("target", F.least(F.col("cap"), F.lit(level) * F.col("weight"))).drop("cap")


def permuted(index: Column, n: Column, seed: Column) -> Column:
    """A pseudorandom permutation of 0..n-1, keyed by the seed: a Feistel network on the smallest near-square grid that holds n cells, walked on from cells beyond n.

    Fewer than WALK cells lie beyond n as long as n is below WALK * WALK, and above that a walk of so many steps has no chance worth naming.
    """
    high = F.ceil(F.sqrt(n.cast("double")))
    low = F.ceil(n / high)

    def half(cell: Column, k: Column) -> Column:
        a, b = cell["a"], cell["b"]
        left = F.pmod(a + F.pmod(F.xxhash64(seed, k, b), high), high)
        right = F.pmod(b + F.pmod(F.xxhash64(seed, k, a), low), low)
        return F.when(k % 2 == 0, F.struct(left.alias("a"), b.alias("b"))).otherwise(F.struct(a.alias("a"), right.alias("b")))

    # The rounds are folded, as written out their expression would double with each.
    start = lambda x: F.struct(F.floor(x / low).alias("a"), F.pmod(x, low).alias("b"))
    network = lambda x: F.aggregate(F.sequence(F.lit(0), F.lit(2 * ROUNDS - 1)), start(x), half, lambda cell: cell["a"] * low + cell["b"])
    walk = lambda x: F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), x, lambda at, _: F.when(at < n, at).otherwise(network(at)))
    return F.transform(F.array(network(index)), lambda x: F.when(x < n, x).otherwise(walk(x)))[0]


def laid_out(rows: DataFrame, count: int) -> DataFrame:
    """rows (row, own, rank, size and others) with start: the words of the rank's documents before this one, in the order of a hash of own.

    A rank is dealt into runs of about ROWS_A_RUN rows by own, whose sums are joined back as offsets. Rows that repeat one another have one own: where they crowd
    a run they are dealt on by their number, as they are interchangeable.
    """
    runs = max(1, -(-count // ROWS_A_RUN))
    key = ["rank", "run", "crowd", "part"]
    zero = F.lit(0).cast("long")
    dealt = rows.withColumn("run", F.pmod(F.xxhash64("own", F.lit(5)), F.lit(runs)).cast("int")).withColumn("crowd", zero).withColumn("part", zero)
    crowded = dealt.groupBy("rank", "run").count().filter(F.col("count") > 4 * ROWS_A_RUN).select("rank", "run")
    if not crowded.isEmpty():
        hot = dealt.join(crowded, ["rank", "run"], "left_semi").groupBy("rank", "own").count().filter(F.col("count") > ROWS_A_RUN)
        hot = hot.select("rank", "own", F.ceil(F.col("count") / ROWS_A_RUN).alias("parts"))
        # They follow the run's other rows, so that these keep their places whatever the parts' sizes.
        dealt = dealt.drop("crowd", "part").join(hot, ["rank", "own"], "left")
        dealt = dealt.withColumn("crowd", F.when(F.col("parts").isNull(), zero).otherwise(F.shiftrightunsigned("own", 1) + 1))
        dealt = dealt.withColumn("part", F.coalesce(F.pmod(F.col("row"), F.col("parts")), zero)).drop("parts")
    sums = dealt.groupBy(*key).agg(F.sum("size").alias("words"))
    before = Window.partitionBy("rank").orderBy(*key[1:]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*key, F.coalesce(F.sum("words").over(before), zero).alias("offset"))
    inside = Window.partitionBy(*key).orderBy(F.xxhash64("own", F.lit(6)), "own", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), zero))
    return placed.join(offsets, key).withColumn("start", F.col("offset") + F.col("inside")).drop(*key[1:], "offset", "inside")


def drawn(sources: DataFrame, block: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(rank, blocks, shard, count, first): how many slots of each source each output shard gets, and the number of the first of them among the source's.

    sources: rank, source_size, target. Each slot of a source draws its shard alike, so counts are multinomial; they add up to the source's slots.
    """
    sized = sources.filter("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block))
    passes = F.floor(F.col("target") / F.col("source_size") + 1e-9)
    rest = F.greatest(F.col("target") - passes * F.col("source_size"), F.lit(0.0))
    sized = sized.select("rank", "blocks", (passes * F.col("blocks") + F.round(rest / F.col("source_size") * F.col("blocks"))).cast("long").alias("slots")).filter("slots > 0")
    shards = max(1, -(-(sized.agg(F.sum("slots")).first()[0] or 0) // shard_slots))
    chunks = sized.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / SLOTS_A_CHUNK))).alias("chunk"))
    first = F.col("chunk") * SLOTS_A_CHUNK
    each = spread(chunks, "rank", "chunk").select("rank", "blocks", F.explode(F.sequence(first, F.least(first + SLOTS_A_CHUNK, F.col("slots")) - 1)).alias("slot"))
    counts = each.groupBy("rank", "blocks", F.pmod(F.xxhash64("rank", "slot", F.lit(7)), F.lit(shards)).alias("shard")).count()
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0).cast("long")))


def mix(counts: DataFrame) -> DataFrame:
    """(shard, place, rank, index): the block at each place of each output shard, from drawn()."""
    shard = Window.partitionBy("shard")
    before = F.coalesce(F.sum("count").over(shard.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    counted = counts.withColumn("before", before).withColumn("all", F.sum("count").over(shard))
    each = spread(counted, "rank", "shard").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("n")).withColumn("slot", F.col("first") + F.col("n"))
    turn = F.floor(F.col("slot") / F.col("blocks"))
    return each.select(
        "shard",
        permuted(F.col("before") + F.col("n"), F.col("all"), F.xxhash64("shard", F.lit(9))).alias("place"),
        "rank",
        permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.xxhash64("rank", turn, F.lit(8))).alias("index"),
    )


def parts_of(placed: DataFrame, block: int) -> DataFrame:
    """(rank, index, row, doc_id, skipped, words): each document's part of each block that it lies in; skipped counts its words before."""
    end = F.col("start") + F.col("size")
    each = placed.filter("size > 0").select("*", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))).alias("index"))
    first = F.greatest(F.col("start"), F.col("index") * block)
    return each.select("rank", "index", "row", "doc_id", (first - F.col("start")).alias("skipped"), (F.least(end, (F.col("index") + 1) * block) - first).alias("words"))


def packed(df: DataFrame, doc_id: str, text: str, source: str, share: float, limit: float) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and the rows with their places among their source's words."""
    words = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")
    own = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), words.alias("size"), own.alias("own"))
    rows = reliable(rows.withColumn("row", F.monotonically_increasing_id()))
    sources = reliable(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share, limit))
    small = F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources
    ranked = rows.join(small.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "weight")
    return sources, reliable(laid_out(ranked, rows.count()))


def mixture(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(shard, place, source, index, words, parts): the mix, one row for each place of each output shard.

    parts are the documents' stretches in the block, in order: (doc_id, skipped, words), skipped being the words of the document before the stretch.
    Rows and sources are treated as mixed() does; mixed() counts what stands here.
    """
    sources, placed = packed(df, doc_id, text, source, share, limit)
    part = F.struct("index", "start", "doc_id", "skipped", "words")
    blocks = parts_of(placed, block).join(placed.select("row", "start"), "row").groupBy("rank", "index").agg(F.sum("words").alias("words"), F.array_sort(F.collect_list(part)).alias("parts"))
    blocks = blocks.withColumn("parts", F.transform("parts", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["skipped"].alias("skipped"), x["words"].alias("words"))))
    out = mix(drawn(sources, block)).join(blocks, ["rank", "index"]).join(sources.select("rank", "source"), "rank")
    return out.select("shard", "place", "source", "index", "words", "parts")


def mixed(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row.

    size counts the words of the text (null: 0), taken those that the mix takes, with repeats: the row's part of each block times the
    places of that block in the mix. Rows without words have 0 taken. A null source is a source; repeated rows count each, rows without an id too; an empty table
    gives no rows, and other columns are not read. The order of documents, the draws and the permutations are hashes of ids and texts, so reruns agree (rows
    that repeat one another are interchangeable).
    """
    sources, placed = packed(df, doc_id, text, source, share, limit)
    times = mix(drawn(sources, block)).groupBy("rank", "index").agg(F.count("*").alias("times"))
    # These grow with the table: never broadcast, however small they look.
    taken = parts_of(placed, block).join(times.hint("merge"), ["rank", "index"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = placed.join(taken.hint("merge"), "row", "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
