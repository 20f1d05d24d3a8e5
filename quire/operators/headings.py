"""Headings aligned to a table of contents: joins by strategy, ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as T
from quire.sources.shared import computed

# What a heading, a bare numbered line and a caption look like.
TAGS = r"\A(?:<\d+>\s*)*"
HEADING = TAGS + r"(#{1,6})\s+([^\n]+)\z"
BARE = TAGS + r"\d+(?:\.\d+)+[.\s]+[^\n]+\z"
PARAGRAPH = TAGS + r"(?:#{1,6}\s+)?§\s*\d+(?:\.\d+)+[.\s]+[^\n]+\z"
SPECIAL = TAGS + r"(?:#{1,6}\s+)?(?:Раздел|Глава|Часть|раздел|глава|часть)\s+(?:[IVXLCDM]+|\d+)[.\s]*[^\n]*\z"
CAPTION = r"(?iu)" + TAGS + r"(?:#{1,6}\s+)?(?:Рис\.|Таблица|Табл\.|Окончание\s+табл\.|Продолжение\s+табл\.)"
SPECIAL_HEAD = r"\A(?:Раздел|Глава|Часть|раздел|глава|часть)\s+[IVXLCDM\d]+[.\s]*"
LEAST_PREFIX, LEAST_OVERLAP, LEAST_TOKENS = 5, 0.7, 2


def toc_entries(toc: DataFrame) -> DataFrame:
    """toc (book_name, ord, raw_text, level) with section_key, special and normalized: what entries are found by."""
    clean = F.regexp_replace(F.regexp_replace("raw_text", r"\s*\.{3,}\s*\d*\s*\z", ""), r"\s+\d+\s*\z", "")
    d = toc.withColumn("clean", T.stripped(F.regexp_replace(clean, r"\.+\z", "")))
    d = d.withColumn("section_key", T.section_key(F.col("clean")))
    d = d.withColumn("special", F.when(F.col("section_key").isNull(), T.special_key(F.col("clean"))))
    own = F.when(F.col("section_key").isNotNull(), F.regexp_replace("clean", r"\A\d+(?:\.\d+)*[.\s]*", "")).when(F.col("special").isNotNull(), F.regexp_replace("clean", SPECIAL_HEAD, "")).otherwise(F.col("clean"))
    # Entries without a number come first when texts are compared.
    rank = F.when(F.col("section_key").isNull() & F.col("special").isNull(), 0).otherwise(1)
    return d.withColumn("normalized", T.normalized(own)).withColumn("cand_ord", F.struct(rank.alias("rank"), F.col("ord").alias("ord"))).drop("clean")


def heading_candidates(lines: DataFrame) -> DataFrame:
    """The lines (book_name, file, line_no, line) that are or could be headings, with kind and the text that is looked up."""
    kind = F.when(F.col("line").rlike(CAPTION), None).when(F.col("line").rlike(HEADING), "heading").when(F.col("line").rlike(BARE), "bare").when(F.col("line").rlike(PARAGRAPH), "paragraph").when(F.col("line").rlike(SPECIAL), "special")
    text = F.when(F.col("kind") == "heading", T.stripped(F.regexp_extract("line", HEADING, 2))).otherwise(T.stripped(F.col("line")))
    looked = F.when(F.col("kind") == "special", F.regexp_replace(text, r"\A#{1,6}\s+", "")).otherwise(text)
    d = lines.withColumn("kind", kind).filter("kind is not null").withColumn("text", text)
    return d.withColumn("looked", T.stripped(F.regexp_replace(looked, r"\A<\d+>\s*", "")))


def begun(longer: DataFrame, shorter: DataFrame) -> DataFrame:
    """(book_name, text, other): texts of longer that begin with one of shorter, or equal it. Beginnings are cut at the lengths that shorter has in the book."""
    lengths = shorter.groupBy("book_name").agg(F.collect_set(F.length("text")).alias("lengths"))
    cut = longer.join(lengths, "book_name").select("book_name", "text", F.explode(F.filter("lengths", lambda n: n <= F.length("text"))).alias("n"))
    return cut.select("book_name", "text", F.substring("text", F.lit(1), F.col("n")).alias("other")).join(shorter.withColumnRenamed("text", "other"), ["book_name", "other"])


def overlapping(smaller: DataFrame, larger: DataFrame) -> DataFrame:
    """(book_name, text, other): pairs of which the first text, if it has no more words, can have LEAST_OVERLAP of them in the other.

    Such a text shares one of its rarest words, all but as many as it must share and one more; so common words find no pairs.
    """
    words = lambda d: d.select("book_name", "text", F.explode(F.array_distinct(F.split("text", " "))).alias("word"))
    index = words(larger)
    often = index.groupBy("book_name", "word").agg(F.count("*").alias("often"))
    text = Window.partitionBy("book_name", "text")
    ranked = words(smaller).join(often, ["book_name", "word"], "left").withColumn("size", F.count("*").over(text))
    ranked = ranked.withColumn("place", F.row_number().over(text.orderBy(F.coalesce("often", F.lit(0)), "word")))
    rare = ranked.filter(F.col("often").isNotNull() & (F.col("place") <= F.col("size") - F.ceil(F.col("size") * LEAST_OVERLAP - 1e-9) + 1))
    return rare.select("book_name", "text", "word").join(index.withColumnRenamed("text", "other"), ["book_name", "word"]).select("book_name", "text", "other")


def matches(found: DataFrame, toc: DataFrame) -> DataFrame:
    """found with strategy, entry (the ord of the entry matched) and new_level, null without a match.

    Strategies in order: A exact number, B longest parent number, C special key, D paragraph sign, E equal text, F prefix, G word overlap. Joins
    find the entries: one on keys of numbers and special words, others on whole beginnings and on the rarest words that texts with enough in common must share.
    """
    entries = computed(toc_entries(toc))
    keys = ["book_name", "looked"]
    looked = found.select(*keys).distinct()
    looked = looked.withColumn("section", T.section_key(F.col("looked"))).withColumn("special", T.special_key(F.col("looked")))
    sign = F.nullif(F.regexp_extract("looked", r"\A§\s*(\d+(?:\.\d+)+)[.\s]*", 1), F.lit(""))
    looked = looked.withColumn("sign", F.transform(F.split(sign, r"\."), T.whole_number))
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("looked", r"\A(\d+(?:\.\d+)+)[.\s]*", ""), SPECIAL_HEAD, ""), r"\A§\s*(\d+(?:\.\d+)+)[.\s]*", "")
    # Entries and looked-up texts take part in every offer, so they are computed once.
    looked = computed(looked.withColumn("norm", T.normalized(F.regexp_replace(bare, r"\.+\z", ""))))

    number = lambda x: F.concat(F.lit("n:"), F.array_join(x, "."))
    special = F.concat(F.lit("s:"), F.col("special.keyword"), F.lit(":"), F.col("special.number"))
    offer = lambda strategy, score, key: F.struct(strategy.alias("strategy"), score.cast("double").alias("score"), key.alias("key"))
    none = F.array().cast("array<struct<strategy: string, score: double, key: string>>")
    size = F.size("section")
    offers = F.concat(
        F.when(size > 0, F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda n: offer(F.when(n == size, "A").otherwise("B"), n, number(F.slice("section", F.lit(1), n))))).otherwise(none),
        F.when(F.col("special").isNotNull(), F.array(offer(F.lit("C"), F.lit(0), special))).otherwise(none),
        F.when(F.col("sign").isNotNull(), F.array(offer(F.lit("D"), F.lit(0), number(F.col("sign"))))).otherwise(none),
    )
    numbered = entries.withColumn("key", F.coalesce(number(F.col("section_key")), special)).filter("key is not null")
    numbered = numbered.groupBy("book_name", "key").agg(F.max("ord").alias("ord"), F.max_by("level", "ord").alias("level"))  # of equal keys the last entry
    foremost = F.struct(F.lit(0).alias("rank"), F.lit(0).cast("long").alias("ord"))
    by_key = looked.select(*keys, F.explode(offers).alias("o")).select(*keys, "o.*").join(numbered, ["book_name", "key"])
    by_key = by_key.select(*keys, "strategy", "score", foremost.alias("cand_ord"), "ord", "level")

    # Entries with one text are offered alike, so the first of them stands for all, and looked-up texts that are normalized alike have one best entry:
    # neither is multiplied by the other.
    texts = entries.filter("normalized <> ''").groupBy("book_name", "normalized").agg(F.min(F.struct("cand_ord", "ord", "level")).alias("e")).select("book_name", "normalized", "e.*")
    offered = texts.select("book_name", F.col("normalized").alias("text"))
    asked = looked.filter("norm <> ''").select("book_name", F.col("norm").alias("text")).distinct()
    flipped = lambda d: d.select("book_name", F.col("other").alias("text"), F.col("text").alias("other"))
    pairs = begun(asked, offered).unionByName(flipped(begun(offered, asked))).unionByName(overlapping(asked, offered)).unionByName(flipped(overlapping(offered, asked)))
    pairs = pairs.select("book_name", F.col("text").alias("norm"), F.col("other").alias("normalized")).distinct().join(texts, ["book_name", "normalized"])
    long_enough = (F.length("norm") >= LEAST_PREFIX) & (F.length("normalized") >= LEAST_PREFIX)
    prefix = F.col("norm").startswith(F.col("normalized")) | F.col("normalized").startswith(F.col("norm"))
    overlap = T.token_overlap(F.col("norm"), F.col("normalized"))
    enough = F.least(F.size(F.split("norm", " ")), F.size(F.split("normalized", " "))) >= LEAST_TOKENS
    strategy = F.when(F.col("norm") == F.col("normalized"), "E").when(long_enough & prefix, "F").when((overlap >= LEAST_OVERLAP) & enough, "G")
    by_text = pairs.withColumn("strategy", strategy).filter("strategy is not null").withColumn("score", F.when(F.col("strategy") == "G", overlap).otherwise(0.0))
    first = lambda d, *by: d.groupBy(*by).agg(F.min(F.struct("strategy", F.negative("score").alias("less"), "cand_ord", "ord", "level")).alias("b"))
    by_text = first(by_text, "book_name", "norm").join(looked.select(*keys, "norm"), ["book_name", "norm"]).select(*keys, "b.strategy", F.negative("b.less").alias("score"), "b.cand_ord", "b.ord", "b.level")
    best = first(by_key.unionByName(by_text), *keys).select(*keys, "b.*")
    return found.join(best.select(*keys, "strategy", F.col("ord").alias("entry"), F.col("level").alias("new_level")), keys, "left")


def aligned_lines(pages: DataFrame, toc: DataFrame, remove_unmatched: bool = True) -> DataFrame:
    """(book_name, file, line_no, old, line, kind, outcome): each line as it is after alignment."""
    lines = pages.select("book_name", "file", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    m = matches(heading_candidates(lines), toc).select("book_name", "file", "line_no", "kind", "text", "new_level")
    d = lines.join(m, ["book_name", "file", "line_no"], "left")
    old_level = F.length(F.regexp_extract("line", HEADING, 1))
    bare = T.stripped(F.regexp_replace("text", r"\A(?:<\d+>\s*)*(?:#{1,6}\s*)?", ""))
    new = F.concat(F.repeat(F.lit("#"), F.col("new_level")), F.lit(" "), F.when(F.col("kind") == "heading", F.col("text")).otherwise(bare))
    heading, matched = F.col("kind") == "heading", F.col("new_level").isNotNull()
    outcome = F.when(heading & matched & (F.col("new_level") == old_level), "unchanged").when(heading & matched, "fixed_level").when(
        heading & F.lit(remove_unmatched), "removed_hash"
    ).when(F.col("kind").isNotNull() & ~heading & matched, "added_hash").when(F.col("kind").isNotNull(), "unmatched")
    line = F.when(F.col("outcome").isin("fixed_level", "added_hash"), new).when(F.col("outcome") == "removed_hash", F.col("text")).otherwise(F.col("line"))
    d = d.withColumn("outcome", outcome)
    return d.select("book_name", "file", "line_no", F.col("line").alias("old"), line.alias("line"), "kind", "outcome")


def aligned_pages(pages: DataFrame, toc: DataFrame, remove_unmatched: bool = True) -> DataFrame:
    """pages with the headings of text aligned."""
    rows = aligned_lines(pages, toc, remove_unmatched).groupBy("book_name", "file").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("rows"))
    return rows.select("book_name", "file", F.array_join(F.transform("rows", lambda r: r.line), "\n").alias("text"))


def mismatch_counts(pages: DataFrame, toc: DataFrame) -> DataFrame:
    """(book_name, total, wrong_level, not_in_toc, correct) of the marked headings."""
    lines = pages.select("book_name", "file", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    d = matches(heading_candidates(lines).filter("kind = 'heading'"), toc).withColumn("old_level", F.length(F.regexp_extract("line", HEADING, 1)))
    level = F.col("new_level")
    return d.groupBy("book_name").agg(
        F.count("*").alias("total"), F.count_if(level != F.col("old_level")).alias("wrong_level"), F.count_if(level.isNull()).alias("not_in_toc"), F.count_if(level == F.col("old_level")).alias("correct")
    )


def uncovered_entries(pages: DataFrame, toc: DataFrame) -> DataFrame:
    """The entries that no heading of the book resolves to."""
    lines = pages.select("book_name", "file", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    used = matches(heading_candidates(lines), toc).filter("entry is not null").select("book_name", F.col("entry").alias("ord")).distinct()
    return toc.join(used, ["book_name", "ord"], "left_anti")


def level_name(level: Column) -> Column:
    return F.repeat(F.lit("#"), level)
