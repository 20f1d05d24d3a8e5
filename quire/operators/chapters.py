"""Pages stitched into blocks, blocks split into chapters: windows over blocks, in the order of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as T
from quire.operators import hyphens
from quire.sources.shared import computed

INTRODUCTION = "Введение"  # fixed value: the name of a first chapter without a heading


def blocks(pages: DataFrame) -> DataFrame:
    """pages (book_name, file, text) as (book_name, file, block_no, text): stripped blocks between blank lines."""
    each = pages.select("book_name", "file", F.posexplode(F.split("text", "\n\n+")).alias("block_no", "text"))
    return each.withColumn("text", T.stripped(F.col("text"))).filter("text <> ''")


def stitched(parts: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """Blocks in which a tagged block that goes on from the last text block since a heading is joined to it: (book_name, n, text).

    A hyphen at the joint goes but before a particle; with words (word), the known words decide as hyphens.decisions() says.

    Only the last joined piece decides whether the next one continues, so windows can tell; a joined block goes to the text before
    it even over blocks that are no text. The windows take flags of the blocks alone; texts are joined back and only meet those they are joined to.
    """
    tag = r"(?s)\A(\s*<\d+>\s*)(.*)\z"
    key = ["book_name", "file", "block_no"]
    tagged = parts.select(*key, "text", T.stripped(F.regexp_extract("text", tag, 1)).alias("marker"), T.stripped(F.regexp_extract("text", tag, 2)).alias("rest"))
    piece = F.when(F.col("marker") != "", F.col("rest")).otherwise(F.col("text"))
    flags = tagged.select(
        *key, F.col("text").startswith("#").cast("int").alias("heading"), (F.col("marker") != "").alias("tagged"), T.is_text_block(F.col("text")).alias("is_text"),
        T.is_unfinished(piece).alias("unfinished"), ((F.col("rest") != "") & ~F.col("rest").startswith("#")).alias("can_join"),
        T.begins_with_particle(F.col("rest")).alias("particle"), T.stripped(F.col("text")).endswith("-").alias("hyphen"),
        *([F.lower(F.when(F.col("text").endswith("-"), T.last_word(F.col("text"), "-")).otherwise("")).alias("before"), F.lower(F.regexp_extract("rest", r"\A([а-яА-ЯёЁa-zA-Z]+)", 1)).alias("begins")] if words is not None else []),
    )
    order = Window.partitionBy("book_name").orderBy("file", "block_no")
    numbered = flags.select("*", F.row_number().over(order).alias("n"), F.sum("heading").over(order).alias("part"))
    within = Window.partitionBy("book_name", "part").orderBy("n")
    held = F.last(F.when(F.col("is_text"), F.col("unfinished")), ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, -1))
    # A tagged block begins a text of its own or joins one; only texts can be joined to, whole with their tag.
    joined = numbered.withColumn("joins", F.coalesce(F.col("tagged") & F.col("can_join") & held, F.lit(False)))
    joined = joined.withColumn("head", F.when(F.col("joins"), F.last(F.when(F.col("is_text") & ~F.col("joins"), F.col("n")), ignorenulls=True).over(within)).otherwise(F.col("n")))
    following = Window.partitionBy("book_name", "head").orderBy("n")
    joined = joined.withColumn("followed", F.lead(F.lit(True)).over(following)).withColumn("before_particle", F.lead("particle").over(following))
    joined = joined.withColumn("after_hyphen", F.lag("hyphen").over(following))
    if words is not None:
        # Flags are compact and read twice, so they are computed once. Joints are few, their spellings fewer, and blocks without one meet no words.
        joined = computed(joined.withColumn("after", F.coalesce(F.lead("begins").over(following), F.lit(""))).drop("before_particle"))
        joint = (F.col("before") != "") & (F.col("after") != "")
        decided = joined.filter(joint).join(hyphens.decisions(joined.filter(joint), words), ["before", "after"]).withColumnRenamed("keeps", "before_particle")
        joined = decided.unionByName(joined.filter(~joint).withColumn("before_particle", F.lit(False)))
    joined = joined.select(*key, "n", "head", "joins", "followed", "before_particle", "after_hyphen")
    whole = tagged.join(joined, key)
    own = F.when(F.col("joins"), F.col("rest")).otherwise(F.col("text"))
    ended = F.when(F.col("followed"), T.hyphen_resolved(T.stripped(own), F.col("before_particle"))).otherwise(own)
    sign = F.when(F.col("joins"), F.concat(F.col("marker"), F.when(F.col("after_hyphen"), "").otherwise(" "))).otherwise("")
    pieces = whole.groupBy("book_name", F.col("head").alias("n")).agg(F.array_sort(F.collect_list(F.struct(F.col("n"), F.concat(sign, ended).alias("t")))).alias("p"))
    return pieces.select("book_name", "n", F.array_join(F.transform("p", lambda x: x.t), "").alias("text"))


def split_headings(parts: DataFrame) -> DataFrame:
    """Blocks cut before each heading line inside: (book_name, n, sub, text)."""
    cut = F.split("text", r"\n(?=[ \t]*#)")
    return parts.select("book_name", "n", F.posexplode(cut).alias("sub", "text")).withColumn("text", T.stripped(F.col("text")))


def chapters(parts: DataFrame, level: int = 0) -> DataFrame:
    """(book_name, chapter_no, name, text) from blocks (book_name, n, sub, text); level 0 splits at each book's deepest one.

    A chapter begins at a heading of the level and at one above it; those above are repeated on top, deeper ones lose their signs,
    and chapters without text are left out and not counted.
    """
    key = ["book_name", "n", "sub"]
    book = Window.partitionBy("book_name")
    order = book.orderBy("n", "sub")
    head_line = r"(?s)\A((?:[ \t]*#[^\n]*(?:\n|\z))*)(.*)\z"
    under = F.nullif(T.stripped(F.regexp_extract("text", head_line, 2)), F.lit(""))
    # Windows take levels and heading lines; the texts are joined back.
    d = parts.select(*key, T.heading_level(F.col("text")).alias("level"), F.when(F.col("text").startswith("#"), T.stripped(F.regexp_extract("text", head_line, 1))).alias("line"))
    d = d.withColumn("at", F.lit(level) if level else F.coalesce(F.max("level").over(book), F.lit(1)))
    d = d.withColumn("parent", F.coalesce(F.col("level") < F.col("at"), F.lit(False))).withColumn("splits", F.coalesce(F.col("level") <= F.col("at"), F.lit(False)))
    d = d.withColumn("chapter", F.sum(F.col("splits").cast("int")).over(order)).withColumn("place", F.row_number().over(order))
    # The parent of each level in force: the last one of the level after the last one of a smaller level.
    for k in range(1, 7):
        at = lambda cond: F.max(F.when(F.col("parent") & cond, F.col("place"))).over(order)
        own = F.last(F.when(F.col("parent") & (F.col("level") == k), F.col("line")), ignorenulls=True).over(order)
        d = d.withColumn(f"_h{k}", F.when(at(F.col("level") == k) > F.coalesce(at(F.col("level") < k), F.lit(0)), own))
    d = d.drop("line", "splits").join(parts.select(*key, "text"), key)
    content = F.when(F.col("parent"), under).when(F.col("level") > F.col("at"), F.regexp_replace("text", r"\A#{1,6}\s+", "")).otherwise(F.col("text"))
    title = F.when(F.col("level") == F.col("at"), F.col("text"))
    d = d.withColumn("content", content)
    g = d.groupBy("book_name", "chapter").agg(
        F.max(has_text(F.col("content"))).alias("real"), F.max(title).alias("title"), F.array_sort(F.collect_list(F.when(F.col("content").isNotNull(), F.struct("place", F.col("content").alias("t"))))).alias("body"),
        *[F.max_by(f"_h{k}", "place").alias(f"_h{k}") for k in range(1, 7)],
    ).filter("real")
    heads = F.filter(F.array(*[F.col(f"_h{k}") for k in range(1, 7)]), lambda x: x.isNotNull())
    deepest = F.when(F.size(heads) > 0, F.element_at(heads, -1))
    name = F.coalesce(T.heading_file_name(F.coalesce("title", deepest)), F.lit(INTRODUCTION))
    numbers = g.select("book_name", "chapter").withColumn("chapter_no", F.row_number().over(Window.partitionBy("book_name").orderBy("chapter")))
    number = F.col("chapter_no")
    text = F.array_join(F.concat(heads, F.transform("body", lambda x: x.t)), "\n\n")
    return g.join(numbers, ["book_name", "chapter"]).select("book_name", number, F.concat(F.lpad(number.cast("string"), 2, "0"), F.lit("_"), name).alias("name"), text.alias("text"))


def has_text(content: Column) -> Column:
    """Whether a chapter's content has a line that is neither blank nor a heading."""
    return F.exists(F.split(F.coalesce(content, F.lit("")), "\n"), lambda x: (T.stripped(x) != "") & ~T.stripped(x).startswith("#"))


def merged(pages: DataFrame, level: int = 0, words: DataFrame | None = None) -> DataFrame:
    """Pages to chapters."""
    return chapters(split_headings(stitched(blocks(pages), words)), level)
