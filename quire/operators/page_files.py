"""Tables and figure captions of single pages as files, and the text that is left: expressions over a page, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.extraction import FIGURE_START_PATTERN, unwrapped

# How far above a table its caption may stand, what a paragraph may have to be one, and what lines there look like.
CAPTION_LINES, REMOVED_LINES = 12, 11
PARAGRAPH, LAST_PART = 500, 200
HTML_TABLE = r"(?is)<table\b.*?</table>"
PIPE_ROWS = r"(?md)^\|[^\n]*(?:\n\|[^\n]*)*"
INNER_CAPTION = r"(?is)<caption[^>]*>(.*?)</caption>"
CAPTION = r"(?s)Таблица\s+\d+[.\d]*.*"
NOTE = r"\A(?:\*|<p>\*)"
TABLE_PARTS = ("</table", "</tbody", "</thead", "<td", "</td", "<th", "</th", "<tr", "</tr")
LEAST_ROWS = 3


def occurrences(text: Column, pattern: str) -> Column:
    """array of struct(start, end, found): the matches of a pattern with their places, from 0."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    before = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.arrays_zip(F.slice(before, 1, F.size(found)).alias("gap"), found.alias("found"))
    kind = "array<struct<start:int,end:int,found:string>>"

    def add(a: Column, x: Column) -> Column:
        start = a["at"] + x["gap"]
        end = start + F.length(x["found"])
        return F.struct(end.alias("at"), F.concat(a["all"], F.array(F.struct(start.alias("start"), end.alias("end"), x["found"].alias("found")))).alias("all"))

    empty = F.array().cast(kind)
    return F.when(F.size(found) > 0, F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("all")), add, lambda a: a["all"])).otherwise(empty)


def tables_in_page(text: Column) -> Column:
    """array of struct(start, end, type, inner, body): HTML tables, and runs of pipe rows with a separator, in page order. A run ends behind its newline."""

    def markup(x: Column) -> Column:
        table = x["found"]
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.lit("html").alias("type"), T.stripped(F.regexp_extract(table, INNER_CAPTION, 1)).alias("inner"),
            F.when(table.rlike(INNER_CAPTION), T.stripped(F.regexp_replace(table, rf"{INNER_CAPTION}(.*)\z", "$2"))).otherwise(table).alias("body"),
        )

    def rows(x: Column) -> Column:
        return F.struct(x["start"].alias("start"), (x["end"] + 1).alias("end"), F.lit("markdown").alias("type"), F.lit("").alias("inner"), x["found"].alias("body"))

    lines = lambda x: F.split(x["found"], "\n")
    separated = lambda x: F.exists(lines(x), lambda r: T.stripped(r).rlike(r"\A\|[\s\-:|]+\|?\z"))
    pipes = F.filter(occurrences(text, PIPE_ROWS), lambda x: (F.size(lines(x)) >= LEAST_ROWS) & separated(x))
    return F.array_sort(F.concat(F.transform(occurrences(text, HTML_TABLE), markup), F.transform(pipes, rows)))


def is_table_part(line: Column) -> Column:
    """Whether a line without page tags belongs to an HTML table that has begun above it."""
    out = F.lit(False)
    for start in TABLE_PARTS:
        out = out | line.startswith(start)
    return out


def line_kinds(lines: Column) -> Column:
    """A sign for each line: c: has a caption, b: blank but for page tags, h: of an HTML table, p: pipe row, t: begins an HTML table, o: other."""

    def kind(bare: Column) -> Column:
        return (
            F.when(bare.rlike(CAPTION), "c").when(bare == "", "b").when(is_table_part(bare), "h").when(bare.startswith("|"), "p").when(bare.startswith("<table"), "t").otherwise("o")
        )

    return F.array_join(F.transform(F.transform(lines, lambda x: T.stripped(T.without_page_tags(x))), kind), "")


def last_lines(text: Column, n: int) -> Column:
    """The last n lines, the lowest first."""
    lines = F.split(text, "\n")
    return F.reverse(F.slice(lines, F.greatest(F.size(lines) - (n - 1), F.lit(1)), F.lit(n)))


def caption_above(lines: Column, kinds: Column) -> Column:
    """The caption lines right above a place, blank lines and the rest of an earlier table between, with the lines that run into them; else null. lines has
    the last ones above, the lowest first, and kinds their line_kinds()."""
    skipped, taken = F.length(F.regexp_extract(kinds, r"\A([bh]*)c", 1)), F.length(F.regexp_extract(kinds, r"\A[bh]*(c[co]*)", 1))
    bare = lambda x: T.stripped(T.without_page_tags(x))
    said = lambda x: F.when(bare(x).rlike(CAPTION), F.regexp_extract(bare(x), CAPTION, 0)).otherwise(T.stripped(x))
    return F.when(taken > 0, F.nullif(F.array_join(F.reverse(F.transform(F.slice(lines, skipped + 1, taken), said)), "\n"), F.lit("")))


def last_paragraph(above: Column) -> Column:
    return T.stripped(F.element_at(F.split(above, r"(?U)\n\s*\n"), -1))


def shortened(paragraph: Column) -> Column:
    """A paragraph; of one over PARAGRAPH characters its last line."""
    line = F.coalesce(F.nullif(T.stripped(F.substring_index(paragraph, "\n", -1)), F.lit("")), F.concat(F.lit("..."), T.stripped(F.right(paragraph, F.lit(LAST_PART)))))
    return F.when(F.length(paragraph) > PARAGRAPH, line).otherwise(paragraph)


def page_tables(pages: DataFrame) -> DataFrame:
    """(book_name, file, idx, total, type, caption, body, start, end) of every table of pages without markers, in page order.

    The caption is the table's own, else that of the lines above, else the paragraph above. A page without tables gives no rows.
    """
    each = pages.withColumn("_t", tables_in_page(F.col("text"))).select("book_name", "file", "text", F.size("_t").alias("total"), F.posexplode("_t").alias("idx", "t"))
    # Each step is a column, so that it is computed once a table however often the next one names it.
    above = F.rtrim(F.substr(F.col("text"), F.lit(1), F.col("t.start")), F.lit(T.WHITE_SPACE))
    each = each.select("book_name", "file", "idx", "total", "t", above.alias("above")).withColumn("lines", last_lines(F.substring_index("above", "\n", -CAPTION_LINES), CAPTION_LINES))
    each = each.withColumn("kinds", line_kinds(F.col("lines")))
    each = each.withColumn("said", F.coalesce(F.nullif(F.col("t.inner"), F.lit("")), caption_above(F.col("lines"), F.col("kinds"))))
    each = each.withColumn("last", F.when(F.col("said").isNull(), last_paragraph(F.col("above"))))
    return each.select("book_name", "file", "idx", "total", "t.type", F.coalesce("said", shortened(F.col("last"))).alias("caption"), "t.body", "t.start", "t.end")


def stem(file: Column) -> Column:
    return F.regexp_replace(file, r"\.[^.]*\z", "")


def page_table_files(pages: DataFrame) -> DataFrame:
    """(book_name, source_file, name, type, caption, text): one file for each table, named by its page."""
    name = T.output_name(T.page_of_stem(stem(F.col("file"))), F.col("idx") + 1, F.col("total"))
    text = F.concat(F.concat_ws("\n\n", F.nullif("caption", F.lit("")), "body"), F.lit("\n"))
    return page_tables(pages).select("book_name", F.col("file").alias("source_file"), name.alias("name"), "type", "caption", text.alias("text"))


def removal_range(text: Column, start: Column, end: Column) -> Column:
    """struct(start, end): a table's span with the captions above it and the notes below it."""
    before = F.substr(text, F.lit(1), start)
    lines = F.split(before, "\n")
    kinds = line_kinds(last_lines(before, REMOVED_LINES))
    above = F.length(F.regexp_extract(kinds, r"\A([bh]*c(?:[coth]*[cot])?)", 1))
    kept = F.size(lines) - above
    first = F.when(above > 0, F.length(F.array_join(F.slice(lines, 1, kept), "\n")) + F.when(kept > 0, 1).otherwise(0)).otherwise(start)
    after = F.split(F.substr(text, end + 1), "\n")
    note = lambda x: F.when(T.stripped(T.without_page_tags(x)) == "", "b").when(T.stripped(T.without_page_tags(x)).rlike(NOTE), "n").otherwise("o")
    below = F.length(F.regexp_extract(F.array_join(F.transform(after, note), ""), r"\A([bn]*)", 1))
    something = F.exists(after, lambda x: T.stripped(x) != "")
    last = F.when(something & (below > 0), end + F.length(F.array_join(F.slice(after, 1, below), "\n")) + 1).otherwise(end)
    return F.struct(first.alias("start"), F.least(last, F.length(text)).alias("end"))


def without_ranges(text: Column, ranges: Column) -> Column:
    """The text without the ranges (start, end), which may overlap, and without the gaps that they leave; unchanged without any."""

    def cut(a: Column, r: Column) -> Column:
        piece = F.when(r["start"] > a["at"], F.substr(text, a["at"] + 1, r["start"] - a["at"])).otherwise("")
        return F.struct(F.greatest(a["at"], r["end"]).alias("at"), F.concat(a["kept"], piece).alias("kept"))

    rest = lambda a: F.concat(a["kept"], F.coalesce(F.substr(text, a["at"] + 1), F.lit("")))
    kept = F.aggregate(F.array_sort(ranges), F.struct(F.lit(0).alias("at"), F.lit("").alias("kept")), cut, rest)
    return F.when(F.size(ranges) > 0, F.concat(T.stripped(F.regexp_replace(kept, r"\n{3,}", "\n\n")), F.lit("\n"))).otherwise(text)


def pages_without_tables(pages: DataFrame) -> DataFrame:
    """(book_name, file, text): pages without their tables, the tables' captions and notes."""
    text = F.col("text")
    ranges = F.transform(tables_in_page(text), lambda t: removal_range(text, t["start"], t["end"]))
    return pages.withColumn("_r", ranges).select("book_name", "file", without_ranges(text, F.col("_r")).alias("text"))


def marked_captions(text: Column, pattern: str = FIGURE_START_PATTERN) -> Column:
    """struct(captions, text): marked blocks that begin like a figure caption, and the text without them; other marked blocks lose their markers alone."""
    block = rf"(?s)\Q{T.FIGURE_START}\E(.*?)\Q{T.FIGURE_END}\E"
    found = F.transform(F.regexp_extract_all(text, F.lit(block), F.lit(1)), T.stripped)
    bare = lambda x: T.stripped(F.regexp_replace(x, r"<\d+>\s*", ""))
    is_caption = lambda x: unwrapped(T.stripped(F.split(bare(x), "\n")[0])).rlike(pattern)
    left = F.transform(found, lambda x: F.when(is_caption(x), "").otherwise(F.concat(bare(x), F.lit("\n"))))
    pieces = F.split(text, block, -1)
    joined = F.array_join(F.transform(pieces, lambda x, i: F.concat(x, F.coalesce(F.get(left, i), F.lit("")))), "")
    cleaned = F.concat(T.stripped(F.regexp_replace(joined, r"\n{3,}", "\n\n")), F.lit("\n"))
    return F.struct(F.filter(found, is_caption).alias("captions"), cleaned.alias("text"))


def paragraph_captions(text: Column, pattern: str = FIGURE_START_PATTERN) -> Column:
    """struct(captions, text): paragraphs that begin like a figure caption, and the text without them."""
    parts = F.split(text, "\n\n+")
    is_caption = lambda p: unwrapped(T.stripped(F.split(p, "\n")[0])).rlike(pattern)
    captions = F.transform(F.filter(parts, is_caption), lambda p: unwrapped(T.stripped(p)))
    left = F.concat(T.stripped(F.array_join(F.filter(parts, lambda p: ~is_caption(p)), "\n\n")), F.lit("\n"))
    return F.struct(captions.alias("captions"), left.alias("text"))


def figure_captions_of(text: Column, pattern: str = FIGURE_START_PATTERN) -> Column:
    """struct(captions, text): by markers where the text has both kinds, else by paragraphs."""
    marked = text.contains(T.FIGURE_START) & text.contains(T.FIGURE_END)
    return F.when(marked, marked_captions(text, pattern)).otherwise(paragraph_captions(text, pattern))


def page_caption_files(pages: DataFrame, pattern: str = FIGURE_START_PATTERN) -> DataFrame:
    """(book_name, source_file, name, text): one file for each figure caption of a page."""
    each = pages.withColumn("_c", paragraph_captions(F.col("text"), pattern)).select("book_name", "file", F.size("_c.captions").alias("total"), F.posexplode("_c.captions").alias("idx", "caption"))
    name = T.output_name(T.page_of_stem(stem(F.col("file"))), F.col("idx") + 1, F.col("total"))
    return each.select("book_name", F.col("file").alias("source_file"), name.alias("name"), F.concat("caption", F.lit("\n")).alias("text"))


def cleaned_pages(pages: DataFrame, pattern: str = FIGURE_START_PATTERN) -> DataFrame:
    """(book_name, file, text): pages without their figure captions."""
    return pages.select("book_name", "file", figure_captions_of(F.col("text"), pattern)["text"].alias("text"))


def chapter_caption_files(chapters: DataFrame, pattern: str = FIGURE_START_PATTERN) -> DataFrame:
    """(book_name, source_file, name, text, error): one file for each marked caption of a chapter, under the chapter's headings and named by its first page tag.

    A chapter without markers gives one row with the error no_markers; one with markers and no caption gives none.
    """
    text = F.col("text")
    marked = text.contains(T.FIGURE_START) & text.contains(T.FIGURE_END)
    found = F.when(marked, marked_captions(text, pattern)["captions"]).otherwise(F.array(F.lit(None).cast("string")))
    each = chapters.withColumn("_m", marked).withColumn("_c", found).select("book_name", "file", "_m", "text", F.size("_c").alias("total"), F.posexplode("_c").alias("idx", "caption"))
    heads = F.nullif(F.array_join(T.heading_lines(text), "\n"), F.lit(""))
    whole = F.concat(F.concat_ws("\n\n", heads, T.stripped(T.without_page_tags(F.col("caption")))), F.lit("\n"))
    name = T.output_name(T.first_page(F.col("caption")), F.col("idx") + 1, F.col("total"))
    return each.select(
        "book_name", F.col("file").alias("source_file"), F.when(F.col("_m"), name).alias("name"), F.when(F.col("_m"), whole).alias("text"), F.when(~F.col("_m"), "no_markers").alias("error")
    )


def run_counts(results: DataFrame, error: str = "error", skipped: str | None = None) -> DataFrame:
    """(successes, errors, skipped) of a run's rows: what every corpus run reports."""
    left_out = F.col(skipped) if skipped else F.lit(False)
    return results.agg(
        F.count_if(F.col(error).isNull() & ~left_out).alias("successes"), F.count_if(F.col(error).isNotNull() & ~left_out).alias("errors"), F.count_if(left_out).alias("skipped")
    )
