"""Tables and figure captions out of chapters and pages, and summaries of tables."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType
from pyspark.sql.window import Window

from quire.functions import text as T

FIGURE_START_PATTERN = r"(?iuU)\A(Рис\.|Рисунок)\s*\d+"
KEY_VALUES, VALUE_LENGTH, FALLBACK = 30, 80, 500


def html_tables(pages: DataFrame) -> DataFrame:
    """(book_name, file, idx, caption, body) of the HTML tables of pages; an inner caption is taken out of the body."""
    each = pages.select("book_name", "file", F.posexplode(T.html_tables(F.col("text"))).alias("idx", "body"))
    caption = r"(?is)<caption[^>]*>(.*?)</caption>"
    return each.select("book_name", "file", "idx", T.stripped(F.regexp_extract("body", caption, 1)).alias("caption"), T.stripped(F.regexp_replace("body", caption, "")).alias("body"))


def lines(pages: DataFrame) -> DataFrame:
    return pages.select("book_name", "file", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def pipe_tables(pages: DataFrame, least: int = 3) -> DataFrame:
    """(book_name, file, first_line, n_lines, body): runs of at least so many pipe rows of which one is a separator."""
    rows = lines(pages).withColumn("bare", T.stripped(T.without_page_tags(F.col("line")))).filter(F.col("bare").startswith("|"))
    page = Window.partitionBy("book_name", "file")
    run = rows.withColumn("run", F.col("line_no") - F.row_number().over(page.orderBy("line_no")))
    found = run.groupBy("book_name", "file", "run").agg(
        F.min("line_no").alias("first_line"), F.count("*").alias("n_lines"), F.max(F.col("bare").rlike(r"\A\|[\s\-:|]+\|?\z")).alias("separated"),
        F.array_sort(F.collect_list(F.struct("line_no", "bare"))).alias("rows"),
    ).filter(f"separated and n_lines >= {least}")
    return found.select("book_name", "file", "first_line", "n_lines", F.array_join(F.transform("rows", lambda r: r.bare), "\n").alias("body"))


def captioned(pages: DataFrame, tables: DataFrame, back: int = 12) -> DataFrame:
    """tables (book_name, file, first_line, ...) with the last caption line in the so many lines above, or null."""
    marks = lines(pages).filter(T.is_caption_line(F.col("line"))).select("book_name", "file", "line_no", T.stripped(T.without_page_tags(F.col("line"))).alias("above"))
    rows = tables.select("book_name", "file", F.col("first_line").alias("line_no"), F.struct(*tables.columns).alias("row"))
    above = Window.partitionBy("book_name", "file").orderBy("line_no").rangeBetween(-back, -1)
    both = rows.unionByName(marks, allowMissingColumns=True).withColumn("caption", F.last("above", ignorenulls=True).over(above))
    return both.filter("row is not null").select("row.*", "caption")


def extracted_tables(chapters: DataFrame) -> DataFrame:
    """(book_name, name, idx, file, caption, body, text) of marked tables: the file's text has the chapter's headings on top."""
    each = chapters.select("book_name", "name", "text", F.posexplode(T.marked_blocks(F.col("text"))).alias("idx", "block"))
    total = F.count("*").over(Window.partitionBy("book_name", "name"))
    block = T.stripped(F.col("block"))
    whole = T.stripped(T.without_page_tags(block))
    body = F.coalesce(T.table_body(whole), whole)
    heads = F.array_join(T.heading_lines(F.col("text")), "\n")
    return each.select(
        "book_name", "name", "idx", T.output_name(T.page_range(block), F.col("idx") + 1, total).alias("file"), T.caption_before_table(whole).alias("caption"), body.alias("body"),
        F.concat_ws("\n\n", F.nullif(heads, F.lit("")), whole).alias("text"),
    )


def unwrapped(text: Column) -> Column:
    """A caption without page tags, centring or figcaption around it, and bold signs."""
    t = F.regexp_replace(F.regexp_replace(text, r"<\d+>\s*", ""), r"\A<(?:center|figcaption)[^>]*>\s*", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\s*</(?:center|figcaption)>\s*\z", ""), r"\A\*\*", "")
    return T.stripped(F.regexp_replace(t, r"(?s)\A(.*?)\*\*", "$1"))


def figure_captions(pages: DataFrame, pattern: str = FIGURE_START_PATTERN) -> DataFrame:
    """(book_name, file, idx, caption): the paragraphs whose first line begins like a figure caption."""
    parts = pages.select("book_name", "file", F.posexplode(F.split("text", "\n\n+")).alias("at", "part"))
    first = unwrapped(T.stripped(F.split("part", "\n").getItem(0)))
    found = parts.filter(first.rlike(pattern))
    idx = F.row_number().over(Window.partitionBy("book_name", "file").orderBy("at"))
    return found.select("book_name", "file", idx.alias("idx"), unwrapped(T.stripped(F.col("part"))).alias("caption"))


def without_captions(text: Column, pattern: str = FIGURE_START_PATTERN) -> Column:
    """The text without such paragraphs."""
    kept = F.filter(F.split(text, "\n\n+"), lambda p: ~unwrapped(T.stripped(F.split(p, "\n").getItem(0))).rlike(pattern))
    return F.concat(T.stripped(F.array_join(kept, "\n\n")), F.lit("\n"))


def figure_number(caption: Column) -> Column:
    return F.regexp_extract(caption, r"(?iu)Рис(?:унок|\.)\s*(\d+)", 1).try_cast("long")


def missing_figures(captions: DataFrame) -> DataFrame:
    """(book_name, largest, missing, unnumbered): the gaps (first, last) in the numbers of the book's captions, from 1 to the largest."""
    counted = captions.groupBy("book_name", figure_number(F.col("caption")).alias("number")).agg(F.count("*").alias("n"))
    before = F.lag("number", 1, 0).over(Window.partitionBy("book_name").orderBy(F.col("number").asc_nulls_first()))
    gap = F.when(F.col("number") - F.col("before") > 1, F.struct((F.col("before") + 1).alias("first"), (F.col("number") - 1).alias("last")))
    gaps = counted.withColumn("before", F.coalesce(before, F.lit(0).cast("long"))).groupBy("book_name").agg(
        F.max("number").alias("largest"), F.array_sort(F.collect_list(gap)).alias("missing"), F.coalesce(F.sum(F.when(F.col("number").isNull(), F.col("n"))), F.lit(0)).alias("unnumbered")
    )
    return gaps


def _shortened(value: Column) -> Column:
    v = T.stripped(value)
    return F.when(F.length(v) > VALUE_LENGTH, F.concat(F.substring(v, 1, VALUE_LENGTH), F.lit("..."))).otherwise(v)


@F.pandas_udf(ArrayType(StringType()))
def _unescaped(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else [html.unescape(x) for x in v])


def _cells(found: Column) -> Column:
    return F.filter(F.transform(_unescaped(F.transform(found, lambda x: F.regexp_replace(x, r"<[^>]+>", ""))), _shortened), lambda x: x != "")


def _keys(values: Column) -> Column:
    distinct = F.array_distinct(values)
    return F.when(F.size(distinct) >= KEY_VALUES, F.concat(F.slice(distinct, 1, KEY_VALUES), F.array(F.lit("...")))).otherwise(distinct)


def table_summary(text: Column) -> Column:
    """A table as labelled lines: headings, caption, columns, row groups and the first cells of its rows; other text by its first characters."""
    is_html = F.lower(text).contains("<table")
    is_pipe = text.rlike(r"(?m)^\s*\|(?:\s*[-:]+\s*\|)+\s*$")
    rows = F.transform(F.split(text, "\n"), T.stripped)
    first = F.array_position(F.transform(rows, lambda x: x.startswith("|") & x.endswith("|") & (F.length(x) > 2)), True).cast("int")
    above = F.when(is_html, F.transform(F.split(F.split(text, "<table").getItem(0), "\n"), T.stripped)).otherwise(F.slice(rows, 1, F.greatest(first - 1, F.lit(0))))
    heads = F.filter(above, lambda x: x.rlike(r"\A#{1,6}\s"))
    caption = F.filter(above, lambda x: (x != "") & ~x.startswith("#"))
    within = F.filter(F.slice(rows, F.greatest(first, F.lit(1)), F.size(rows)), lambda x: x.startswith("|"))
    cells = lambda x: F.transform(F.slice(F.split(x, r"\|"), 2, F.greatest(F.size(F.split(x, r"\|")) - 2, F.lit(0))), lambda c: F.trim(c))
    data = F.filter(within, lambda x: ~x.rlike(r"\A\|(?:\s*[-:]+\s*\|)+\z"))
    pipe_columns, pipe_keys = cells(F.get(data, F.lit(0))), F.filter(F.transform(F.slice(data, 2, F.greatest(F.size(data) - 1, F.lit(0))), lambda x: _shortened(F.get(cells(x), F.lit(0)))), lambda x: x != "")
    thead, tbody = F.regexp_extract(text, r"(?is)<thead>(.*?)</thead>", 1), F.regexp_extract(text, r"(?is)<tbody>(.*?)</tbody>", 1)
    html_columns = _cells(F.regexp_extract_all(thead, F.lit(r"(?s)<th>(.*?)</th>"), F.lit(1)))
    groups = _cells(F.regexp_extract_all(tbody, F.lit(r"""(?is)<th\s+colspan\s*=\s*["']?\d+["']?\s*>(.*?)</th>"""), F.lit(1)))
    html_keys = _cells(F.transform(F.regexp_extract_all(tbody, F.lit(r"(?is)<tr>(.*?)</tr>"), F.lit(1)), lambda r: F.regexp_extract(r, r"(?is)<td[^>]*>(.*?)</td>", 1)))
    columns, keys = F.when(is_html, html_columns).otherwise(pipe_columns), _keys(F.when(is_html, html_keys).otherwise(pipe_keys))
    label = lambda name, x: F.when(F.size(x) > 0, F.concat(F.lit(f"{name}: "), F.array_join(x, ", ")))
    joined = lambda x: F.nullif(F.array_join(x, "\n"), F.lit(""))
    told = F.concat_ws("\n", joined(heads), joined(caption), label("Столбцы", columns), F.when(is_html, label("Группы", groups)), label("Значения", keys))
    other = F.substring(F.array_join(F.filter(rows, lambda x: (x != "") & ~x.startswith("#")), "\n"), 1, FALLBACK)
    return F.when(is_html | is_pipe, told).otherwise(other)


def pending(tables: DataFrame, summaries: DataFrame, threshold: int = 1200) -> DataFrame:
    """Tables (book_name, file, text) with chars over the threshold that have no summary. Sort them where an order is shown."""
    large = tables.withColumn("chars", F.length("text")).filter(F.col("chars") > threshold)
    return large.join(summaries.select("book_name", "file"), ["book_name", "file"], "left_anti")


def not_done(items: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The items without an output: how every stage resumes."""
    return items.join(done.select(*keys).distinct(), keys, "left_anti")
