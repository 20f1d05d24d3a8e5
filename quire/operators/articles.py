"""Articles: TEI metadata and references, citations joined to them, merged parts, lists and statistics; tables out of model answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

# The fields by which a search may be sorted.
SORTS = ("relevance", "submitted", "updated")


def _inner(text: Column, tag: str) -> Column:
    """The text of the first element with that tag, without markup and with single blanks; null if there is none."""
    found = F.regexp_extract(text, rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(found, r"<[^>]+>", " "), r"\s+", " ")), F.lit(""))


def _names(text: Column) -> Column:
    """The people of an element: forenames and surname."""
    people = F.regexp_extract_all(text, F.lit(r"(?s)<persName\b[^>]*>(.*?)</persName>"), F.lit(1))
    return F.transform(people, lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, r"<[^>]+>", " "), r"\s+", " ")))


def metadata(tei: DataFrame) -> DataFrame:
    """(file, title, authors, year, abstract, doi) from the headers of TEI documents (file, value)."""
    head = F.regexp_extract("value", r"(?s)<teiHeader\b[^>]*>(.*?)</teiHeader>", 1)
    doi = F.nullif(F.regexp_extract(head, r'(?s)<idno type="DOI">\s*(.*?)\s*</idno>', 1), F.lit(""))
    year = F.nullif(F.regexp_extract(head, r'<date\b[^>]*when="(\d{4})', 1), F.lit(""))
    return tei.select("file", _inner(head, "title").alias("title"), _names(head).alias("authors"), year.alias("year"), _inner(head, "abstract").alias("abstract"), doi.alias("doi"))


def bibliography(tei: DataFrame) -> DataFrame:
    """(file, ref_id, title, authors, year) of the reference lists."""
    entries = F.regexp_extract_all("value", F.lit(r"(?s)(<biblStruct\b[^>]*xml:id=.*?</biblStruct>)"), F.lit(1))
    each = tei.select("file", F.explode(entries).alias("b"))
    year = F.nullif(F.regexp_extract("b", r'<date\b[^>]*when="(\d{4})', 1), F.lit(""))
    return each.select("file", F.regexp_extract("b", r'xml:id="([^"]*)"', 1).alias("ref_id"), _inner(F.col("b"), "title").alias("title"), _names(F.col("b")).alias("authors"), year.alias("year"))


def cited(contexts: DataFrame, references: DataFrame) -> DataFrame:
    """Citation contexts (file, ref_id, ...) with the reference that they name, or without."""
    return contexts.join(references, ["file", "ref_id"], "left")


def merged_parts(parts: DataFrame) -> DataFrame:
    """parts (file, part, text, images, formulas) of articles converted in pieces, in order: texts joined by a blank line, counts summed."""
    rows = parts.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("p"), F.sum("images").alias("images"), F.sum("formulas").alias("formulas"))
    return rows.select("file", F.array_join(F.transform("p", lambda x: x.text), "\n\n").alias("text"), "images", "formulas")


def joined_contents(pages: DataFrame) -> DataFrame:
    """(book_name, text): the answers for a book's contents pages, in order, blank ones left out."""
    some = pages.filter(T.stripped(F.col("text")) != "")
    rows = some.groupBy("book_name").agg(F.array_sort(F.collect_list(F.struct("file", "text"))).alias("p"))
    return rows.select("book_name", F.array_join(F.transform("p", lambda x: T.stripped(x.text)), "\n").alias("text"))


def search(articles: DataFrame, limit: int, sort: str = "submitted", ascending: bool = False) -> DataFrame:
    """The first articles (arxiv_id, published, updated, ...) by a date; relevance keeps the identifier's order."""
    if sort not in SORTS:
        raise ValueError(f"sort by one of {SORTS}")
    by = F.col({"submitted": "published", "updated": "updated", "relevance": "arxiv_id"}[sort])
    return articles.orderBy(by.asc() if ascending or sort == "relevance" else by.desc(), "arxiv_id").limit(limit)


def to_download(articles: DataFrame, log: DataFrame, files: DataFrame) -> DataFrame:
    """Articles that are not both in the log (arxiv_id) and present as a file (file)."""
    there = log.select("arxiv_id", T.article_file_name(F.col("arxiv_id")).alias("file")).join(files.select("file"), "file", "left_semi")
    return articles.join(there.select("arxiv_id"), "arxiv_id", "left_anti")


def sheet(articles: DataFrame) -> DataFrame:
    """Articles as rows of a sheet: lists joined by semicolons, dates as text."""
    dates = [F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("published", "updated")]
    return articles.select("arxiv_id", "title", F.array_join("authors", "; ").alias("authors"), *dates, F.array_join("categories", "; ").alias("categories"), T.article_file_name(F.col("arxiv_id")).alias("pdf_file"))


def folder_statistics(files: DataFrame) -> DataFrame:
    """files (folder, file, bytes): files and bytes of each folder, and of all with a null name."""
    return files.rollup("folder").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), T.format_bytes(F.sum("bytes")).alias("size"))


TABLES = "array<struct<caption: string, html: string>>"


def answered_tables(answers: DataFrame) -> DataFrame:
    """(book_name, file, idx, caption, html) of a model's answers: JSON, JSON with stray line breaks and commas mended, else whatever tables there are.

    Of the captions before a table without JSON the first is taken, as observed.
    """
    bare = F.trim(F.regexp_replace("answer", r"(?m)^\s*```(?:json)?\s*$", ""))
    mended = F.regexp_replace(F.regexp_replace(bare, r"[\r\n\t]+", " "), r",\s*([\]}])", "$1")
    plain = F.transform(T.html_tables(F.col("answer")), lambda t, i: F.struct(F.when(i == 0, F.coalesce(T.nullif_empty(F.regexp_extract("answer", r"(?m)^\s*((?:Таблица|Табл\.)[^\n<]*)", 1)), F.lit(""))).otherwise("").alias("caption"), t.alias("html")))
    found = F.coalesce(F.from_json(bare, TABLES), F.from_json(mended, TABLES), plain)
    kept = F.filter(found, lambda t: t.html.isNotNull())
    return answers.select("book_name", "file", F.posexplode(kept).alias("idx", "t")).select("book_name", "file", "idx", "t.caption", "t.html")
