"""Readers and writers of the stage folders: book/stage/NNN.ext."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_SCHEMA = (
    "text string, metadata struct<chunk_type: string, headers: map<string, string>, page_numbers: array<int>, source_file: string, full_content: string, chunk_index: int, "
    "table_refs: array<string>, figure_refs: array<string>, table_id: string, figure_id: string, book_name: string, author: string, title: string, year: string>"
)


def _parts(path: Column) -> dict[str, Column]:
    part = lambda k: F.url_decode(F.element_at(F.split(path, "/"), k))
    return {"file": part(-1), "stem": F.regexp_replace(part(-1), r"\.[^.]*\z", "")}


def book_of(path: Column, stage: str) -> Column:
    """The folder above the stage folder."""
    return F.url_decode(F.regexp_extract(path, rf"([^/]+)/{stage}/", 1))


def read_pages(spark: SparkSession, root: str, stage: str, books: list[str] | None = None) -> DataFrame:
    """(book_name, file, page_no, text) of root/<book>/<stage>/**.md; hidden folders are left out."""
    df = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(f"{root}/*/{stage}")
    path = F.input_file_name()
    d = df.select(book_of(path, stage).alias("book_name"), _parts(path)["file"].alias("file"), F.col("value").alias("text"))
    d = d.filter(~F.col("book_name").startswith("."))
    d = d.filter(F.col("book_name").isin(books)) if books is not None else d
    return d.select("book_name", "file", F.regexp_extract("file", r"(\d+)", 1).try_cast("int").alias("page_no"), "text")


def read_images(spark: SparkSession, root: str, stage: str, extensions: tuple[str, ...] = ("jpg", "jpeg", "png")) -> DataFrame:
    """(book_name, file, stem, bytes, content) of a stage's images, the extension in any case."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/*/{stage}")
    d = df.select(book_of(F.col("path"), stage).alias("book_name"), *[c.alias(n) for n, c in _parts(F.col("path")).items()], F.col("length").alias("bytes"), "content")
    return d.filter(F.lower("file").rlike(r"\.(" + "|".join(extensions) + r")\z"))


def pages_with_images(pages: DataFrame, images: DataFrame, extensions: tuple[str, ...] = ("jpg", "jpeg", "png")) -> DataFrame:
    """Pages joined to their image by stem; of several the first extension in the list."""
    rank = F.array_position(F.array(*[F.lit(x) for x in extensions]), F.lower(F.element_at(F.split("file", r"\."), -1)))
    one = images.groupBy("book_name", "stem").agg(F.min_by("file", rank).alias("image_file"))
    return pages.withColumn("stem", F.regexp_replace("file", r"\.[^.]*\z", "")).join(one, ["book_name", "stem"])


def preferred(first: DataFrame, second: DataFrame) -> DataFrame:
    """Pages of the first stage, and of the second those that the first lacks."""
    return first.unionByName(second.join(first.select("book_name", "file"), ["book_name", "file"], "left_anti"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk files: JSON lists; a file that holds no list gives no rows."""
    return spark.read.schema(CHUNK_SCHEMA).option("multiLine", True).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).json(path).filter("metadata is not null")


def write_chunks(chunks: DataFrame, path: str) -> None:
    """One partition a book and kind; a rerun replaces the partitions that it writes, and only these."""
    chunks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("book_name", "chunk_type").parquet(path)


def image_descriptions(raw: DataFrame, mode: str = "compat") -> DataFrame:
    """raw (book_name, value) JSON as (book_name, image, description): a map, or a list of records.

    mode compat reads name and description of the records, which their writer calls image_filename and ai_description, so the names are img_i and
    the descriptions empty; intended reads both.
    """
    as_map = F.from_json("value", "map<string, string>")
    as_list = F.from_json("value", "array<struct<name: string, description: string, image_filename: string, ai_description: string>>")
    is_list = F.ltrim("value").startswith("[")
    other = (lambda x, y: x) if mode == "compat" else (lambda x, y: F.coalesce(x, y))
    records = F.transform(as_list, lambda r, i: F.struct(F.coalesce(other(r.getField("name"), r.image_filename), F.concat(F.lit("img_"), i.cast("string"))).alias("image"), F.coalesce(other(r.description, r.ai_description), F.lit("")).alias("description")))
    entries = F.transform(F.map_entries(as_map), lambda e: F.struct(e.key.alias("image"), e.value.alias("description")))
    return raw.select("book_name", F.explode(F.when(is_list, records).otherwise(entries)).alias("x")).select("book_name", "x.*")


def page_offsets(files: DataFrame) -> DataFrame:
    """files (book_name, file, pages) with first_page: where each input's pages begin in the book's numbering."""
    from pyspark.sql.window import Window

    before = Window.partitionBy("book_name").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_page", F.coalesce(F.sum("pages").over(before), F.lit(0)) + 1)


def read_tei(spark: SparkSession, path: str) -> DataFrame:
    """(file, value) of TEI documents, whole."""
    return spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path).select(_parts(F.input_file_name())["file"].alias("file"), "value")


def citation_contexts(tei: DataFrame, width: int = 400) -> DataFrame:
    """(file, ref_id, marker, context) of the references in a TEI body: the text around each marker."""
    body = F.regexp_extract("value", r"(?s)<body\b[^>]*>(.*)</body>", 1)
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", " "), r"\s+", " ")
    parts = F.split(body, r"""(?=<ref type="bibr")""")
    each = tei.select("file", F.posexplode(parts).alias("at", "part"), parts.alias("parts")).filter(F.col("part").startswith("<ref"))
    marker = bare(F.regexp_extract("part", r"(?s)\A<ref\b[^>]*>(.*?)</ref>", 1))
    before = F.right(bare(F.array_join(F.slice("parts", F.lit(1), F.col("at")), "")), F.lit(width // 2))
    after = F.left(bare(F.regexp_replace("part", r"(?s)\A<ref\b[^>]*>.*?</ref>", "")), F.lit(width // 2))
    return each.select("file", F.regexp_extract("part", r'target="#([^"]*)"', 1).alias("ref_id"), marker.alias("marker"), F.concat(before, marker, after).alias("context"))


def stage_books(pages: DataFrame) -> DataFrame:
    """(book_name, files) of a stage."""
    return pages.groupBy("book_name").agg(F.count("*").alias("files"))


def with_crops(pages: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pages whose stem has a file of boxes (book_name, stem)."""
    return pages.withColumn("stem", F.regexp_replace("file", r"\.[^.]*\z", "")).join(boxes.select("book_name", "stem"), ["book_name", "stem"], "left_semi")


def write_stage(df: DataFrame, path: str) -> None:
    """A stage table by book; a rerun replaces the books that it has, and the stage that was read stays as it is."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("book_name").parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Adds rows to the step log."""
    rows.write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """A report as CSV with a header; lists are joined by semicolons."""
    flat = [F.array_join(F.col(n).cast("array<string>"), "; ").alias(n) if t.startswith("array") else F.col(n) for n, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def listing(spark: SparkSession, path: str, extensions: tuple[str, ...]) -> DataFrame:
    """(path, file, stem, bytes) of the files under a path, or a pattern of paths, with one of the extensions in any case; contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    d = df.select("path", *[c.alias(n) for n, c in _parts(F.col("path")).items()], F.col("length").alias("bytes"))
    return d.filter(F.lower("file").rlike(r"\.(" + "|".join(extensions) + r")\z"))


def book_files(spark: SparkSession, root: str, stage: str, extensions: tuple[str, ...], books: list[str] | None = None) -> DataFrame:
    """(book_name, file, stem, bytes) of root/<book>/<stage>: the images of a contents folder (convert_in_jpg/toc), the split files of a book (split_pdf)."""
    d = listing(spark, f"{root}/*/{stage}", extensions).withColumn("book_name", book_of(F.col("path"), stage))
    d = d.filter(F.col("book_name").isin(books)) if books is not None else d
    return d.select("book_name", "file", "stem", "bytes")


def parsed_stems(spark: SparkSession, root: str) -> DataFrame:
    """(stem): the folders under root with a Markdown file in them, which are the articles already parsed."""
    found = listing(spark, f"{root}/*/*.md", ("md",))
    return found.select(F.url_decode(F.element_at(F.split("path", "/"), -2)).alias("stem")).distinct()


def available(names: DataFrame, *listings: DataFrame, on: str = "file") -> DataFrame:
    """The rows of names that one of the listings (a cache, a source) has."""
    every = listings[0].select(on)
    for more in listings[1:]:
        every = every.unionByName(more.select(on))
    return names.join(every, on, "left_semi")
