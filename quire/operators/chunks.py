"""Text, table and figure chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as T

CHUNK_SIZE, OVERLAP, LEAST_TAIL = 1200, 200, 400


def spans(length: Column, size: int = CHUNK_SIZE, overlap: int = OVERLAP, least: int = LEAST_TAIL) -> Column:
    """array of struct(s, e): the chunks of a text in closed form. A tail shorter than least is shared with the chunk before it."""
    if not 0 <= overlap <= size // 2 or overlap >= size:
        raise ValueError("the overlap must be from 0 to half the chunk size")
    step = size - overlap
    m = F.greatest(F.ceil((length - size) / step), F.lit(0)).cast("int")
    tail = length - m * step
    at = lambda s, e: F.struct(s.cast("int").alias("s"), e.cast("int").alias("e"))
    plain = F.transform(F.sequence(F.lit(0), m), lambda i: at(i * step, F.least(i * step + size, length)))
    before = F.when(m >= 2, F.transform(F.sequence(F.lit(0), F.greatest(m - 2, F.lit(0))), lambda i: at(i * step, i * step + size))).otherwise(F.array().cast("array<struct<s:int,e:int>>"))
    p = (m - 1) * step
    middle = p + F.floor((length - p) / 2)
    shared = F.concat(before, F.array(at(p, middle), at(middle - overlap, length)))
    return F.when((m == 0) | (tail >= least), plain).otherwise(shared)


def text_chunks(chapters: DataFrame, size: int = CHUNK_SIZE, overlap: int = OVERLAP, least: int = LEAST_TAIL) -> DataFrame:
    """chapters (book_name, source_file, text) as chunks: text, chunk_index, headers, page_numbers, table_refs, figure_refs, full_content.

    Page tags are removed but keep their places: a chunk has the pages whose tag lies in its span. A chapter without text gives none.
    """
    split = chapters.withColumn("_p", T.headers_and_body(F.col("text")))
    body = F.col("_p.body")
    pieces = F.split(body, T.PAGE_TAG)
    numbers = F.transform(F.regexp_extract_all(body, F.lit(T.PAGE_TAG), F.lit(1)), lambda x: x.try_cast(T.PAGE))
    split = split.withColumn("_pieces", pieces).withColumn("_numbers", numbers).withColumn("_clean", F.array_join("_pieces", ""))
    # The n-th tag's place is the length of what lies before it, without the tags themselves.
    state = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<pos:int,page:{T.PAGE}>>").alias("marks"))
    pages = F.arrays_zip(F.slice(F.transform("_pieces", F.length), 1, F.size("_numbers")).alias("n"), F.col("_numbers").alias("page"))
    marks = F.aggregate(pages, state, lambda a, x: F.struct((a.at + x["n"]).alias("at"), F.concat(a.marks, F.array(F.struct((a.at + x["n"]).alias("pos"), x["page"].alias("page")))).alias("marks")), lambda a: a.marks)
    split = split.withColumn("_marks", F.when(F.size("_numbers") > 0, marks).otherwise(state.marks))
    # Chunks are finished inside the array, so that nothing else of the chapter is copied into each of them.
    cut = lambda at: F.struct(
        F.substr(F.col("_clean"), at.s + 1, at.e - at.s).alias("text"),
        F.array_sort(F.array_compact(F.array_distinct(F.transform(F.filter("_marks", lambda m: (m.pos >= at.s) & (m.pos < at.e)), lambda m: m.page)))).alias("pages"),
    )
    # A filter on the clean text would be pushed down and all of it computed twice; without an array there are no chunks.
    done = F.when(T.has_text(F.col("_clean")), F.transform(spans(F.length("_clean"), size, overlap, least), cut))
    each = split.select("book_name", "source_file", F.col("_p.headers").alias("headers"), F.posexplode(done).alias("chunk_index", "c"))
    chunk = F.col("c.text")
    return each.select(
        "book_name", "source_file", F.lit("text").alias("chunk_type"), "chunk_index", chunk.alias("text"), "headers", F.col("c.pages").alias("page_numbers"),
        T.table_refs(chunk).alias("table_refs"), T.figure_refs(chunk).alias("figure_refs"), chunk.alias("full_content"),
    )


def slices(body: Column, size: int) -> Column:
    """Stripped pieces of size characters; blank ones are left out."""
    starts = F.when(F.length(body) > 0, F.sequence(F.lit(0), F.length(body) - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(starts, lambda i: T.stripped(F.substr(body, i + 1, F.lit(size)))), lambda x: x != "")


def packed(body: Column, size: int, mode: str = "compat") -> Column:
    """Pieces of a pipe table that fit size, each with the rows down to the separator on top; without a separator plain slices.

    mode compat knows separators of a single column alone, intended those of any.
    """
    lines = F.split(body, "\n")
    pattern = r"(?U)\A\|[\s\-:]+\|\z" if mode == "compat" else r"(?U)\A\|[\s\-:|]+\|?\z"
    at = F.array_position(F.transform(lines, lambda x: T.stripped(x).rlike(pattern)), True).cast("int")
    head = F.array_join(F.slice(lines, 1, F.greatest(at, F.lit(1))), "\n")
    rows = F.slice(lines, at + 1, F.greatest(F.size(lines) - at, F.lit(0)))
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n"))
    base = F.length(head) + 1

    def add(a: Column, x: Column) -> Column:
        full = (base + F.length(a.open) + F.when(a.n > 0, 1).otherwise(0) + F.length(x) + 1 > size) & (a.n > 0)
        return F.struct(
            F.when(full, F.concat(a.done, F.array(a.open))).otherwise(a.done).alias("done"),
            F.when(full | (a.n == 0), x).otherwise(F.concat(a.open, F.lit("\n"), x)).alias("open"),
            F.when(full, 1).otherwise(a.n + 1).alias("n"),
        )

    groups = F.aggregate(rows, empty, add, lambda a: F.when(a.n > 0, F.concat(a.done, F.array(a.open))).otherwise(a.done))
    return F.when((at > 0) & (F.size(rows) > 0), F.transform(groups, lambda g: F.concat(head, F.lit("\n"), g))).otherwise(slices(body, size))


def extracted_chunks(files: DataFrame, chunk_type: str, size: int = CHUNK_SIZE, mode: str = "compat") -> DataFrame:
    """files (book_name, source_file, text) of extracted tables or figures as chunks."""
    split = files.withColumn("_p", T.headers_and_body(F.col("text"))).withColumn("_body", T.stripped(T.without_page_tags(F.col("_p.body")))).filter("_body <> ''")
    parts = packed(F.col("_body"), size, mode) if chunk_type == "table" else slices(F.col("_body"), size)
    fits = F.length("_body") <= size
    each = split.select("*", F.posexplode(F.when(fits, F.array("_body")).otherwise(parts)).alias("chunk_index", "chunk"))
    own = lambda f, kind: F.when(fits & F.lit(chunk_type == kind), f(F.col("_body")))
    return each.select(
        "book_name", "source_file", F.lit(chunk_type).alias("chunk_type"), "chunk_index", F.col("chunk").alias("text"), F.col("_p.headers").alias("headers"),
        T.page_of_chunk_file(F.col("source_file")).alias("page_numbers"), F.col("_body").alias("full_content"),
        own(T.table_id, "table").alias("table_id"), own(T.figure_id, "figure").alias("figure_id"),
    )


def table_chunks(tables: DataFrame, summaries: DataFrame, threshold: int = CHUNK_SIZE) -> DataFrame:
    """One chunk for each table (book_name, source_file, text): its body if that fits, else its summary (book_name, source_file, summary), else its caption."""
    joined = tables.join(summaries, ["book_name", "source_file"], "left").withColumn("summary", F.coalesce("summary", F.lit("")))
    split = joined.withColumn("_p", T.headers_and_body(F.col("text"))).withColumn("_body", T.stripped(T.without_page_tags(F.col("_p.body"))))
    split = split.filter((F.col("_body") != "") | (T.stripped(F.col("summary")) != ""))
    body, small = F.col("_body"), F.length("_body") <= threshold
    spoken = F.coalesce(
        F.nullif(T.stripped(T.headers_and_body(F.col("summary")).body), F.lit("")), F.nullif(T.caption_before_table(body), F.lit("")), F.substring(body, 1, threshold)
    )
    return split.select(
        "book_name", "source_file", F.lit("table").alias("chunk_type"), F.lit(0).alias("chunk_index"), F.when(small, body).otherwise(spoken).alias("text"), F.col("_p.headers").alias("headers"),
        T.page_of_chunk_file(F.col("source_file")).alias("page_numbers"), body.alias("full_content"), F.when(small, T.table_id(body)).otherwise(T.table_id(F.col("text"))).alias("table_id"),
    )


def all_chunks(*kinds: DataFrame) -> DataFrame:
    """Chunks of all kinds under one schema; fields that a kind lacks are null."""
    out = kinds[0]
    for k in kinds[1:]:
        out = out.unionByName(k, allowMissingColumns=True)
    return out


def with_book(chunks: DataFrame, books: DataFrame | None = None) -> DataFrame:
    """chunks with author, title and year: from books (book_name, author, title, year) where it has the book, else from the name."""
    parsed = T.author_and_title(F.col("book_name"))
    if books is None:
        return chunks.select("*", parsed.author.alias("author"), parsed.title.alias("title"), F.lit(None).cast("string").alias("year"))
    own = books.select("book_name", F.lit(True).alias("_own"), *[F.col(c).alias(f"_{c}") for c in ("author", "title", "year")])
    joined = chunks.join(own, "book_name", "left")
    pick = lambda c, other: F.when(F.col("_own"), F.col(f"_{c}")).otherwise(other).alias(c)
    return joined.select(*chunks.columns, pick("author", parsed.author), pick("title", parsed.title), pick("year", F.lit(None)))


def referenced(chunks: DataFrame, kind: str = "table") -> DataFrame:
    """(book_name, source_file, chunk_index, ref, target_file): text chunks and the table or figure chunks that they mention."""
    mentions = chunks.filter("chunk_type = 'text'").select("book_name", "source_file", "chunk_index", F.explode(f"{kind}_refs").alias("ref"))
    targets = chunks.filter(F.col("chunk_type") == kind).select("book_name", F.col(f"{kind}_id").alias("ref"), F.col("source_file").alias("target_file"))
    return mentions.join(targets, ["book_name", "ref"])


# The bounds of the size ranges.
BUCKETS = ((500, "0–500"), (1000, "500–1000"), (1200, "1000–1200"), (1500, "1200–1500"), (2000, "1500–2000"), (None, "2000+"))


def size_bucket(chars: Column) -> Column:
    out = F.lit(BUCKETS[-1][1])
    for bound, name in reversed(BUCKETS[:-1]):
        out = F.when(chars < bound, name).otherwise(out)
    return out


def size_distribution(chunks: DataFrame, chars: Column) -> DataFrame:
    """(bucket, n) for every range, those without chunks included."""
    counts = chunks.groupBy(size_bucket(chars).alias("bucket")).agg(F.count("*").alias("n"))
    names = chunks.sparkSession.createDataFrame([(name,) for _, name in BUCKETS], "bucket string")
    return names.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def size_stats(chunks: DataFrame, chars: Column, *by: str) -> DataFrame:
    """Least, largest, median and mean size, the last two cut to whole numbers; the share over CHUNK_SIZE in percent."""
    over = F.count_if(chars > CHUNK_SIZE)
    return chunks.groupBy(*by).agg(
        F.count("*").alias("n"), F.min(chars).alias("least"), F.max(chars).alias("largest"), F.percentile(chars, F.lit(0.5)).cast("int").alias("median"),
        F.avg(chars).cast("int").alias("mean"), over.alias("oversized"), F.coalesce(F.round(100.0 * over / F.nullif(F.count("*"), F.lit(0)), 1), F.lit(0.0)).alias("oversized_percent"),
    )


def chunk_rows(chunks: DataFrame) -> DataFrame:
    """Adds the position of a chunk in its book, by file and index."""
    order = Window.partitionBy("book_name").orderBy("source_file", "chunk_index")
    return chunks.withColumn("position", (F.row_number().over(order) - 1).cast("int"))


def sizes_by_type(chunks: DataFrame, threshold: int = CHUNK_SIZE) -> DataFrame:
    """(book_name, chunk_type, n, chars, oversized), with the totals of each book, of each type and of all (nulls)."""
    chars = F.length("text")
    return chunks.cube("book_name", "chunk_type").agg(F.count("*").alias("n"), F.sum(chars).alias("chars"), F.count_if(chars > threshold).alias("oversized"))


def oversized(chunks: DataFrame, threshold: int = CHUNK_SIZE) -> DataFrame:
    """The chunks over the threshold with chars. Sort them where an order is shown."""
    return chunks.withColumn("chars", F.length("text")).filter(F.col("chars") > threshold)
