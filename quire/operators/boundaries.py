"""Markers around tables and figures, by expressions over the lines of a text.

Each line becomes one letter for what it is, so that how far a table, its footnotes or a figure's list go is a pattern over the string of letters. Every caption
has its own range then; a fold over the captions of a text, which are few, keeps those that begin behind the range before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions.text import FIGURE_END, FIGURE_START, TABLE_END, TABLE_START

# How many lines ahead a table's body, its footnotes and a figure's list are looked for.
BODY_AHEAD, NOTES_AHEAD, LIST_AHEAD = 30, 10, 15
# The patterns that the formats are defined by.
TAG = r"<\d+>"
CAPTION = r"\A(?:<\d+>\s*)?(?:Таблица|Табл\.)\s+\d+[.\d]*(?:\s|\z)"
GOES_ON = r"(?iu)\A(?:<\d+>\s*)?\*{0,2}(?:Окончание|Продолжение)\s+(?:табл\.|таблицы)\s+\d+"
GOES_ON_INSIDE = r"(?iu)(?:Окончание|Продолжение)\s+(?:табл\.|таблицы)"
MID_CAPTION = r"(?:Таблица|Табл\.)\s+\d+[.\d]*(?:\s|\z)|(?iu:\*{0,2}(?:Окончание|Продолжение)\s+(?:табл\.|таблицы)\s+\d+)"
NUMBER = r"(?:Таблица|[Тт]абл\.|таблицы|таблицу)\s+(\d+[.\d]*)"
SEPARATOR = r"\A\|[\s\-:|]+\|?\z"
NOTE = r"\A(?:<p>)?\\*\*"
OPENS, CLOSES = r"(?i)<table\b", r"(?i)</table\s*>"
FIGURE = r"Рис(?:унок|\.)\s+\d+[.\d]*\s"
FIGURE_BLOCK = r"(?is)<figure\b[^>]*>(.*?)</figure>"
FIGCAPTION = r"(?is)<figcaption>(.*?)</figcaption>"
IMAGE = r"!\[[^\]]*\]\([^)]+\)"
IMG = r"(?is)<img\b[^>]*/?>"
POSITION = r"\A\d+\s*[—–\-]\s"
ITEM = r"(?s)\A(?!- )(?:[а-яё].*|.*[—–].*|.*[;:])\z"
TABLE_ZONE = r"(?s)\[TABLE_START\].*?\[TABLE_END\]"

# Letters of lines in tables: a row for each kind (blank, footnote, separator, pipe row, other text), in it none, opens a table, closes one, does both.
BLANK, NOTES, SEPARATORS, ROWS, OTHERS = LETTERS = ("abcd", "efgh", "ijkl", "mnop", "qrst")
OPENING, CLOSING = ("".join(x[i] for x in LETTERS for i in places) for places in ((1, 3), (2, 3)))
PIPES = SEPARATORS + ROWS
_RUN = f"(?=[{PIPES}]{{3}})(?=[{PIPES}]*[{SEPARATORS}])"
# From the line under a caption: other lines, then an HTML table to where it closes, or three pipe rows and more with a separator.
TABLE_AHEAD = rf"\A((?:(?![{OPENING}])(?!{_RUN}).){{0,{BODY_AHEAD - 1}}}(?:[{OPENING}](?:(?<=[{CLOSING}])|[^{CLOSING}]*+[{CLOSING}])|{_RUN}[{PIPES}]++))"
NOTES_BEHIND = rf"\A([{BLANK}]*[{NOTES}]+)"
# Letters of lines under a figure: s no such line, p position, l list item, a both, o other text; in upper case where the list stays open behind it.
UNDER_CAPTION = r"\A([AaPp]*)"
UNDER_COLON = r"\A((?:[APL]|p[ap]*[AP])*(?:[al]|p[ap]*)?)"


def bare(line: Column) -> Column:
    return T.stripped(F.when(line.contains("<"), F.regexp_replace(line, TAG, "")).otherwise(line))


def each_line(lines: str, change: Callable[[Column], Column], where: Callable[[Column], Column]) -> Column:
    """An array of lines, of which those where a quick look allows it are changed into one or two."""
    changed = F.flatten(F.transform(lines, lambda x: F.when(where(x), change(x)).otherwise(F.array(x))))
    return F.when(F.exists(lines, where), changed).otherwise(F.col(lines))


def unmarked(text: Column, start: str, end: str) -> Column:
    return F.regexp_replace(text, rf"\Q{start}\E\n?|\n?\Q{end}\E", "")


def replaced(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """The text with each match of a pattern changed."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    return F.array_join(F.transform(between, lambda x, i: F.concat(x, F.coalesce(change(F.get(found, i)), F.lit("")))), "")


def has_group(x: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def caption_moved_out(block: Column) -> Column:
    """A table with what stands before it on its line: a caption inside moves to a line of its own above, with the page tag."""
    whole = r"(?is)\A([^\n]*?)(<table\b.*)\z"
    inner = r"(?is)\A(.*?)<caption>([^\n]*?)</caption>(.*)\z"
    head, table = F.regexp_extract(block, whole, 1), F.regexp_extract(block, whole, 2)
    said = T.stripped(F.regexp_extract(table, inner, 2))
    cut = F.split(F.regexp_replace(table, inner, "$1\x00$3"), "\n")
    left = F.filter(cut, lambda x: ~x.contains("\x00") | (bare(F.replace(x, F.lit("\x00"), F.lit(""))) != ""))
    left = F.transform(left, lambda x: F.when(x.contains("\x00"), F.regexp_replace(F.replace(x, F.lit("\x00"), F.lit("")), r"(?U)\s+\z", "")).otherwise(x))
    tag = has_group(F.concat(head, F.substring_index(table, "\n", 1)), f"({TAG})", 1)
    moved = F.concat(F.coalesce(F.concat(tag, F.lit(" ")), F.lit("")), said, F.lit("\n"), head, F.array_join(left, "\n"))
    return F.when(table.rlike(inner) & (said != ""), moved).otherwise(block)


def in_two(line: Column, first: Column, second: Column, wanted: Column) -> Column:
    """The line, or where it is wanted its two parts without white space between."""
    return F.when(F.coalesce(wanted, F.lit(False)), F.array(F.regexp_replace(first, r"(?U)\s+\z", ""), second)).otherwise(F.array(line))


def behind_table(line: Column) -> Column:
    at = r"(?is)\A(.*?</table\s*>)(.*)\z"
    rest = T.stripped(F.regexp_extract(line, at, 2))
    return in_two(line, F.regexp_extract(line, at, 1), rest, rest != "")


def behind_row(line: Column) -> Column:
    """Tagged text behind the last bar of a pipe row goes to a line of its own."""
    at = r"(?s)\A(.*\|)([^|]*)\z"
    rest = F.regexp_extract(line, at, 2)
    return in_two(line, F.regexp_extract(line, at, 1), T.stripped(rest), bare(line).startswith("|") & rest.rlike(TAG) & (bare(rest) != ""))


def before_caption(line: Column) -> Column:
    """A caption behind other text goes to a line of its own, with the tag right before it. Its place among the characters outside tags is found first; as many tags
    as lie before that place, with their lengths, lie before it in the line."""
    outside = F.regexp_replace(line, TAG, "")
    start = F.regexp_instr(T.stripped(outside), F.lit(MID_CAPTION)) - 1
    place = start + F.length(F.regexp_extract(outside, r"(?U)\A\s*", 0))
    pieces, tags = F.split(line, TAG, -1), F.regexp_extract_all(line, F.lit(f"({TAG})"), F.lit(1))
    state = F.struct(F.lit(0).alias("seen"), F.lit(0).alias("tags"))
    each = F.arrays_zip(F.transform(pieces, F.length).alias("n"), F.transform(tags, F.length).alias("tag"))
    passed = F.aggregate(each, state, lambda a, x: F.when(a.seen + x["n"] <= place, F.struct((a.seen + x["n"]).alias("seen"), (a.tags + F.coalesce(x["tag"], F.lit(0))).alias("tags"))).otherwise(F.struct((F.lit(1 << 30)).alias("seen"), a.tags.alias("tags"))))
    at = place + passed.tags
    before = F.regexp_replace(F.substr(line, F.lit(1), at), r"<\d+>\s*\z", "")
    return in_two(line, before, F.substr(line, F.length(before) + 1), (start > 0) & (T.stripped(before) != ""))


def letter(kinds: list[tuple[Column, str]], opens: Column, closes: Column) -> Column:
    out = F.lit(kinds[-1][1])
    for cond, letters in reversed(kinds[:-1]):
        out = F.when(cond, letters).otherwise(out)
    return F.substr(out, 1 + opens.cast("int") + 2 * closes.cast("int"), F.lit(1))


def table_letter(p: Column) -> Column:
    """Of a line without page tags."""
    kinds = [(p == "", BLANK), (p.rlike(NOTE), NOTES), (p.rlike(SEPARATOR), SEPARATORS), (p.startswith("|"), ROWS), (F.lit(True), OTHERS)]
    return letter(kinds, p.contains("<") & p.rlike(OPENS), p.contains("<") & p.rlike(CLOSES))


def figure_letter(line: Column) -> Column:
    position, item, open_ = line.rlike(POSITION), line.rlike(ITEM), line.rlike(r"[;:]\z")
    kind = F.when(position & item, "a").when(position, "p").when(item, "l").otherwise("o")
    none = (line == "") | line.startswith("#") | line.contains("[TABLE_") | line.contains("[FIGURE_") | line.rlike(FIGURE)
    return F.when(none, "s").when(open_ & (kind != "o"), F.upper(kind)).otherwise(kind)


def surrounded(lines: Column, ranges: Column, start: str, end: str) -> Column:
    """The lines with a marker before and after each range (first, last; places from 0) as one text."""
    part = lambda a, b: F.slice(lines, a + 1, F.greatest(b - a, F.lit(0)))
    behind = lambda k: F.coalesce(F.get(ranges, k).last + 1, F.lit(0))
    marked = F.transform(ranges, lambda r, k: F.concat(part(behind(k - 1), r["first"]), F.array(F.lit(start)), part(r["first"], r["last"] + 1), F.array(F.lit(end))))
    every = F.concat(F.flatten(marked), part(behind(F.size(ranges) - 1), F.size(lines)))
    return F.regexp_replace(F.array_join(every, "\n"), r"\n{4,}", "\n\n\n")


RANGES = "array<struct<first:int,last:int,number:string>>"
CANDIDATES, PICTURED = "array<struct<first:int,last:int,number:string,on:boolean>>", "array<struct<first:int,last:int,pictured:boolean>>"


def with_table_markers(df: DataFrame) -> DataFrame:
    """df with markers in text around each caption with its table and footnotes; a table that goes on under the same number shares them. Marked text stays as it is.
    A text without tables under captions keeps what was cut into lines."""
    text = F.regexp_replace(unmarked(F.col("text"), TABLE_START, TABLE_END), r"(</?\w*)\n(\w*>)", "$1$2")
    d = df.withColumn("_t", text)
    d = d.withColumn("_t", F.when(F.col("_t").rlike(r"(?i)<caption>"), replaced(F.col("_t"), r"(?im)^[^\n]*?<table\b[\s\S]*?</table\s*>", caption_moved_out)).otherwise(F.col("_t")))
    d = d.withColumn("_l", F.split("_t", "\n"))
    d = d.withColumn("_l", each_line("_l", behind_table, lambda x: x.rlike(CLOSES)))
    d = d.withColumn("_l", each_line("_l", behind_row, lambda x: x.contains("|") & ~x.endswith("|") & x.contains("<")))
    d = d.withColumn("_l", each_line("_l", before_caption, lambda x: x.rlike("(?iu)табл")))
    some = F.col("_t").rlike("(?iu)табл")  # a text without any caption needs no letters
    d = d.withColumn("_p", F.when(some, F.transform("_l", bare)))
    d = d.withColumn("_k", F.array_join(F.transform("_p", table_letter), ""))

    def found(line: Column, i: Column) -> Column:
        """The range of a caption in line i, before others are looked at; null where no table follows."""
        s = T.stripped(line)
        wanted = line.rlike("(?iu)табл") & (s.rlike(CAPTION) | s.rlike(GOES_ON))
        ahead = F.length(F.regexp_extract(F.substr(F.col("_k"), i + 2), TABLE_AHEAD, 1))
        here = F.substr(F.col("_k"), i + 1, F.lit(1)).rlike(f"[{''.join(x[3] for x in LETTERS)}]")
        last = i + F.when(here, 0).otherwise(ahead)
        notes = F.length(F.regexp_extract(F.substr(F.col("_k"), last + 2, F.lit(NOTES_AHEAD)), NOTES_BEHIND, 1))
        on = s.rlike(GOES_ON) | bare(line).rlike(GOES_ON_INSIDE)
        r = F.struct(i.cast("int").alias("first"), (last + notes).cast("int").alias("last"), has_group(bare(line), NUMBER, 1).alias("number"), on.alias("on"))
        return F.when(wanted & (here | (ahead > 0)), r)

    d = d.withColumn("_c", F.coalesce(F.when(some, F.array_compact(F.transform("_l", found))), F.array().cast(CANDIDATES)))

    def add(kept: Column, c: Column) -> Column:
        last = F.get(kept, F.size(kept) - 1)
        own = F.struct(c["first"].alias("first"), c["last"].alias("last"), c["number"].alias("number"))
        longer = F.struct(last["first"].alias("first"), c["last"].alias("last"), last["number"].alias("number"))
        same = F.coalesce(c["on"] & (c["number"] == last["number"]), F.lit(False))
        joined = F.when(same, F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(longer))).otherwise(F.concat(kept, F.array(own)))
        return F.when(F.coalesce(c["first"] > last["last"], F.lit(True)), joined).otherwise(kept)

    d = d.withColumn("_r", F.aggregate("_c", F.array().cast(RANGES), add))
    text = F.when(F.size("_r") > 0, surrounded(F.col("_l"), F.col("_r"), TABLE_START, TABLE_END)).otherwise(F.array_join("_l", "\n"))
    return d.withColumn("text", text).drop("_t", "_l", "_p", "_k", "_c", "_r")


def figure_block(block: Column) -> Column:
    """A figure element as a marked block, or, when it holds a table, as its caption and content."""
    content = F.regexp_extract(block, FIGURE_BLOCK, 1)
    caption = bare(F.regexp_extract(content, FIGCAPTION, 1))
    inner = F.regexp_replace(F.regexp_replace(content, FIGCAPTION, ""), IMG, "")
    said, rest = F.nullif(caption, F.lit("")), bare(F.regexp_replace(inner, IMAGE, ""))
    shown = F.nullif(F.concat_ws("\n", said, F.when((rest != "") & (rest != caption), rest)), F.lit(""))
    table = F.concat_ws("\n", said, F.nullif(T.stripped(inner), F.lit("")))
    return F.when(inner.rlike(OPENS), table).otherwise(F.coalesce(F.concat(F.lit(FIGURE_START + "\n"), shown, F.lit("\n" + FIGURE_END)), F.lit("")))


def inside_marks(marks: Column, i: Column, letter_: str) -> Column:
    """Whether a zone that the letter opens is open behind line i."""
    return F.substr(marks, F.lit(1), i + 1).rlike(f"{letter_}-*\\z")


def marks_of(lines: Column, start: str, end: str) -> Column:
    return F.array_join(F.transform(lines, lambda x: F.when(x.contains(end), "E").when(x.contains(start), "S").otherwise("-")), "")


def with_figure_markers(df: DataFrame) -> DataFrame:
    """df with markers in text around figure elements and captions outside tables. Marked text stays as it is."""
    text = F.regexp_replace(unmarked(F.col("text"), FIGURE_START, FIGURE_END), r"(?<=\S)[ \t]*(?=<\d+>)", "\n")
    d = df.withColumn("_t", text)
    outside = F.split("_t", TABLE_ZONE, -1)
    zones = F.regexp_extract_all("_t", F.lit(TABLE_ZONE), F.lit(0))
    changed = F.array_join(F.transform(outside, lambda x, i: F.concat(replaced(x, FIGURE_BLOCK, figure_block), F.coalesce(F.get(zones, i), F.lit("")))), "")
    d = d.withColumn("_t", F.when(F.col("_t").rlike(r"(?i)<figure\b"), changed).otherwise(F.col("_t")))
    kept = F.filter(F.split("_t", "\n"), lambda x: ~x.contains("![") | ~x.rlike(IMAGE) | (T.stripped(F.regexp_replace(bare(x), IMAGE, "")) != ""))
    d = d.withColumn("_l", kept)
    some = F.col("_t").contains("Рис")
    d = d.withColumn("_p", F.when(some, F.transform("_l", bare)))
    d = d.withColumn("_k", F.array_join(F.transform("_p", figure_letter), ""))
    d = d.withColumn("_tz", marks_of(F.col("_l"), TABLE_START, TABLE_END)).withColumn("_fz", marks_of(F.col("_l"), FIGURE_START, FIGURE_END))

    def found(line: Column, i: Column) -> Column:
        p = F.get(F.col("_p"), i)
        caption = line.contains("Рис") & F.when(p != T.stripped(line), F.concat(p, F.lit(" "))).otherwise(p).rlike(FIGURE)
        under = F.substr(F.col("_k"), i + 2, F.lit(LIST_AHEAD))
        n = F.length(F.when(p.endswith(":"), F.regexp_extract(under, UNDER_COLON, 1)).otherwise(F.regexp_extract(under, UNDER_CAPTION, 1)))
        above = F.get(F.col("_p"), i - 1)
        pictured = F.coalesce(above.rlike(IMG) | above.rlike(IMAGE), F.lit(False))
        r = F.struct(i.cast("int").alias("first"), (i + n).cast("int").alias("last"), pictured.alias("pictured"))
        return F.when(caption & ~inside_marks(F.col("_tz"), i, "S") & ~inside_marks(F.col("_fz"), i, "S"), r)

    d = d.withColumn("_c", F.coalesce(F.when(some, F.array_compact(F.transform("_l", found))), F.array().cast(PICTURED)))

    def add(kept: Column, c: Column) -> Column:
        last = F.coalesce(F.get(kept, F.size(kept) - 1)["last"], F.lit(-1))
        first = F.when(c["pictured"] & (last < c["first"] - 1), c["first"] - 1).otherwise(c["first"])
        own = F.struct(first.cast("int").alias("first"), c["last"].alias("last"), F.lit(None).cast("string").alias("number"))
        return F.when(c["first"] > last, F.concat(kept, F.array(own))).otherwise(kept)

    d = d.withColumn("_r", F.when(F.col("_l").isNotNull(), F.aggregate("_c", F.array().cast(RANGES), add)))
    return d.withColumn("text", surrounded(F.col("_l"), F.col("_r"), FIGURE_START, FIGURE_END)).drop("_t", "_l", "_p", "_k", "_tz", "_fz", "_c", "_r")


def pipe_tables_in(text: Column, least: int = 1) -> Column:
    """Runs of at least so many pipe rows that have a separator."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, r"<\d+>", "")))
    runs = F.split(F.array_join(F.transform(lines, lambda x: F.when(x.startswith("|"), x).otherwise("\x00")), "\n"), "\x00")
    rows = lambda r: F.filter(F.split(r, "\n"), lambda x: x != "")
    return F.size(F.filter(runs, lambda r: (F.size(rows(r)) >= least) & F.exists(rows(r), lambda x: x.rlike(r"\A\|[\s\-:|]+\|?\z"))))


def tables_in(text: Column, least: int = 1) -> Column:
    """struct(html, pipe, total). The normaliser counts any run of pipe rows with a separator, the extractor runs of 3 and more."""
    html, pipe = F.regexp_count(text, F.lit(r"(?is)<table\b.*?</table>")), pipe_tables_in(text, least)
    return F.struct(html.cast("int").alias("html"), pipe.alias("pipe"), (html + pipe).cast("int").alias("total"))


def figures_in(text: Column) -> Column:
    """struct(figure_tags, plain_captions, starts, ends): figure elements, captions outside marked tables, markers."""
    outside = F.regexp_replace(text, r"(?s)\[TABLE_START\].*?\[TABLE_END\]", "")
    captions = F.size(F.filter(F.split(outside, "\n"), lambda x: x.rlike(r"Рис(?:унок|\.)\s+\d+[.\d]*\s")))
    count = lambda p: F.regexp_count(text, F.lit(p)).cast("int")
    return F.struct(count(r"(?is)<figure\b[^>]*>.*?</figure>").alias("figure_tags"), captions.alias("plain_captions"), count(r"\[FIGURE_START\]").alias("starts"), count(r"\[FIGURE_END\]").alias("ends"))


def with_markers(chapters: DataFrame) -> DataFrame:
    """chapters with tables and then figures marked in text; a null text stays null."""
    return with_figure_markers(with_table_markers(chapters))
