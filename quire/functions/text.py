"""Column functions over page text: clean-up of recognition artifacts, page tags, names, references, line tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markers and the words that the text formats are defined by.
TABLE_START, TABLE_END = "[TABLE_START]", "[TABLE_END]"
FIGURE_START, FIGURE_END = "[FIGURE_START]", "[FIGURE_END]"
ARTIFACTS = {
    "table_hash": [r"(?m)^#{1,6}\s+(Таблица\s)"],
    "code_blocks": [r"(?m)^```markdown\s*\n?", r"(?m)^```html\s*\n?", r"(?m)^```\s*\n?"],
    "latex": [r"(?s)\\\[(.+?)\\\]", r"\\\(([^\n]+?)\\\)"],
    "standalone_digits": [r"\n[ \t]*\d{1,3}[ \t]*\s*\z"],
    "excessive_newlines": [r"\n{3,}"],
    "html_styles": [r"""\s+style=["'][^"']*["']"""],
    "html_p_tags": [r"<p(?:\s[^>]*)?>", r"</p>"],
    "bold_markers": [r"\*\*"],
}
REPLACEMENTS = {"table_hash": ["$1"], "latex": [r"\$\$$1\$\$", r"\$$1\$"], "excessive_newlines": ["\n\n"]}
TABLE_REFERENCE = r"(?iu)(?:табл\.?|таблиц[а-яё]+)\s*(\d+(?:\.\d+)*)"
TABLE_ID = r"(?iu)Таблица\s+(\d+(?:\.\d+)*)"
FIGURE_REFERENCE = r"(?iu)(?:рис\.?|рисунок[а-яё]*)\s*(\d+(?:\.\d+)*)"
FIGURE_REFERENCE_INTENDED = r"(?iu)(?:рис\.?|рисун[а-яё]*)\s*(\d+(?:\.\d+)*)"
FIGURE_ID = r"(?iu)Рис\.?\s+(\d+(?:\.\d+)*)"
PAGE_TAG = r"<(\d+)>"
SPECIAL_HEADING = r"\A(?:#{1,6}\s+)?(Раздел|Глава|Часть|раздел|глава|часть)\s+([IVXLCDM]+|\d+)"
PARTICLES = ["то", "либо", "нибудь", "таки", "ка", "де"]


# The characters of Unicode's property White_Space.
WHITE_SPACE = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def stripped(c: Column) -> Column:
    """c without white space at both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def has_text(c: Column) -> Column:
    """Whether c has anything but white space."""
    return c.rlike(r"(?U)\S")


def count_artifacts(text: Column, enabled: list[str] | None = None) -> Column:
    """struct of a count for each enabled artifact and the total, all counted on the text as it is."""
    counts = {k: reduce(lambda a, b: a + b, [F.regexp_count(text, F.lit(p)) for p in v]) for k, v in ARTIFACTS.items() if enabled is None or k in enabled}
    total = reduce(lambda a, b: a + b, counts.values(), F.lit(0))
    return F.struct(*[n.cast("int").alias(k) for k, n in counts.items()], total.cast("int").alias("total"))


def clean(text: Column, artifact: str) -> Column:
    """The text without one kind of artifact."""
    with_what = REPLACEMENTS.get(artifact, [])
    for i, pattern in enumerate(ARTIFACTS[artifact]):
        text = F.regexp_replace(text, pattern, with_what[i] if i < len(with_what) else "")
    return text


def clean_all(text: Column, enabled: list[str] | None = None) -> Column:
    """The enabled artifacts removed, in the registry's order, each from what the ones before left."""
    return reduce(clean, [k for k in ARTIFACTS if enabled is None or k in enabled], text)


def clean_report(text: Column, enabled: list[str] | None = None) -> Column:
    """struct(text, counts, modified): the cleaned text, and how much each step found in what the steps before left."""
    now, counts = text, []
    for artifact, patterns in ARTIFACTS.items():
        if enabled is not None and artifact not in enabled:
            continue
        n = F.lit(0)
        for i, pattern in enumerate(patterns):
            n = n + F.regexp_count(now, F.lit(pattern))
            now = F.regexp_replace(now, pattern, REPLACEMENTS[artifact][i] if artifact in REPLACEMENTS else "")
        counts.append(n.cast("int").alias(artifact))
    return F.struct(now.alias("text"), F.struct(*counts).alias("counts"), (now != text).alias("modified"))


def page_number(file: Column) -> Column:
    """The first run of digits of a file name."""
    return F.regexp_extract(file, r"(\d+)", 1).try_cast("int")


def tag_pages(text: Column, file: Column) -> Column:
    """Squeezed text in which each line but blank ones and headings begins with the page tag; unchanged when the file has no digits."""
    squeezed = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "  +", " "), "\n\n+", "\n"), r"\.\.\.\.+", "...")
    number = F.regexp_extract(file, r"(\d+)", 1)
    begins = lambda x: F.ltrim(x, F.lit(WHITE_SPACE))
    tagged = F.transform(F.split(squeezed, "\n"), lambda x: F.when((begins(x) == "") | begins(x).startswith("#"), x).otherwise(F.concat(F.lit("<"), number, F.lit("> "), x)))
    return F.when(number == "", text).otherwise(F.array_join(tagged, "\n"))


def author_and_title(book_name: Column) -> Column:
    """struct(author, title): split at the first comma; without one the author is empty."""
    at = F.instr(book_name, ",")
    return F.struct(
        F.when(at > 0, stripped(F.substring_index(book_name, ",", 1))).otherwise("").alias("author"),
        F.when(at > 0, stripped(F.regexp_replace(book_name, r"(?s)\A[^,]*,", ""))).otherwise(stripped(book_name)).alias("title"),
    )


def references(text: Column, pattern: str) -> Column:
    """Numbers that a text mentions, once each, in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))


def table_refs(text: Column) -> Column:
    return references(text, TABLE_REFERENCE)


def figure_refs(text: Column, mode: str = "compat") -> Column:
    """mode compat finds the abbreviation and the nominative alone; intended finds the other cases too."""
    return references(text, FIGURE_REFERENCE if mode == "compat" else FIGURE_REFERENCE_INTENDED)


def table_id(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, TABLE_ID, 1), F.lit(""))


def figure_id(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, FIGURE_ID, 1), F.lit(""))


def page_of_chunk_file(file: Column) -> Column:
    """The leading digits of a file name as an array of one page, or of none."""
    number = F.regexp_extract(file, r"\A0*(\d+)", 1).try_cast(PAGE)
    return F.when(number.isNotNull(), F.array(number)).otherwise(F.array().cast(f"array<{PAGE}>"))


def page_of_stem(stem: Column) -> Column:
    """The stem if it is all digits, else 000."""
    return F.when(stem.rlike(r"\A\d+\z"), stem).otherwise("000")


def output_name(page: Column, index: Column, total: Column) -> Column:
    """page.md, or page-index.md where a file gives more than one."""
    return F.concat(page, F.when(total > 1, F.concat(F.lit("-"), index.cast("string"))).otherwise(""), F.lit(".md"))


def first_page(text: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(text, PAGE_TAG, 1), F.lit("")), F.lit("000"))


def page_range(text: Column) -> Column:
    """The different page tags in order, joined by _; 000 without any."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(references(text, PAGE_TAG)), "_"), F.lit("")), F.lit("000"))


def without_page_tags(text: Column, leading: bool = False) -> Column:
    return stripped(F.regexp_replace(text, r"\A\s*<\d+>\s*", "")) if leading else F.regexp_replace(text, PAGE_TAG, "")


PAGE = "decimal(38,0)"  # of page tags, which have no bound; longer ones than this holds are left out


def pages_in(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(F.regexp_extract_all(text, F.lit(PAGE_TAG), F.lit(1)), lambda x: x.try_cast(PAGE)))))


LEADING_HEADINGS = r"(?U)\A((?:#{1,6}\s+[^\n]*(?:\n|\z))*)"


def headers_and_body(text: Column) -> Column:
    """struct(headers map<int, string>, body): the heading lines at the top, of which a later one of a level replaces an earlier one."""
    top = F.regexp_extract(text, LEADING_HEADINGS, 1)
    lines = F.filter(F.split(top, "\n"), lambda x: x.rlike(r"(?U)\A#{1,6}\s"))
    entry = F.transform(lines, lambda x: F.struct(F.length(F.regexp_extract(x, r"\A(#+)", 1)).alias("k"), stripped(F.regexp_replace(x, r"\A#+", "")).alias("v")))
    last = F.filter(entry, lambda e, i: ~F.exists(F.slice(entry, i + 2, F.size(entry)), lambda later: later.k == e.k))
    return F.struct(F.map_from_entries(last).alias("headers"), F.substr(text, F.length(top) + 1).alias("body"))


def heading_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), stripped), lambda x: x.startswith("#"))


def heading_level(block: Column) -> Column:
    return F.nullif(F.length(F.regexp_extract(block, r"\A(#{1,6})\s", 1)), F.lit(0))


def heading_file_name(block: Column, limit: int = 60) -> Column:
    """A heading's first line for use in a file name."""
    line = stripped(F.split(stripped(F.regexp_replace(block, r"\A#+\s+", "")), "\n").getItem(0))
    return F.substring(F.regexp_replace(line, r"""[\\/*?:"<>|\r\n\t]""", ""), 1, limit)


def article_file_name(arxiv_id: Column) -> Column:
    return F.concat(F.replace(arxiv_id, F.lit("/"), F.lit("_")), F.lit(".pdf"))


def format_bytes(n: Column) -> Column:
    """B, KB, MB, GB or TB in steps of 1024, one decimal."""
    out = F.format_string("%.1f TB", n / 1024**4)
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        out = F.when(n < 1024 ** (power + 1), F.format_string(f"%.1f {unit}", n / F.lit(float(1024**power)))).otherwise(out)
    return out


def embedding_text(text: Column, headers: Column, mode: str = "compat") -> Column:
    """The text that is embedded. mode intended puts the deepest heading in front; compat never does, as keys read from JSON are strings."""
    body = stripped(text)
    if mode == "compat":
        return body
    deepest = F.element_at(headers, F.array_max(F.map_keys(headers)))
    return F.when(F.size(headers) > 0, F.concat(deepest, F.lit("\n\n"), body)).otherwise(body)


def is_pipe_line(line: Column) -> Column:
    """A row of a pipe table, a page tag in front or not."""
    s = without_page_tags(line, leading=True)
    return s.startswith("|") & s.endswith("|") & (F.length(s) > 1)


def caption_before_table(body: Column) -> Column:
    """The lines above the first table line."""
    lines = F.transform(F.split(body, "\n"), stripped)
    starts = F.transform(lines, lambda x: F.lower(x).startswith("<table") | (x.startswith("|") & x.endswith("|") & (F.length(x) > 2)))
    at = F.array_position(starts, True)
    above = F.when(at > 0, F.slice(lines, 1, (at - 1).cast("int"))).otherwise(lines)
    return stripped(F.array_join(above, "\n"))


def table_body(text: Column) -> Column:
    """The first HTML table, else the first run of pipe lines, else nothing."""
    markup = F.regexp_extract(text, r"(?is)<table\b.*?</table>", 0)
    pipes = F.regexp_extract(text, r"(?m)^[ \t]*\|[^\n]*(?:\n[ \t]*\|[^\n]*)*", 0)
    return F.coalesce(F.nullif(markup, F.lit("")), F.nullif(stripped(pipes), F.lit("")))


def is_text_block(block: Column) -> Column:
    begins = F.ltrim(block, F.lit(WHITE_SPACE))
    return ~(begins.startswith("|") | begins.startswith("#") | begins.startswith("![") | begins.startswith("<img") | begins.startswith("$$"))


def is_unfinished(text: Column) -> Column:
    """Whether a text stops in mid-sentence."""
    end = F.regexp_extract(F.reverse(text), r"(?sU)\A\s*+[*_]*+(.?)", 1)
    return (text != "") & ~end.isin(*".!?»\":;")


def last_word(text: Column, after: str) -> Column:
    """The letters that stand last but for what the pattern of single signs takes; empty without any. Read from the end, so that words before are not tried."""
    return F.reverse(F.regexp_extract(F.reverse(text), rf"\A{after}([а-яА-ЯёЁa-zA-Z]+)", 1))


def is_continuation(previous: Column, text: Column) -> Column:
    """Whether text goes on where previous stops."""
    return is_unfinished(previous) & (F.length(text) > 0) & ~stripped(text).startswith("#")


def begins_with_particle(text: Column) -> Column:
    """Whether the first word is one that stays behind its hyphen."""
    return F.lower(F.regexp_extract(F.ltrim(text, F.lit(WHITE_SPACE)), r"\A([а-яА-ЯёЁa-zA-Z]+)", 1)).isin(PARTICLES)


def hyphen_resolved(previous: Column, before_particle: Column) -> Column:
    """previous as it stands before the page tag and the text that follows: its hyphen goes but before a particle."""
    kept = previous.rlike("[а-яА-ЯёЁa-zA-Z]-\\z") & before_particle
    return F.when(~previous.endswith("-"), F.concat(previous, F.lit(" "))).when(kept, previous).otherwise(F.regexp_replace(previous, r"-\z", ""))


def clean_tagged(text: Column) -> Column:
    """The text without marked tables and figures."""
    for a, b in ((TABLE_START, TABLE_END), (FIGURE_START, FIGURE_END)):
        text = F.regexp_replace(text, rf"(?s)\Q{a}\E.*?\Q{b}\E", "")
    return F.concat(stripped(F.regexp_replace(text, r"\n{3,}", "\n\n")), F.lit("\n"))


def count_blocks(text: Column) -> Column:
    """struct(tables, figures): marked blocks."""
    of = lambda a, b: F.regexp_count(text, F.lit(rf"(?s)\Q{a}\E.*?\Q{b}\E")).cast("int")
    return F.struct(of(TABLE_START, TABLE_END).alias("tables"), of(FIGURE_START, FIGURE_END).alias("figures"))


def marked_blocks(text: Column, start: str = TABLE_START, end: str = TABLE_END) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s)\Q{start}\E(.*?)\Q{end}\E"), F.lit(1))


def html_tables(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?is)<table\b.*?</table>"), F.lit(0))


def is_empty_line(line: Column) -> Column:
    return line.rlike(r"\A\s*(<\d+>\s*)*\z")


def is_caption_line(line: Column) -> Column:
    """A table caption: white space or the end must follow the number."""
    return stripped(line).rlike(r"\A(?:<\d+>\s*)?(?:Таблица|Табл\.)\s+\d+[.\d]*(?:\s|\z)")


def is_continuation_line(line: Column) -> Column:
    """A line that says a table goes on or ends: at its start, or behind a caption's number."""
    s = stripped(line)
    return s.rlike(r"(?iu)\A(?:<\d+>\s*)?\*{0,2}(?:Окончание|Продолжение)\s+(?:табл\.|таблицы)\s+\d+") | (
        is_caption_line(line) & s.rlike(r"(?iu)(?:Окончание|Продолжение)\s+(?:табл\.|таблицы)")
    )


def caption_number(line: Column) -> Column:
    """The number of the table that a caption or a continuation names."""
    return F.nullif(F.regexp_extract(without_page_tags(line), r"(?:Таблица|Табл\.|табл\.|таблицы|таблицу)\s+(\d+[.\d]*)", 1), F.lit(""))


def is_note_line(line: Column) -> Column:
    """A footnote under a table."""
    return stripped(line).rlike(r"\A(?:<p>)?\\*\*")


def inside(position: Column, zones: Column) -> Column:
    """Whether a position lies in one of the half-open zones."""
    return F.exists(zones, lambda z: (position >= z.s) & (position < z.e))


def roman(numeral: Column) -> Column:
    """The value of a Roman numeral; null with other letters in it."""
    letters = F.split(F.upper(numeral), "")
    value = lambda x: F.element_at(F.create_map(*[F.lit(v) for p in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100), ("D", 500), ("M", 1000)) for v in p]), x)
    numbers = F.transform(F.filter(letters, lambda x: x != ""), value)
    signed = F.transform(numbers, lambda v, i: F.when(F.coalesce(F.get(numbers, i + 1), F.lit(0)) > v, -v).otherwise(v))
    total = F.aggregate(signed, F.lit(0), lambda a, x: a + x)
    return F.when(F.exists(numbers, lambda v: v.isNull()) | (F.size(numbers) == 0), F.lit(None)).otherwise(total)


def normalized(text: Column) -> Column:
    """Lower case, without section sign, dot leaders and punctuation, for comparing headings."""
    t = F.regexp_replace(F.lower(stripped(text)), r"§\s*", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\.{2,}", " "), r"(?U)[^\w\s]", " ")
    return stripped(F.regexp_replace(t, r"(?U)\s+", " "))


def section_key(text: Column) -> Column:
    """The parts of a section number such as 1.2.3, or of a single one with a dot, at the start, without zeros in front; else null. Parts are text, as they have no bound."""
    s = stripped(text)
    number = F.coalesce(F.nullif(F.regexp_extract(s, r"\A(\d+(?:\.\d+)+)[.\s]", 1), F.lit("")), F.nullif(F.regexp_extract(s, r"\A(\d+)\.\s", 1), F.lit("")))
    return F.transform(F.split(number, r"\."), whole_number)


def whole_number(digits: Column) -> Column:
    """Digits without zeros in front."""
    return F.regexp_replace(digits, r"\A0+(?=\d)", "")


def special_key(text: Column) -> Column:
    """struct(keyword, number) of a heading by section, chapter or part, its number Arabic or Roman, as digits."""
    word, number = F.lower(F.regexp_extract(stripped(text), SPECIAL_HEADING, 1)), F.regexp_extract(stripped(text), SPECIAL_HEADING, 2)
    digits = F.when(number.rlike(r"\A\d+\z"), whole_number(number)).otherwise(roman(number).cast("string"))
    return F.when(word != "", F.struct(word.alias("keyword"), digits.alias("number")))


def token_overlap(a: Column, b: Column) -> Column:
    """Shared words over the words of the smaller set."""
    words = lambda x: F.array_distinct(F.filter(F.split(x, " "), lambda w: w != ""))
    one, two = words(a), words(b)
    least = F.least(F.size(one), F.size(two))
    return F.when(least > 0, F.size(F.array_intersect(one, two)) / least).otherwise(F.lit(0.0))


def point_id(book: Column, index: Column, text: Column) -> Column:
    """52 bits of the SHA-256 of the book, the index and the first 200 characters."""
    key = F.concat_ws("::", book, index.cast("string"), F.substring(text, 1, 200))
    return F.conv(F.substring(F.sha2(key, 256), 1, 13), 16, 10).cast("long")


def token_cost(prompt: Column, completion: Column, input_price: Column, output_price: Column) -> Column:
    """Prices are for a million tokens; null when there is none."""
    return F.round((prompt * input_price + completion * output_price) / 1e6, 6)


def parse_boxes(answer: Column) -> Column:
    """A map of names to boxes from a model's JSON answer, fences or not; empty when it is no such map."""
    bare = F.regexp_replace(answer, r"(?m)^\s*```(?:json)?\s*$", "")
    return F.coalesce(F.from_json(bare, "map<string, array<int>>"), F.from_json(F.lit("{}"), "map<string, array<int>>"))


def crop_box(box: Column, width: Column, height: Column) -> Column:
    """Pixels (left, top, right, bottom) of a box [ymin, xmin, ymax, xmax] in thousandths, clamped; null if empty."""
    px = lambda i, size: F.least(F.greatest(F.floor(F.get(box, i) * size / 1000), F.lit(0)), size).cast("int")
    left, top, right, bottom = px(1, width), px(0, height), px(3, width), px(2, height)
    return F.when((right > left) & (bottom > top), F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom")))


def count_formulas(text: Column) -> Column:
    """Block formulas, then inline ones outside them."""
    block = r"(?s)\$\$.+?\$\$"
    return (F.regexp_count(text, F.lit(block)) + F.regexp_count(F.regexp_replace(text, block, ""), F.lit(r"(?<!\$)\$[^$\n]+\$(?!\$)"))).cast("int")


def nullif_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
