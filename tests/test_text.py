"""The literal cases: clean-up, tags, references, names, identifiers."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T


@pytest.fixture(scope="module")
def value(spark):
    def run(make, *args):
        row = spark.createDataFrame([tuple(args)], ", ".join(f"c{i} string" for i in range(len(args))))
        return row.select(make(*[F.col(f"c{i}") for i in range(len(args))]).alias("v")).first().v

    return run


def test_page_tagging(value):
    text = "# Top\n\n\none   two\n\nend......"
    assert value(T.tag_pages, text, "007.md") == "# Top\n<007> one two\n<007> end..."
    assert value(T.tag_pages, text, "preface.md") == text


def test_references(value):
    assert value(T.table_refs, "Табл. 2.1; таблицей 4; ТАБЛ.9; табл 2.1") == ["2.1", "4", "9"]
    text = "Рис. 7.2, на рисунке 8, рисунок 9"
    assert value(T.figure_refs, text) == ["7.2", "9"]
    assert value(lambda c: T.figure_refs(c, "intended"), text) == ["7.2", "8", "9"]
    assert value(T.table_id, "см. таблица 3.1") == "3.1" and value(T.table_id, "нет") is None
    assert value(T.figure_id, "рис 4") == "4" and value(T.figure_id, "рисунок 4") is None


@pytest.mark.parametrize(
    "artifact,text,cleaned,n",
    [
        ("table_hash", "## Таблица 8 имя", "Таблица 8 имя", 1),
        ("code_blocks", "```html\nk\n```", "k\n", 3),  # the dry run counts the opening fence twice
        ("latex", r"p \[u\] q \(v\)", "p $$u$$ q $v$", 2),
        ("html_styles", '<td style="w:1" colspan="2">5</td>', '<td colspan="2">5</td>', 1),
        ("standalone_digits", "body\n 42 ", "body", 1),
        ("html_p_tags", '<p class="a">x</p>', "x", 2),
        ("bold_markers", "**x**", "x", 2),
        ("excessive_newlines", "a\n\n\n\nb", "a\n\nb", 1),
    ],
)
def test_cleaners(value, artifact, text, cleaned, n):
    assert value(lambda c: T.clean(c, artifact), text) == cleaned
    assert value(T.count_artifacts, text)[artifact] == n
    assert value(lambda c: T.count_artifacts(c, [artifact]), text).asDict() == {artifact: n, "total": n}


def test_names_and_ids(value):
    assert tuple(value(T.author_and_title, "A. Writer, Coal, part 2")) == ("A. Writer", "Coal, part 2")
    assert tuple(value(T.author_and_title, "Only title")) == ("", "Only title")
    assert value(lambda b, t: T.point_id(b, F.lit(0), t), "Author A, Title B", "hello") == 1880174716888450
    assert value(T.page_range, "<046> x <045> y <046>") == "045_046" and value(T.page_range, "x") == "000"
    assert value(T.page_of_chunk_file, "030-2.md") == [30] and value(T.page_of_chunk_file, "unknown.txt") == []
    assert [value(T.page_number, f) for f in ("005.md", "intro.md")] == [5, None]
    assert value(T.article_file_name, "a/1") == "a_1.pdf"


def test_headers(value):
    v = value(T.headers_and_body, "# A\n## B\n## C\nbody\n# D")
    assert v.headers == {1: "A", 2: "C"} and v.body == "body\n# D"
    assert value(T.headers_and_body, "body").headers == {}


def test_headings(value):
    assert value(T.token_overlap, "a b c", "a c d e") == pytest.approx(2 / 3)
    assert [value(T.roman, r) for r in ("XIV", "IX", "MCM", "Q")] == [14, 9, 1900, None]
    assert value(T.section_key, "1.02.3 Title") == ["1", "2", "3"] and value(T.section_key, "0. Введение") == ["0"] and value(T.section_key, "5 Раздел") is None
    assert tuple(value(T.special_key, "Раздел IV. Имя")) == ("раздел", "4")
    assert tuple(value(T.special_key, "# глава 0012 x")) == ("глава", "12") and value(T.special_key, "рлава 2") is None


def test_numbers_without_bound(value):
    """No number of a text stops a query, however long it is."""
    long = "9" * 30
    assert value(T.section_key, f"{long}.007. x") == [long, "7"] and tuple(value(T.special_key, f"Часть {long} x")) == ("часть", long)
    assert value(T.pages_in, f"<{long}>a<0002>b") == [2, int(long)] and value(T.pages_in, f"<{'9' * 50}>a<3>") == [3]
    assert value(T.page_of_chunk_file, f"{long}.md") == [int(long)]
    assert value(T.normalized, "§ 1. Имя,  СЛОВО ..... 5") == "1 имя слово 5"


def test_costs_and_boxes(spark, value):
    assert spark.range(1).select(T.token_cost(F.lit(1500), F.lit(300), F.lit(20.0), F.lit(60.0)).alias("v")).first().v == pytest.approx(0.048)
    assert value(T.parse_boxes, '```json\n{"IMAGE_1": [1, 2, 3, 4]}\n```') == {"IMAGE_1": [1, 2, 3, 4]}
    assert value(T.parse_boxes, "nonsense") == {}
    assert value(T.count_formulas, "$$a$$ $b$ $$c\nd$$") == 3


def test_embedding_text(spark):
    d = spark.sql("select ' text ' as t, map(1, 'a', 2, 'b') as h")
    assert d.select(T.embedding_text(F.col("t"), F.col("h")).alias("v")).first().v == "text"
    assert d.select(T.embedding_text(F.col("t"), F.col("h"), "intended").alias("v")).first().v == "b\n\ntext"


@pytest.mark.parametrize(
    ("line", "pipe", "empty", "goes_on", "number", "note"),
    [
        ("<007> | a | b |", True, False, False, None, False), ("|", False, False, False, None, False), (" <1> <2> ", False, True, False, None, False), ("", False, True, False, None, False),
        ("<003> Окончание табл. 1.2", False, False, True, "1.2", False), ("**Продолжение таблицы 7", False, False, True, "7", True), ("Таблица 4 — Окончание таблицы 4", False, False, True, "4", False),
        ("Таблица 3.1 Имя", False, False, False, "3.1", False), ("см. таблицу 5", False, False, False, "5", False), ("* note", False, False, False, None, True), ("<p>** note", False, False, False, None, True),
        (r"\* note", False, False, False, None, True), ("text", False, False, False, None, False),
    ],
)
def test_kinds_of_lines(spark, line, pipe, empty, goes_on, number, note):
    c = F.col("line")
    d = spark.createDataFrame([(line,)], "line string")
    r = d.select(T.is_pipe_line(c).alias("a"), T.is_empty_line(c).alias("b"), T.is_continuation_line(c).alias("c"), T.caption_number(c).alias("d"), T.is_note_line(c).alias("e")).first()
    assert tuple(r) == (pipe, empty, goes_on, number, note)


def test_continuations_and_zones(spark):
    rows = [("a word-", "rest", True), ("the end.", "rest", False), ("no sign", "# Head", False), ("no sign**", " rest", True), ("", "rest", False), ("x:", "", False)]
    d = spark.createDataFrame(rows, "before string, text string, want boolean")
    assert all(r.got == r.want for r in d.select("want", T.is_continuation(F.col("before"), F.col("text")).alias("got")).collect())
    zones = F.array(F.struct(F.lit(2).alias("s"), F.lit(5).alias("e")), F.struct(F.lit(9).alias("s"), F.lit(10).alias("e")))
    assert [r.id for r in spark.range(12).filter(T.inside(F.col("id"), zones)).collect()] == [2, 3, 4, 9]


def test_white_space_is_trimmed_as_by_unicode(spark):
    signs = [chr(c) for c in range(0x3001) if chr(c).isspace() or c in (0x85, 0x200B, 0x180E, 0xFEFF, 0x1C, 0x1F)]
    rows = [(f"{s}a{s}b{s}",) for s in signs] + [(s * 3,) for s in signs] + [("",), (None,)]
    d = spark.createDataFrame(rows, "t string").select("t", T.stripped(F.col("t")).alias("got"), F.regexp_replace("t", r"(?U)\A\s+|\s+\z", "").alias("want"), T.has_text(F.col("t")).alias("some"))
    assert all(r.got == r.want and (r.t is None or r.some == (r.want != "")) for r in d.collect())
