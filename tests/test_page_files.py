"""Tables and captions of single pages."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quire.operators import page_files as P

PIPE = "| a | b |\n|---|---|\n| 1 | 2 |"
HTML = "<table><tr><td>1</td></tr></table>"


def tables(spark, text):
    df = spark.createDataFrame([("B", "023.md", text)], "book_name string, file string, text string")
    return P.page_tables(df).orderBy("idx").collect()


@pytest.mark.parametrize(
    "above,caption",
    [
        ("Таблица 1.2 Имя\n", "Таблица 1.2 Имя"),
        ("<012> Таблица 3. Имя\n\n<013>\n", "Таблица 3. Имя"),
        ("строка над ней\nТаблица 4 Имя\n", "строка над ней\nТаблица 4 Имя"),
        ("Таблица 5 Имя\nпродолжение\n", "Таблица 5 Имя\nпродолжение"),
        ("Сноска. Таблица 6 в середине\n", "Таблица 6 в середине"),
        ("Таблица 7 Имя\n</tr>\n</table>\n\n", "Таблица 7 Имя"),
        ("Таблица 8 Имя\n" + "\n" * 13, "Таблица 8 Имя"),
        ("первый абзац\n\nвторой\nабзац\n\n", "второй\nабзац"),
        ("слово " * 100 + "\nпоследняя строка\n", "последняя строка"),
        ("", ""),
    ],
)
@pytest.mark.parametrize("table", [PIPE, HTML])
def test_caption_by_priority(spark, above, caption, table):
    if above == "Таблица 5 Имя\nпродолжение\n":
        caption = above.strip()  # the line between is no caption: the paragraph is what counts
    (row,) = tables(spark, above + table)
    assert (row.caption, row.body) == (caption, table)


def test_order_types_and_files(spark):
    text = f"{HTML}\nx\n\n{PIPE}\n\n| no | separator |\n| 1 | 2 |\n| 3 | 4 |\n\n<TABLE a=b>\n<caption c>Своя\nподпись</caption><tr><caption>2</caption></table>"
    got = tables(spark, text)
    assert [(r.type, r.caption) for r in got] == [("html", ""), ("markdown", f"{HTML}\nx"), ("html", "Своя\nподпись")]
    assert [text[r.start : r.end].rstrip("\n") for r in got[:2]] == [HTML, PIPE] and got[2].body == "<TABLE a=b>\n<tr><caption>2</caption></table>"
    df = spark.createDataFrame([("B", "023.md", text), ("B", "x.md", PIPE), ("B", "y.md", "none"), ("B", "z.md", None)], "book_name string, file string, text string")
    files = {(r.source_file, r.name): r.text for r in P.page_table_files(df).collect()}
    assert sorted(files) == [("023.md", "023-1.md"), ("023.md", "023-2.md"), ("023.md", "023-3.md"), ("x.md", "000.md")]
    assert files["023.md", "023-1.md"] == HTML + "\n" and files["023.md", "023-2.md"] == f"{HTML}\nx\n\n{PIPE}\n"


@pytest.mark.parametrize(
    "text,left",
    [
        (f"before\n\nТаблица 1 Имя\n{PIPE}\n* note\n<p>*A</p>\n\nafter", "before\n\nafter\n"),
        (f"before\n\nТаблица 1 Имя\nsecond line\n{HTML}\n<017>\nafter", "before\n\nТаблица 1 Имя\nsecond line\nafter\n"),
        (f"no caption\n{PIPE}\n\nТаблица 2 Имя\n{HTML}", "no caption\n"),
        ("nothing", "nothing"),
        (f"head\n\nline\nТаблица 9\n</td>\n{PIPE}", "head\n"),
    ],
)
def test_text_without_tables(spark, text, left):
    df = spark.createDataFrame([("B", "1.md", text)], "book_name string, file string, text string")
    assert P.pages_without_tables(df).first().text == left


def test_ranges_against_characters(spark):
    rng = random.Random(2)
    rows = []
    for i in range(40):
        text = "".join(rng.choice("abcde\n") for _ in range(30))
        ranges = [(a, min(30, a + rng.randint(0, 9))) for a in rng.sample(range(30), rng.randint(1, 5))]
        rows.append((i, text, ranges))
    df = spark.createDataFrame(rows, "id int, text string, r array<struct<start:int,end:int>>").select("id", P.without_ranges(F.col("text"), F.col("r")).alias("t"))
    got = {r.id: r.t for r in df.collect()}
    for i, text, ranges in rows:
        kept = "".join(c for k, c in enumerate(text) if not any(a <= k < b for a, b in ranges))
        assert got[i] == re.sub(r"\n{3,}", "\n\n", kept).strip() + "\n"


def test_marked_figures(spark):
    text = "# H\n\na [FIGURE_START]\n<012> **Рис. 1.** Имя\nещё\n[FIGURE_END]\n\nb\n[FIGURE_START]\n<3> не рисунок\n[FIGURE_END]\nc [FIGURE_START] open"
    df = spark.createDataFrame([("B", "a.md", text), ("B", "b.md", "Рис. 2. x\n\ny"), ("B", "c.md", "[FIGURE_START]z[FIGURE_END]")], "book_name string, file string, text string")
    rows = sorted(P.chapter_caption_files(df).collect(), key=lambda r: r.source_file)
    assert [(r.source_file, r.name, r.text, r.error) for r in rows] == [("a.md", "012.md", "# H\n\n**Рис. 1.** Имя\nещё\n", None), ("b.md", None, None, "no_markers")]
    cleaned = {r.file: r.text for r in P.cleaned_pages(df).collect()}
    assert cleaned == {"a.md": "# H\n\na \n\nb\nне рисунок\n\nc [FIGURE_START] open\n", "b.md": "y\n", "c.md": "z\n"}
    files = P.page_caption_files(df.filter("file = 'b.md'")).collect()
    assert [(r.name, r.text) for r in files] == [("000.md", "Рис. 2. x\n")]
    assert tuple(P.run_counts(P.chapter_caption_files(df)).first()) == (1, 1, 0)
