"""Stages: stitching, chapters, boundaries, extraction, headings, chunks, points."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quire.operators import boundaries, chapters, chunks, extraction, headings
from quire.plans import points, registry


def pages(spark, *texts):
    return spark.createDataFrame([("B", f"{i + 1:03d}.md", t) for i, t in enumerate(texts)], "book_name string, file string, text string")


def stitched(spark, *blocks):
    return [r.text for r in chapters.stitched(chapters.blocks(pages(spark, *blocks))).orderBy("n").collect()]


def test_stitching(spark):
    assert stitched(spark, "<001> ab-", "<002> cd.") == ["<001> ab<002>cd."]
    assert stitched(spark, "<001> кто-", "<002> то да.") == ["<001> кто-<002>то да."]
    assert stitched(spark, "<001> ab.", "<002> cd") == ["<001> ab.", "<002> cd"]
    assert stitched(spark, "<001> ab\n\n![i](u)", "<002> cd") == ["<001> ab <002> cd", "![i](u)"]
    assert stitched(spark, "<001> ab", "# H", "<002> cd") == ["<001> ab", "# H", "<002> cd"]
    assert stitched(spark, "<001> a", "<002> b", "<003> c.", "<004> d") == ["<001> a <002> b <003> c.", "<004> d"]


def test_stitching_equals_a_fold(spark):
    rng = random.Random(4)
    parts = ["<{n}> ab", "<{n}> ab-", "<{n}> ab.", "# H", "![i](u)", "| a |", "plain", "<{n}> то", "plain-", "<{n}> ab**"]
    texts = [rng.choice(parts).format(n=i) for i in range(300)]
    out, last = [], None
    for t in texts:  # last: the place in out of the text that can be continued
        tagged = t.startswith("<")
        body = t.split("> ", 1)[1] if tagged else t
        if tagged and last is not None and not out[last].rstrip("*_").endswith((".", "!", "?", "»", '"', ":", ";")):
            tag, p = t.split(" ", 1)[0], out[last]
            out[last] = f"{p} {tag} {body}" if not p.endswith("-") else f"{p if body == 'то' else p[:-1]}{tag}{body}"
            continue
        out.append(t)
        last = None if t.startswith("#") else len(out) - 1 if not t.startswith(("|", "![")) else last
    df = spark.createDataFrame([("B", f"{i:04d}.md", t) for i, t in enumerate(texts)], "book_name string, file string, text string")
    assert [r.text for r in chapters.stitched(chapters.blocks(df)).orderBy("n").collect()] == out


def test_chapters(spark):
    text = "intro\n\n# One\n\n## A\n\ntext a\n\n### deep\n\nmore\n\n## B\n\n# Two\ncontent\n\n## C\n\nend"
    rows = chapters.merged(pages(spark, text), 2).orderBy("chapter_no").collect()
    assert [(r.name, r.text) for r in rows] == [
        ("01_Введение", "intro"), ("02_A", "# One\n\n## A\n\ntext a\n\ndeep\n\nmore"), ("03_Two", "# Two\n\ncontent"), ("04_C", "# Two\n\n## C\n\nend"),
    ]


def marked_texts(spark, texts, by):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.text for r in by(df).orderBy("i").collect()]


def marking(spark, by):
    return lambda text: marked_texts(spark, [text], by)[0]


def test_table_boundaries(spark):
    mark_tables = marking(spark, boundaries.with_table_markers)
    text = "text\n<001> Таблица 1. Имя\n<table><tr><td>1</td></tr></table>\n* note\nafter"
    marked = "text\n[TABLE_START]\n<001> Таблица 1. Имя\n<table><tr><td>1</td></tr></table>\n* note\n[TABLE_END]\nafter"
    assert mark_tables(text) == marked and mark_tables(marked) == marked
    plain = "a\n| x | y |\n|---|---|\n| 1 | 2 |\nb"
    assert mark_tables(plain) == plain
    on = "Таблица 3.1 Имя\n| a |\n|---|\n| 1 |\n\n<002> Продолжение таблицы 3.1\n| a |\n|---|\n| 2 |\nz"
    assert mark_tables(on).count("[TABLE_START]") == 1
    assert mark_tables("<table><caption>Таблица 2 x</caption>\n<tr></tr></table> <002> Окончание").split("\n")[1] == "Таблица 2 x"
    assert mark_tables("<011> текст 5% <012> Таблица 2\n<table></table>").split("\n")[:3] == ["<011> текст 5%", "[TABLE_START]", "<012> Таблица 2"]
    assert mark_tables("Таблица 1: имя\n<table></table>") == "Таблица 1: имя\n<table></table>"


def test_figure_boundaries(spark):
    mark_figures = marking(spark, boundaries.with_figure_markers)
    text = "a\n<001> Рис. 2. Схема:\n1 — вход;\nвыход — два\n\nb"
    marked = mark_figures(text)
    assert marked == "a\n[FIGURE_START]\n<001> Рис. 2. Схема:\n1 — вход;\nвыход — два\n[FIGURE_END]\n\nb"
    assert mark_figures(marked) == marked
    assert mark_figures("x\n<figure><img src=a><figcaption>Рис. 1. N</figcaption></figure>") == "x\n[FIGURE_START]\nРис. 1. N\n[FIGURE_END]"
    inside = "[TABLE_START]\nРис. 3. x\n[TABLE_END]"
    assert mark_figures(inside) == inside


def test_markers_are_stable_on_made_up_texts(spark):
    rng = random.Random(8)
    lines = ["Таблица 1.2 Имя", "<003> Окончание табл. 1.2", "<table>", "</table>", "| a | b |", "|---|---|", "| 1 | 2 | <004> Текст", "* note", "", "<005> Рис. 4. Вид:", "1 — да;", "![a](b)", "текст", "<figure><figcaption>Рис. 9. Z</figcaption></figure>", "# H"]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(1, 25))) for _ in range(400)]
    once = marked_texts(spark, texts, boundaries.with_table_markers)
    assert marked_texts(spark, once, boundaries.with_table_markers) == once
    twice = marked_texts(spark, once, boundaries.with_figure_markers)
    for one, two in zip(once, twice):
        assert one.count("[TABLE_START]") == one.count("[TABLE_END]") and two.count("[FIGURE_START]") == two.count("[FIGURE_END]")


def plain_bare(x):
    return re.sub(r"<\d+>", "", x).strip()


def plain_ranges(lines):
    """(first, last, number) of the tables under captions by loops over lines, for texts whose lines hold one thing each."""
    p, out, i = [plain_bare(x) for x in lines], [], 0
    while i < len(lines):
        end = None
        caption = re.match(r"(?:<\d+>\s*)?(?:Таблица|Табл\.)\s+\d+[.\d]*(?:\s|$)", lines[i].strip())
        on = re.match(r"(?i)(?:<\d+>\s*)?\*{0,2}(?:Окончание|Продолжение)\s+(?:табл\.|таблицы)\s+\d+", lines[i].strip())
        for j in range(i + 1, min(len(p), i + 31)) if caption or on else ():
            if "<table" in p[j]:
                end = next((k for k in range(j, len(p)) if "</table" in p[k]), None)
                break
            size = next((k for k in range(j, len(p)) if not p[k].startswith("|")), len(p)) - j
            if size >= 3 and any(re.match(r"\|[\s\-:|]+\|?$", x) for x in p[j : j + size]):
                end = j + size - 1
                break
        if end is None:
            i += 1
            continue
        last = end
        for j in range(end + 1, min(len(p), end + 11)):
            if p[j].startswith("*"):
                last = j
            elif p[j] or last > end:
                break
        number = re.search(r"(?:Таблица|[Тт]абл\.|таблицы)\s+(\d+[.\d]*)", p[i])[1]
        if on and out and out[-1][2] == number:
            out[-1] = (out[-1][0], last, number)
        else:
            out.append((i, last, number))
        i = last + 1
    return out


def test_table_markers_by_plain_loops(spark):
    rng = random.Random(11)
    lines = ["Таблица 1.2 Имя", "<003> Окончание табл. 1.2", "Продолжение таблицы 7", "Таблица 7 x", "<table>", "</table>", "<tr></tr>", "| a | b |", "| 1 |", "|---|---|", "* note", "<004> ** note", "", "<005> ", "текст"]
    texts = ["\n".join(rng.choices(lines, [3, 1, 1, 2, 2, 2, 1, 4, 4, 4, 2, 1, 3, 1, 2], k=rng.randint(1, 60))) for _ in range(500)]
    for text, marked in zip(texts, marked_texts(spark, texts, boundaries.with_table_markers)):
        out = text.split("\n")
        for first, last, _ in reversed(plain_ranges(out)):
            out[last + 1 : last + 1] = ["[TABLE_END]"]
            out[first:first] = ["[TABLE_START]"]
        assert re.sub(r"\n{4,}", "\n\n\n", "\n".join(out)) == re.sub(r"\n{4,}", "\n\n\n", marked)


def test_markers_of_odd_texts(spark):
    long = "Таблица 1 x\n" + "| a |\n" * 5000 + "|---|\n" + "| b |\n" * 5000 + "* note"
    (marked,) = marked_texts(spark, [long], boundaries.with_table_markers)
    assert marked == f"[TABLE_START]\n{long}\n[TABLE_END]"
    assert marked_texts(spark, ["", None, "x"], boundaries.with_markers) == ["", None, "x"]


def test_extraction(spark):
    text = "# H\n\n[TABLE_START]\n<045> Таблица 1.1 Имя\n<046> | a |\n|---|\n| 1 |\n[TABLE_END]\n[TABLE_START]\nx\n[TABLE_END]"
    rows = extraction.extracted_tables(pages(spark, text).withColumnRenamed("file", "name")).orderBy("idx").collect()
    assert [(r.file, r.caption) for r in rows] == [("045_046-1.md", "Таблица 1.1 Имя"), ("000-2.md", "x")]
    assert rows[0].body == "| a |\n|---|\n| 1 |" and rows[0].text.startswith("# H\n\nТаблица")
    gaps = spark.createDataFrame([("B", f"Рис. {n}. x") for n in (1, 2, 5, 6)] + [("B", "без номера")], "book_name string, caption string")
    row = extraction.missing_figures(gaps).first()
    assert [tuple(g) for g in row.missing] == [(3, 4)] and row.unnumbered == 1
    far = spark.createDataFrame([("B", "Рис. 2000000000. x"), ("B", f"Рис. {'7' * 40}. x"), ("C", "x")], "book_name string, caption string")
    found = {r.book_name: r for r in extraction.missing_figures(far).collect()}
    assert [tuple(g) for g in found["B"].missing] == [(1, 1999999999)] and found["B"].unnumbered == 1 and found["C"].missing == [] and found["C"].largest is None


def test_summaries(spark):
    html = "# H\nTable 1\n<table><thead><tr><th>a &amp; b</th></tr></thead><tbody><tr><th colspan=2>G</th></tr><tr><td>x</td></tr><tr><td>x</td></tr></tbody></table>"
    pipe = "cap\n| a | b |\n|---|---|\n| x | 1 |\n| y | 2 |"
    d = spark.createDataFrame([(html,), (pipe,), ("# H\nplain",)], "t string").select(extraction.table_summary(F.col("t")).alias("s"))
    assert [r.s for r in d.collect()] == ["# H\nTable 1\nСтолбцы: a & b\nГруппы: G\nЗначения: x", "cap\nСтолбцы: a, b\nЗначения: x, y", "plain"]


def test_heading_cascade(spark):
    toc = spark.createDataFrame(
        [("B", 1, "1. Введение .... 3", 1), ("B", 2, "1.2 Материалы и методы", 2), ("B", 3, "Глава II Опыты", 1), ("B", 4, "Заключение", 1), ("B", 5, "Список литературы и источников", 1), ("B", 6, "3.1 Сырье", 3)],
        "book_name string, ord long, raw_text string, level int",
    )
    text = "## 1.2 Материалы\n# 1.2.5 Прочее\nГлава 2 Опыты\n## § 3.1 Сырье\n### заключение\n# Заключение и выводы\n## Список источников литературы\n## Нет такого\nТаблица 1 x\ntext"
    d = headings.aligned_lines(pages(spark, text), toc).orderBy("line_no").collect()
    assert [r.line for r in d] == [
        "## 1.2 Материалы", "## 1.2.5 Прочее", "# Глава 2 Опыты", "### § 3.1 Сырье", "# заключение", "# Заключение и выводы", "# Список источников литературы", "Нет такого", "Таблица 1 x", "text",
    ]
    left = headings.uncovered_entries(pages(spark, text), toc).collect()
    assert [r.ord for r in left] == [1]


@pytest.mark.parametrize("n,expected", [(2201, [(0, 1200), (1000, 1600), (1400, 2201)]), (1200, [(0, 1200)]), (1, [(0, 1)]), (2400, [(0, 1200), (1000, 2200), (2000, 2400)])])
def test_spans(spark, n, expected):
    row = spark.range(1).select(chunks.spans(F.lit(n)).alias("v")).first().v
    assert [(x.s, x.e) for x in row] == expected


def test_spans_cover_the_text(spark):
    rng = random.Random(2)
    for size, overlap, least in [(100, 20, 40), (50, 0, 10), (30, 15, 25)]:
        ns = [(rng.randint(1, 700),) for _ in range(100)]
        for r in spark.createDataFrame(ns, "n int").select("n", chunks.spans(F.col("n"), size, overlap, least).alias("v")).collect():
            assert r.v[0].s == 0 and r.v[-1].e == r.n and all(a.e >= b.s >= 0 and a.s < a.e for a, b in zip(r.v, r.v[1:]))
    with pytest.raises(ValueError):
        chunks.spans(F.lit(1), 100, 60)


def test_text_chunks(spark):
    d = pages(spark, "# H\n<007> abc<9> табл. 2").withColumnRenamed("file", "source_file")
    r = chunks.text_chunks(d).first()
    assert (r.text, r.page_numbers, r.table_refs, r.headers) == (" abc табл. 2", [7, 9], ["2"], {1: "H"})
    assert chunks.text_chunks(pages(spark, "abc<9>").withColumnRenamed("file", "source_file")).first().page_numbers == []
    assert chunks.text_chunks(pages(spark, "# H\n", "", "<1>").withColumnRenamed("file", "source_file")).count() == 0


def test_packing_modes(spark):
    body = "| a | b |\n|---|---|\n" + "\n".join(f"| {i} | xxxxxxxxxx |" for i in range(20))
    d = pages(spark, body).withColumnRenamed("file", "source_file")
    wide = [r.text for r in chunks.extracted_chunks(d, "table", 100, "intended").orderBy("chunk_index").collect()]
    assert all(t.startswith("| a | b |\n|---|---|\n") and len(t) <= 100 for t in wide)
    assert "\n".join(t.split("\n", 2)[2] for t in wide) == body.split("\n", 2)[2]
    plain = [r.text for r in chunks.extracted_chunks(d, "table", 100).orderBy("chunk_index").collect()]
    assert not plain[1].startswith("| a | b |")


def test_buckets_and_stats(spark):
    d = spark.createDataFrame([(n,) for n in (0, 499, 500, 999, 1000, 1199, 1200, 1499, 1500, 1999, 2000)], "n int")
    got = {r.bucket: r.n for r in chunks.size_distribution(d, F.col("n")).collect()}
    assert [got[name] for _, name in chunks.BUCKETS] == [2, 2, 2, 2, 2, 1]
    s = chunks.size_stats(spark.createDataFrame([(1,), (2,), (4,), (9,)], "n int"), F.col("n")).first()
    assert (s.least, s.largest, s.median, s["mean"]) == (1, 9, 3, 4)


def test_points_and_collections(spark, tmp_path):
    d = chunks.with_book(chunks.text_chunks(pages(spark, "some text", "more").withColumnRenamed("file", "source_file")))
    p = points.dense(points.points(d), "e5-small").select("id", "dense", "payload")
    assert points.dimension_check(p, "e5-small").first().fits
    store = points.Collections(spark, str(tmp_path / "c"))
    store.write("books", p)
    store.write("books", p)
    assert store.info("books")["points"] == 2 and store.names() == ["books"]
    store.snapshot("books", "s1")
    store.write("books", p.limit(1), recreate=True)
    store.restore("books", "s1")
    assert store.read("books").count() == 2 and store.snapshots("books") == ["s1"]
    assert store.delete("books")
    with pytest.raises(KeyError):
        points.dimension("none")


def test_registry(spark):
    prompts = spark.createDataFrame([registry.prompt_row("a", "", "t")])
    more = registry.added(prompts, registry.prompt_row("b", "", "u"))
    assert more.count() == 2
    with pytest.raises(ValueError):
        registry.added(more, registry.prompt_row("b", "", "u"))
    assert registry.updated(more, "name", "b", text="v").filter("name = 'b'").first().text == "v"
    assert registry.removed(more, "name", "a").count() == 1

    def call(text):
        if text == "bad":
            raise RuntimeError("quota exceeded")
        return text.upper()

    got = registry.answers(spark.createDataFrame([("x",), ("bad",)], "prompt string"), call, pause=0.0)
    assert [(r.answer, r.error) for r in got.collect()] == [("X", None), (None, "quota exceeded")]
