"""Stitching, chapters and packing against plain loops, on made-up rows and on the planted books."""

import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import boundaries, chapters, chunks, hyphens
from quire.plans import corpus
from quire.queries import QUERIES

SF = "/root/testdata/sf0.001"
SPACE = "[\\s\x85\xa0]"


def strip(x):
    return re.sub(r"\A\s+|\s+\Z", "", x)


def unfinished(x):
    end = re.sub(r"[*_]+\Z", "", strip(x))
    return bool(x) and (end.endswith("-") or not re.search(r'[.!?»":;]\Z', end))


def blocks_of(text):
    return [b for b in map(strip, re.split(r"\n\n+", text)) if b]


def keeps_hyphen(before, after, known):
    if after in T.PARTICLES or known is None:
        return after in T.PARTICLES
    whole, compound = before + after, f"{before}-{after}"
    return compound in known or (whole not in known and before in known and after in known)


def plain_words(texts, least=2):
    seen = {}
    for t in texts:
        for w in re.findall("[а-яёa-z]+(?:-[а-яёa-z]+)*-?", t.lower()):
            seen[w] = seen.get(w, 0) + 1
    return {w for w, n in seen.items() if n >= least and not w.endswith("-")}


def plain_stitch(blocks, known=None):
    out, held, head = [], None, None
    for text in blocks:
        if text.startswith("#"):
            held = head = None
        m = re.match(r"(?s)(\s*<\d+>\s*)(.*)\Z", text)
        marker, rest = (strip(m[1]), strip(m[2])) if m else ("", "")
        is_text = not re.match(r"\s*(\||#|!\[|<img|\$\$)", text)
        if m and held is not None and rest and not rest.startswith("#") and unfinished(held):
            before = strip(out[head][-1])
            word = re.match("([а-яА-ЯёЁa-zA-Z]+)", rest)
            hyphen = before.endswith("-")
            last = re.search("([а-яА-ЯёЁa-zA-Z]+)-\\Z", before)
            kept = last and word and keeps_hyphen(last[1].lower(), word[1].lower(), known)
            out[head][-1] = before + " " if not hyphen else before if kept else before[:-1]
            out[head] += [marker + ("" if hyphen else " "), rest]
        else:
            out.append([text])
            head = len(out) - 1 if is_text else head
        if is_text:
            held = rest if m else text
    return ["".join(p) for p in out]


def plain_chapters(blocks, level=0):
    parts = [strip(p) for b in blocks for p in re.split(r"\n(?=[ \t]*#)", b)]
    level_of = lambda t: len(m[1]) if (m := re.match(r"(#{1,6})\s", t)) else None
    at = level or max([x for x in map(level_of, parts) if x], default=1)
    found, stack = [], {}
    now = {"title": None, "body": [], "heads": [], "real": False}
    for text in parts:
        k = level_of(text)
        if k and k <= at:
            found.append(now)
            now = {"title": None, "body": [], "heads": now["heads"], "real": False}
        content = text
        if k and k < at:
            m = re.match(r"(?s)((?:[ \t]*#[^\n]*(?:\n|\Z))*)(.*)\Z", text)
            stack = {j: h for j, h in stack.items() if j < k} | {k: strip(m[1])}
            content = strip(m[2]) or None
        elif k and k > at:
            content = re.sub(r"\A#{1,6}\s+", "", text)
        if k == at:
            now["title"] = text
        now["heads"] = [stack[j] for j in sorted(stack)]
        if content is not None:
            now["body"].append(content)
            now["real"] |= any(strip(x) and not strip(x).startswith("#") for x in content.split("\n"))
    out = []
    for c in [x for x in [*found, now] if x["real"]]:
        named = c["title"] or (c["heads"][-1] if c["heads"] else None)
        name = chapters.INTRODUCTION
        if named is not None:
            name = re.sub(r'[\\/*?:"<>|\r\n\t]', "", strip(strip(re.sub(r"\A#+\s+", "", named)).split("\n")[0]))[:60]
        out.append((len(out) + 1, f"{len(out) + 1:02d}_{name}"[: 63], "\n\n".join([*c["heads"], *c["body"]])))
    return out


def made_up_pages(seed, n=12):
    rng = random.Random(seed)
    pages = []
    for k in range(n):
        blocks = []
        for _ in range(rng.randint(1, 5)):
            x = rng.random()
            words = " ".join(rng.choice(["слово", "где", "то", "word", "кое-", "конец"]) for _ in range(rng.randint(1, 4)))
            if x < 0.2:
                blocks.append("#" * rng.randint(1, 3) + " Имя " + words + rng.choice(["", "\nстрока под ним", "\n## Ещё\nтекст"]))
            elif x < 0.3:
                blocks.append(rng.choice(["| a | b |", "![x](y)", "$$z$$"]))
            else:
                blocks.append(rng.choice(["", f"<{k:03d}> "]) + words + rng.choice(["", ".", "-", ",", "**", " -", "!"]))
        pages.append(("B", f"{k:03d}.md", "\n\n".join(blocks)))
    return pages


@pytest.mark.parametrize("seed", range(6))
def test_stitching_and_chapters_as_plain_loops_make_them(spark, seed):
    pages = made_up_pages(seed)
    df = spark.createDataFrame(pages, "book_name string, file string, text string")
    blocks = [b for _, _, t in pages for b in blocks_of(t)]
    got = [r.text for r in chapters.stitched(chapters.blocks(df)).orderBy("n").collect()]
    want = plain_stitch(blocks)
    assert got == want
    for level in (0, 2):
        rows = chapters.merged(df, level).orderBy("chapter_no").collect()
        assert [(r.chapter_no, r.name, r.text) for r in rows] == plain_chapters(want, level)


@pytest.mark.parametrize("seed", range(6))
def test_stitching_by_known_words(spark, seed):
    rng = random.Random(seed)
    parts = ["сло", "во", "слово", "где", "то", "кое", "сло-во", "юго", "запад", "юго-запад", "Word", "wor", "d"]
    pages = [("B", f"{k:03d}.md", "\n\n".join(f"<{k}> " + " ".join(rng.choices(parts, k=3)) + rng.choice(["-", "-", "", "."]) for _ in range(2))) for k in range(40)]
    df = spark.createDataFrame(pages, "book_name string, file string, text string")
    known = rng.sample(["слово", "сло-во", "сло", "во", "юго-запад", "юго", "запад", "word", "wor", "d", "юго-d"], 6)
    words = spark.createDataFrame([(w,) for w in known], "word string")
    blocks = [b for _, _, t in pages for b in blocks_of(t)]
    got = [r.text for r in chapters.stitched(chapters.blocks(df), words).orderBy("n").collect()]
    assert got == plain_stitch(blocks, set(known))
    found = chapters.stitched(chapters.blocks(df), hyphens.known_words(df)).orderBy("n").collect()
    assert [r.text for r in found] == plain_stitch(blocks, plain_words(t for _, _, t in pages))
    none = chapters.stitched(chapters.blocks(df), words.limit(0)).orderBy("n").collect()
    assert [r.text for r in none] == plain_stitch(blocks)


def test_decisions_of_pairs(spark):
    words = spark.createDataFrame([("whole",), ("com-pound",), ("com",), ("pound",), ("a",), ("b",), (None,)], "word string")
    pairs = spark.createDataFrame([("Who", "le"), ("com", "Pound"), ("a", "b"), ("a", "x"), ("x", "то"), ("a", "b"), ("b", "a")], "before string, after string")
    found = {(r.before, r.after): r.keeps for r in hyphens.decisions(pairs, words).collect()}
    assert found == {("who", "le"): False, ("com", "pound"): True, ("a", "b"): True, ("a", "x"): False, ("x", "то"): True, ("b", "a"): True}


@pytest.fixture(scope="module")
def planted(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return corpus.pages(spark, SF).withColumn("tagged", T.tag_pages(F.col("text"), F.col("file"))).orderBy("book_name", "file").collect()


def test_stitched_planted_books(spark, planted):
    books = {}
    for r in planted:
        books.setdefault(r.book_name, []).extend(blocks_of(r.tagged))
    want = sorted((b, hashlib.md5(t.encode()).hexdigest()) for b, blocks in books.items() for t in plain_stitch(blocks))
    assert sorted((r.book_name, r.text) for r in QUERIES["page_stitch"](spark, SF).collect()) == want


def test_planted_books_stitched_by_known_words(spark, planted):
    books, known = {}, plain_words(r.text for r in planted)
    for r in planted:
        books.setdefault(r.book_name, []).extend(blocks_of(r.tagged))
    want = sorted((b, hashlib.md5(t.encode()).hexdigest()) for b, blocks in books.items() for t in plain_stitch(blocks, known))
    assert sorted((r.book_name, r.text) for r in QUERIES["page_stitch_words"](spark, SF).collect()) == want


def test_chapters_of_planted_books(spark, planted):
    books = {}
    for r in planted:
        books.setdefault(r.book_name, []).extend(blocks_of(r.text))
    want = sorted((b, n, hashlib.md5(t.encode()).hexdigest()) for b, blocks in books.items() for n, _, t in plain_chapters(plain_stitch(blocks)))
    assert sorted((r.book_name, r.chapter_no, r.text) for r in QUERIES["chapter_split"](spark, SF).collect()) == want


def plain_pack(body, size):
    lines = body.split("\n")
    at = next((i for i, x in enumerate(lines) if re.match(r"\A\|[\s\-:|]+\|?\Z", strip(x))), None)
    if at is None or at + 1 == len(lines):
        return [p for p in (strip(body[i : i + size]) for i in range(0, len(body), size)) if p]
    head = "\n".join(lines[: at + 1])
    out, now = [], []
    for row in lines[at + 1 :]:
        if now and len(head) + 1 + len("\n".join(now)) + 1 + len(row) + 1 > size:
            out.append(now)
            now = []
        now.append(row)
    return ["\n".join([head, *rows]) for rows in [*out, now]]


def test_packing_of_tables(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(40):
        rows = ["| " + " | ".join("x" * rng.randint(1, 30) for _ in range(2)) + " |" for _ in range(rng.randint(0, 30))]
        texts.append("\n".join(rng.choice([["Таблица 1 Имя", "| a | b |", "|---|---|"], ["| a | b |"], ["|---|"]]) + rows))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", chunks.packed(F.col("text"), 200, "intended").alias("p"))
    assert {r.id: r.p for r in df.collect()} == {i: plain_pack(t, 200) for i, t in enumerate(texts)}


def test_packed_planted_tables(spark, planted):
    want = []
    for r in planted:
        top = re.match(r"\A((?:#{1,6}\s+[^\n]*(?:\n|\Z))*)", r.text)[1]
        body = strip(re.sub(r"<\d+>", "", r.text[len(top) :]))
        if body:
            parts = [body] if len(body) <= 800 else plain_pack(body, 800)
            want += [(r.book_name, r.file, i, hashlib.md5(p.encode()).hexdigest()) for i, p in enumerate(parts)]
    assert sorted((r.book_name, r.source_file, r.chunk_index, r.text) for r in QUERIES["table_pack"](spark, SF).collect()) == sorted(want)


def test_markers_only_add_lines(spark, planted):
    """Markers come in pairs, twice marking changes nothing, and the words of a page stay as they are."""
    rows = boundaries.with_markers(corpus.pages(spark, SF)).select("book_name", "file", "text").collect()
    before = {(r.book_name, r.file): r.text for r in planted}
    again = {(r.book_name, r.file): r.text for r in boundaries.with_markers(spark.createDataFrame(rows)).collect()}
    signs = re.compile(r"\[(?:TABLE|FIGURE)_(?:START|END)\]|</?(?:caption|figure|figcaption|img)[^>]*>|!\[[^\]]*\]\([^)]*\)", re.I)
    for r in rows:
        assert [m for m in re.findall(r"\[(?:TABLE|FIGURE)_(START|END)\]", r.text)] == ["START", "END"] * r.text.count("_START]")
        assert again[r.book_name, r.file] == r.text
        words = lambda t: sorted(re.findall(r"\w+", signs.sub(" ", t)))
        assert words(r.text) == words(before[r.book_name, r.file])


def test_marker_query_counts_what_it_marked(spark, planted):
    rows = QUERIES["table_markers"](spark, SF).collect()
    assert len(rows) == len(planted) and sum(r.tables for r in rows) >= sum(r.text.count("[TABLE_START]") for r in planted)
