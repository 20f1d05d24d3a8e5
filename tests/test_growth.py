"""Joins make rows in proportion to their input, however large a group of equal keys is."""

import os
import re
import time

import pytest

from quire.llm import simhash
from quire.operators import chapters, headings, page_files
from quire.queries import QUERIES
from quire.sources import store


def rows_made(spark, run, kind="Join"):
    """The most rows that a node of the kind makes in the executions that run() starts."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()

    def ids():
        bus.waitUntilEmpty(30_000)
        found = store.executionsList()
        return {found.apply(i).executionId() for i in range(found.size())}

    before = ids()
    run()
    most = 0
    for k in ids() - before:
        nodes, values = store.planGraph(k).allNodes(), store.executionMetrics(k)
        for i in range(nodes.size()):
            metrics = nodes.apply(i).metrics()
            for m in [metrics.apply(j) for j in range(metrics.size())] if kind in nodes.apply(i).name() else []:
                if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    most = max(most, int(re.sub(r"\D", "", values.apply(m.accumulatorId())) or 0))
    return most


@pytest.mark.parametrize("head", ["Раздел {} Общие сведения", "1.{} Общие сведения"])
def test_headings_with_one_text_are_not_multiplied_by_entries_with_it(spark, head):
    n = 300
    toc = spark.createDataFrame([("B", k, head.format(k), 1 + k % 3) for k in range(2, n, 2)], "book_name string, ord long, raw_text string, level int")
    lines = spark.createDataFrame([("B", "f.md", k, "# " + head.format(k)) for k in range(n)], "book_name string, file string, line_no int, line string")
    found = []
    made = rows_made(spark, lambda: found.extend(headings.matches(headings.heading_candidates(lines), toc).collect()))
    number = "C" if head.startswith("Р") else "A"
    # An entry of the number, or else the first entry of the text.
    want = {k: (number, k) if k and k % 2 == 0 else ("E", 2) for k in range(n)}
    assert {r.line_no: (r.strategy, r.entry) for r in found} == want
    assert 0 < made <= 4 * n


def test_components_of_a_group_found_in_many_cells_come_from_about_one_edge_a_node(spark):
    n, cells = 400, 16
    # As bands give them: in each cell the nodes have another root.
    edges = spark.createDataFrame([(c, k) for c in range(cells) for k in range(cells, n) if (k + c) % 3] + [(900, 901)], "a long, b long")
    found = {}
    made = rows_made(spark, lambda: found.update({r.node: r.root for r in simhash.components(edges).collect()}))
    assert found == {**{k: 0 for k in range(n)}, 900: 900, 901: 900}
    assert 0 < made <= 3 * n


def test_a_block_of_one_long_word_is_read_once_for_the_word_before_its_hyphen(spark):
    long = "я" * 300_000
    pages = spark.createDataFrame([("B", "1.md", f"<1> {long}"), ("B", "2.md", f"<2> {long} сло-"), ("B", "3.md", "<3> во.")], "book_name string, file string, text string")
    words = spark.createDataFrame([("слово",)], "word string")
    began = time.time()
    found = [r.text for r in chapters.stitched(chapters.blocks(pages), words).collect()]
    assert time.time() - began < 40
    assert found == [f"<1> {long} <2> {long} сло<3>во."]


def test_a_line_of_one_long_word_is_read_once_for_the_word_that_may_be_broken(spark, tmp_path):
    texts = [(k, "src0", "я" * 300_000 + "!\nсло-\nво слово слово") for k in range(2)]
    spark.createDataFrame(texts, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    began = time.time()
    found = {(r.before, r.after, r.keeps) for r in QUERIES["hyphen_words"](spark, str(tmp_path)).collect()}
    assert time.time() - began < 40
    assert ("сло", "во", False) in found


def test_white_space_above_a_table_is_read_once(spark):
    text = "a" + " " * 300_000 + "b\n| x | y |\n|---|---|\n| 1 | 2 |"
    pages = spark.createDataFrame([("B", "1.md", text)], "book_name string, file string, text string")
    began = time.time()
    (row,) = page_files.page_tables(pages).collect()
    assert time.time() - began < 40
    assert row.caption == "a" + " " * 300_000 + "b"  # one line, the last of a long paragraph


class Movers(store.FolderStore):
    """A folder that notes which process moved a file."""

    def __init__(self, options):
        super().__init__(options)
        self.log = options["log"]

    def move(self, source, target):
        with open(f"{self.log}/{os.getpid()}", "a") as f:
            f.write("x")
        super().move(source, target)


def test_staged_files_are_moved_by_many_tasks(spark, tmp_path):
    root, log = str(tmp_path / "books"), tmp_path / "log"
    log.mkdir()
    files = spark.range(400).selectExpr("concat('B/md/', id, '.md') as path", "encode(cast(id as string), 'UTF-8') as content")
    store.write(files, root, log=str(log), **{"class": "tests.test_growth:Movers"})
    moves = [p.stat().st_size for p in log.iterdir()]
    assert sum(moves) == 400 and len(moves) > 1
    assert {r.path: bytes(r.content) for r in store.contents(spark, root).collect()} == {f"B/md/{i}.md": str(i).encode() for i in range(400)}
