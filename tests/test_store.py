"""The store source and sink: listing, pushed filters, writes that are whole or nothing, stores of other kinds, the read-through cache."""

import os

import pytest
from pyspark.sql import functions as F

from quire.sources import cache, store


class CloudDisk(store.FolderStore):
    """A store that wants a token and counts what is asked of it."""

    def __init__(self, options):
        if options.get("token") != "secret":
            raise PermissionError("the token is not valid")
        super().__init__(options)
        self.log = options.get("log")

    def get(self, path):
        if self.log:
            with open(f"{self.log}/{os.getpid()}-{path.replace('/', '_')}", "a") as f:
                f.write("x")
        return super().get(path)


CLOUD = {"class": "tests.test_store:CloudDisk", "token": "secret"}


def tree(root):
    """The files but staged ones of writes."""
    found = (os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names)
    return sorted(p for p in found if not p.startswith("_staging/") or p == "_staging/x/y.md")


@pytest.fixture
def books(tmp_path):
    for path, content in {
        "A, one/md/001.md": "first", "A, one/md/002.MD": "second", "A, one/jpg/001.jpg": "\x00", "B/md/deep/003.md": "third", "B/none": "", "top.md": "t", ".hidden/md/1.md": "no", "_staging/x/y.md": "no",
    }.items():
        at = tmp_path / "books" / path
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text(content)
    return str(tmp_path / "books")


def test_listing_and_contents(spark, books):
    rows = {r.path: r for r in store.listing(spark, books).collect()}
    assert sorted(rows) == ["A, one/jpg/001.jpg", "A, one/md/001.md", "A, one/md/002.MD", "B/md/deep/003.md", "B/none", "top.md"]
    one = rows["A, one/md/002.MD"]
    assert (one.book_name, one.stage, one.file, one.stem, one.extension, one.bytes) == ("A, one", "md", "002.MD", "002", "md", 6)
    assert (rows["B/none"].stage, rows["B/none"].extension, rows["top.md"].book_name) == (None, "", None)
    assert {r.path: bytes(r.content) for r in store.contents(spark, f"file://{books}").filter("extension = 'md'").collect()} == {
        "A, one/md/001.md": b"first", "A, one/md/002.MD": b"second", "B/md/deep/003.md": b"third", "top.md": b"t",
    }
    assert store.listing(spark, books + "/absent").count() == 0


@pytest.mark.parametrize(
    "condition",
    ["book_name = 'B'", "book_name in ('A, one', 'x') and extension = 'md'", "stage = 'jpg'", "path like 'A%'", "file like '%.md'", "book_name is null", "book_name <> 'B'", "bytes > 4 and extension in ('md')", "book_name = 'none'", "stem = '001' or stage is null"],
)
def test_filters_give_what_they_give_without_pushing(spark, books, condition):
    every = spark.createDataFrame(store.listing(spark, books).collect(), store.StoreSource({"content": "false"}).schema())
    assert sorted(store.listing(spark, books).filter(condition).collect()) == sorted(every.filter(condition).collect())


def test_filters_leave_out_folders_before_they_are_listed(books):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    reader = store.StoreReader({"root": books}, False)
    other = GreaterThan(("bytes",), 3)
    assert list(reader.pushFilters([EqualTo(("book_name",), "B"), other, In(("extension",), ("md",))])) == [other]
    (part,) = reader.partitions()
    assert part.folders == ["B"] and not part.top
    assert [r[0] for r in reader.read(part)] == ["B/md/deep/003.md"]
    assert len(store.StoreReader({"root": books, "partitions": "8"}, False).partitions()) == 2


def test_write_replaces_and_keeps(spark, books):
    rows = spark.createDataFrame([("B/md/deep/003.md", b"new"), ("C/md/1.md", b"c"), ("D/a/b/c/2.bin", b"")], "path string, content binary")
    before = tree(books)
    store.write(rows, books)
    assert set(tree(books)) - set(before) == {"C/md/1.md", "D/a/b/c/2.bin"} and set(before) < set(tree(books))
    assert open(f"{books}/B/md/deep/003.md").read() == "new"
    store.write(rows, books, overwrite=True)
    assert {r.path for r in store.listing(spark, books).collect()} == {"B/md/deep/003.md", "C/md/1.md", "D/a/b/c/2.bin", "top.md"}
    store.write(rows.limit(0), books)
    assert open(f"{books}/B/md/deep/003.md").read() == "new"


@pytest.mark.parametrize("bad", [("x/../../y", b"1"), ("/abs", b"1"), ("_staging/z", b"1"), (None, b"1"), ("ok", None), ("E/0.md", b"again")])
def test_a_failed_write_leaves_the_store_as_it_was(spark, books, bad):
    before = {p: open(os.path.join(books, p), "rb").read() for p in tree(books)}
    rows = spark.createDataFrame([(f"E/{i}.md", b"e") for i in range(20)] + [bad], "path string, content binary").repartition(4)
    with pytest.raises(Exception, match="path|content"):
        store.write(rows, books)
    assert {p: open(os.path.join(books, p), "rb").read() for p in tree(books)} == before
    assert store.listing(spark, books).filter("path like '%E/%'").isEmpty()


def test_staged_files_of_dead_writes_go(books):
    assert store.tidied(books) == 0 and os.path.exists(f"{books}/_staging/x/y.md")
    assert store.tidied(books, older=-1) == 1 and not os.path.exists(f"{books}/_staging/x")


def test_a_repeated_attempt_is_not_mixed_in(books):
    """Only attempts whose message comes back are moved."""
    from pyspark.sql import Row
    from pyspark.sql.types import StructType

    writer = store.StoreWriter({"root": books}, StructType.fromDDL("path string, content binary"), False)
    writer.write(iter([Row(path="F/1.md", content=b"lost"), Row(path="F/2.md", content=b"lost")]))
    message = writer.write(iter([Row(path="F/1.md", content=b"kept")]))
    writer.commit([message, None])
    assert [p for p in tree(books) if p.startswith("F")] == ["F/1.md"] and open(f"{books}/F/1.md").read() == "kept"
    assert not os.path.exists(f"{books}/{writer.run}")


def test_stores_of_other_kinds(spark, books, tmp_path):
    cloud = str(tmp_path / "cloud")
    store.copied(spark, {"root": books}, {"root": cloud, **CLOUD}, F.col("extension") == "md")
    assert tree(cloud) == ["A, one/md/001.md", "A, one/md/002.MD", "B/md/deep/003.md", "top.md"]
    assert store.contents(spark, cloud, **CLOUD).filter("book_name = 'B'").first().content == b"third"
    with pytest.raises(Exception, match="token"):
        store.listing(spark, cloud, **{**CLOUD, "token": "other"}).count()
    wanted = spark.createDataFrame([("B/none",), ("B/other",)], "path string")
    assert [r.path for r in store.missing(wanted, store.listing(spark, books)).collect()] == ["B/other"]
    store.saved(spark.createDataFrame([("G/x.md", b"g")], "path string, content binary"), books, {"root": cloud, **CLOUD})
    assert "G/x.md" in tree(cloud) and "G/x.md" in tree(books)


def test_fetching_deals_out_a_large_book(spark, tmp_path):
    root = str(tmp_path / "one")
    store.write(spark.range(40).selectExpr("concat('H/md/', id, '.md') as path", "encode(cast(id as string), 'UTF-8') as content"), root)
    got = store.fetched(store.listing(spark, root), root, partitions=8)
    assert {r.path: bytes(r.content) for r in got.collect()} == {f"H/md/{i}.md": str(i).encode() for i in range(40)}
    assert got.select(F.spark_partition_id()).distinct().count() > 4


def test_a_second_read_through_fetches_nothing(spark, books, tmp_path):
    at, log = str(tmp_path / "cache"), tmp_path / "log"
    log.mkdir()
    options = {**CLOUD, "log": str(log)}
    listed = store.listing(spark, books, **options).filter("extension = 'md'")
    read = lambda: {r.path: (bytes(r.content), r.sha256) for r in cache.read_through(listed, at, books, **options).collect()}
    first = read()
    assert {p: c for p, (c, _) in first.items()} == {"A, one/md/001.md": b"first", "A, one/md/002.MD": b"second", "B/md/deep/003.md": b"third", "top.md": b"t"}
    asked = sorted(p.name for p in log.iterdir())
    assert len(asked) == 4 and all(p.read_text() == "x" for p in log.iterdir())
    assert read() == first and sorted(p.name for p in log.iterdir()) == asked and all(p.read_text() == "x" for p in log.iterdir())
    with open(f"{books}/top.md", "w") as f:
        f.write("first")  # a new version, of a content that the cache has
    assert cache.filled(listed, at, books, **options) == 1
    assert read()["top.md"] == first["A, one/md/001.md"]
    assert cache.table(spark, at, "objects", cache.OBJECTS).count() == 4
    old = cache.expired(spark, at).collect()
    assert [r.path for r in old] == ["top.md"] and old[0].sha256 == first["top.md"][1]
    cache.compacted(spark, at, str(tmp_path / "small"))
    assert cache.table(spark, str(tmp_path / "small"), "objects", cache.OBJECTS).count() == 3 and cache.expired(spark, str(tmp_path / "small")).isEmpty()
    assert cache.filled(listed, str(tmp_path / "small"), books, **options) == 0
    assert cache.filled(listed.limit(0), str(tmp_path / "none"), books, **options) == 0
