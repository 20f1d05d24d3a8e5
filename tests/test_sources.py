from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import chunks
from quire.sources import files
from quire.streaming.ingest import ingest


def lay_out(root):
    for book, stage, name, text in [("A, B", "parsed", "001.md", "x"), ("A, B", "parsed", "002.md", "y"), ("C", "parsed", "010.md", "z"), (".h", "parsed", "1.md", "no")]:
        (root / book / stage).mkdir(parents=True, exist_ok=True)
        (root / book / stage / name).write_text(text)
    (root / "C/parsed/010.JPG").write_bytes(b"j")
    (root / "C/parsed/010.png").write_bytes(b"p")


def test_pages_and_images(spark, tmp_path):
    lay_out(tmp_path)
    pages = files.read_pages(spark, str(tmp_path), "parsed")
    assert sorted((r.book_name, r.page_no, r.text) for r in pages.collect()) == [("A, B", 1, "x"), ("A, B", 2, "y"), ("C", 10, "z")]
    assert files.read_pages(spark, str(tmp_path), "parsed", ["C"]).count() == 1
    images = files.read_images(spark, str(tmp_path), "parsed")
    assert files.pages_with_images(pages, images).select("image_file").first().image_file == "010.JPG"
    assert files.preferred(pages.filter("page_no = 1"), pages).count() == 3


def test_chunks_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("B", "text", "t", 0)], "book_name string, chunk_type string, text string, chunk_index int")
    files.write_chunks(d, str(tmp_path / "c"))
    files.write_chunks(d.withColumn("chunk_type", F.lit("table")), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
    (tmp_path / "j").mkdir()
    (tmp_path / "j/1.json").write_text('[{"text": "a", "metadata": {"chunk_type": "text", "headers": {"1": "h"}}}]')
    (tmp_path / "j/2.json").write_text('"no list"')
    assert [r.metadata.headers for r in files.read_chunks(spark, str(tmp_path / "j")).collect()] == [{"1": "h"}]


def test_descriptions_and_offsets(spark):
    raw = spark.createDataFrame([("B", '[{"image_filename": "f", "ai_description": "d"}]'), ("C", '{"k": "v"}')], "book_name string, value string")
    assert sorted(map(tuple, files.image_descriptions(raw).collect())) == [("B", "img_0", ""), ("C", "k", "v")]
    assert ("B", "f", "d") in set(map(tuple, files.image_descriptions(raw, "intended").collect()))
    d = spark.createDataFrame([("B", "1.pdf", 3), ("B", "2.pdf", 2)], "book_name string, file string, pages int")
    assert [r.first_page for r in files.page_offsets(d).orderBy("file").collect()] == [1, 4]
    tei = spark.createDataFrame([("f", '<TEI><body><p>As shown <ref type="bibr" target="#b1">[1]</ref> by many.</p></body></TEI>')], "file string, value string")
    row = files.citation_contexts(tei).first()
    assert (row.ref_id, row.marker) == ("b1", "[1]") and "As shown" in row.context and "by many" in row.context


def test_ingest(spark, tmp_path):
    lay_out(tmp_path / "in")
    run = lambda: ingest(spark, str(tmp_path / "in"), "parsed", str(tmp_path / "out"), str(tmp_path / "ck"), lambda d: chunks.text_chunks(d.filter("book_name not like '.%'").withColumn("text", T.tag_pages(F.col("text"), F.col("file"))).withColumnRenamed("file", "source_file"))).awaitTermination()
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    (tmp_path / "in/C/parsed/011.md").write_text("new")
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_articles(spark):
    from quire.operators import articles

    tei = (
        '<TEI><teiHeader><title>A  <i>b</i></title><persName><forename>X</forename><surname>Y</surname></persName><date when="2001-02"/><idno type="DOI">10/1</idno></teiHeader>'
        '<text><body>See <ref type="bibr" target="#b0">(Z)</ref>.</body><listBibl><biblStruct xml:id="b0"><title>T</title><persName>Z</persName><date when="1999"/></biblStruct></listBibl></text></TEI>'
    )
    d = spark.createDataFrame([("f", tei)], "file string, value string")
    m = articles.metadata(d).first()
    assert (m.title, m.authors, m.year, m.doi, m.abstract) == ("A b", ["X Y"], "2001", "10/1", None)
    row = articles.cited(files.citation_contexts(d), articles.bibliography(d)).first()
    assert (row.ref_id, row.title, row.authors, row.year) == ("b0", "T", ["Z"], "1999")
    a = spark.createDataFrame([("B", "1", "Таблица 1 x\nТаблица 2 y\n<table>1</table> and <table>2</table>"), ("B", "2", "none")], "book_name string, file string, answer string")
    assert [(r.idx, r.caption, r.html) for r in articles.answered_tables(a).orderBy("idx").collect()] == [(0, "Таблица 1 x", "<table>1</table>"), (1, "", "<table>2</table>")]


def test_stage_tables_and_reports(spark, tmp_path):
    d = spark.createDataFrame([("B", "1.md", ["x", "y"]), ("C", "2.md", None)], "book_name string, file string, authors array<string>")
    files.write_stage(d, str(tmp_path / "s"))
    files.write_stage(d.filter("book_name = 'B'"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2 and files.stage_books(d).count() == 2
    files.append_log(d, str(tmp_path / "l"))
    files.append_log(d, str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).count() == 4
    files.export_csv(d, str(tmp_path / "csv"))
    assert sorted(r.authors or "" for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()) == ["", "x; y"]
    assert files.with_crops(d, spark.createDataFrame([("B", "1")], "book_name string, stem string")).count() == 1
