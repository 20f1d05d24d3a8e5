"""The three steps of reading pages, listings and vector runs, with calls made up."""

import pytest
from pyspark.sql import functions as F

from quire.plans import page_steps as S
from quire.plans import points, registry
from quire.sources import files

PAGES = "book_name string, file string, text string"


def test_steps(spark):
    images = spark.createDataFrame([("B", "001.jpg", b"abc"), ("B", "002.jpg", b"boom"), ("B", "003.jpg", b"x")], "book_name string, file string, content binary")
    log = spark.createDataFrame([("B", "003.jpg", "text", None), ("B", "001.jpg", "text", "timeout")], "book_name string, file string, step string, error string")

    def read(prompt):
        if prompt == "Ym9vbQ==":
            raise RuntimeError("Insufficient balance")
        return f"read {prompt}"

    texts = {r.file: (r.text, r.error) for r in S.page_texts(S.unread(images, log, "text"), read, 0.0).collect()}
    assert texts == {"001.jpg": ("read YWJj", None), "002.jpg": (None, "Insufficient balance")}
    assert [r.file for r in S.contents_texts(images.limit(1), read, 0.0).collect()] == ["001.md"]


def test_images_of_a_page(spark):
    text = "a [IMAGE_1]\n[CAPTION_1] Рис. 1. Имя\nb [IMAGE_2] [CAPTION_2] два [IMAGE_3]\nc"
    pages = spark.createDataFrame([("B", "007.md", text)], PAGES)
    boxes = spark.createDataFrame([("B", "007.md", '```json\n{"IMAGE_1": [0, 0, 500, 1000], "IMAGE_2": [5, 5, 5, 5], "IMAGE_3": [0, 100, 100, 200]}\n```')], "book_name string, file string, answer string")
    sizes = spark.createDataFrame([("B", "007.md", 200, 100)], "book_name string, file string, width int, height int")
    rows = sorted(S.image_requests(pages, boxes, sizes).collect(), key=lambda r: r.image_no)
    assert [(r.image_no, r.caption, r.crop_name, tuple(r.crop)) for r in rows] == [(1, "Рис. 1. Имя", "007_image_1.jpg", (0, 0, 200, 50)), (3, "Нет подписи.", "007_image_3.jpg", (20, 0, 40, 10))]
    seen = []

    def call(prompt):
        return "no <SKIP>" if "Нет подписи" in prompt else prompt

    told = {r.image_no: r.description for r in S.descriptions(spark.createDataFrame(rows), "Опиши", call, 0.0).collect()}
    assert told == {1: f"ОРИГИНАЛЬНАЯ ПОДПИСЬ:\nРис. 1. Имя\n\nКОНТЕКСТ ИЗ КНИГИ (вокруг картинки):\n{rows[0].context}\n\nЗАДАЧА:\nОпиши", 3: None}
    kept = S.with_descriptions(pages, spark.createDataFrame(rows).select("book_name", "file", "image_no")).first().text
    assert kept == "a [IMAGE_1]\n[CAPTION_1] Рис. 1. Имя\nb  [IMAGE_3]\nc" and seen == []


def test_final_errors():
    assert all(registry.is_fatal(x) for x in ("No resource package", "Please recharge", 'x "code":"1113" y', 'code": "1113"', "Authentication failed", "incorrect API key"))
    assert not registry.is_fatal("quota of retries") and not registry.is_fatal("timeout")


def test_models_and_vectors(spark):
    assert points.dimension("neuroapi-small") == 1536 and points.dimension("minilm-l12") == 384 and points.dimension("gigachat-embed") == 1024
    described = spark.createDataFrame([("A, B", "b.jpg", "вид сбоку"), ("A, B", "a.jpg", "вид"), ("C", "z.jpg", "")], "book_name string, image string, description string")
    rows = sorted(points.vector_run(points.image_points(described), "e5-small").collect(), key=lambda r: (r.payload.book_name, r.idx))
    assert [(r.idx, r.payload.text, r.payload.author, len(r.dense)) for r in rows] == [(100000, "вид", "A", 384), (100001, "вид сбоку", "A", 384), (100000, "", None, 384)]
    points.PROVIDERS["broken"] = lambda texts, dim: []
    old = points.MODELS
    points.MODELS = (*old, ("bad", "bad", "broken", 3))
    try:
        with pytest.raises(Exception, match="texts, but 0 vectors"):
            points.vector_run(points.image_points(described), "bad").collect()
    finally:
        points.MODELS = old
        del points.PROVIDERS["broken"]


def test_upsert_has_an_order(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "id int, text string")
    new = spark.createDataFrame([(2, "b"), (2, "c"), (3, "x")], "id int, text string")
    for n in (1, 3):
        assert sorted(map(tuple, points.upserted(old, new.repartition(n)).collect())) == [(1, "old"), (2, "c"), (3, "x")]


def test_a_failed_version_is_not_read(spark, tmp_path):
    c = points.Collections(spark, str(tmp_path))
    c.write("k", spark.createDataFrame([(1, "a")], "id int, text string"))
    (tmp_path / "k" / "versions" / "00000001").mkdir()
    assert c.read("k").count() == 1
    c.write("k", spark.createDataFrame([(2, "b")], "id int, text string"))
    assert sorted(r.id for r in c.read("k").collect()) == [1, 2]


def test_listings(spark, tmp_path):
    for name in ("B 1/convert_in_jpg/toc/1.JPG", "B 1/convert_in_jpg/toc/x.txt", "B2/convert_in_jpg/toc/2.jpeg", "B2/split_pdf/p.pdf", "out/a/a.md", "out/b/b.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"xy")
    toc = files.book_files(spark, str(tmp_path), "convert_in_jpg/toc", ("jpg", "jpeg"))
    assert sorted((r.book_name, r.file, r.bytes) for r in toc.collect()) == [("B 1", "1.JPG", 2), ("B2", "2.jpeg", 2)]
    assert [r.file for r in files.book_files(spark, str(tmp_path), "split_pdf", ("pdf",), ["B2"]).collect()] == ["p.pdf"]
    assert [r.stem for r in files.parsed_stems(spark, f"{tmp_path}/out").collect()] == ["a"]
    names = spark.createDataFrame([("1.JPG",), ("9.jpg",)], "file string")
    assert [r.file for r in files.available(names, toc, toc.limit(0)).collect()] == ["1.JPG"]
    assert names.select(F.col("file")).count() == 2
