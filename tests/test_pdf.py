"""PDF pages: counts, boxes, offsets and round trips on made-up files of several kinds."""

import re
import zlib

import pytest

from quire.sources import pdf as P

SCHEMA = "file string, content binary"


def body(pages, shared=b"/Font <</F1 5 0 R>>"):
    """(number, object) of a file: two levels of the page tree, boxes and resources inherited."""
    kids = [10 + 2 * k for k in range(len(pages))]
    out = [(1, b"<</Type/Catalog/Pages 2 0 R>>"), (2, b"<< /Type /Pages /Kids [3 0 R 4 0 R] /Count %d /MediaBox [0 0 300 400] /Resources <<%s>> >>" % (len(pages), shared))]
    half = len(kids) // 2
    for number, own in ((3, kids[:half]), (4, kids[half:])):
        out.append((number, b"<</Type/Pages/Parent 2 0 R/Count %d/Kids[%s]>>" % (len(own), b" ".join(b"%d 0 R" % k for k in own))))
    out.append((5, b"<</Type/Font/BaseFont/Helvetica/Next 6 0 R>>"))
    out.append((6, b"[(a \\) (nested) >> string) <00ff> true null -1.5 /Name#20x 5 0 R]"))
    for k, (text, more) in zip(kids, pages):
        out.append((k, b"<</Type/Page/Parent 2 0 R/Contents %d 0 R%s>>" % (k + 1, more)))
        out.append((k + 1, b"<</Length %d>>\nstream\n%s\nendstream" % (len(text), text)))
    return out


def classic(objects, broken=False, extra=b""):
    out, places = bytearray(b"%PDF-1.4\n% comment (\n"), {}
    for number, data in objects:
        places[number] = len(out)
        out += b"%d 0 obj\n%s\nendobj\n" % (number, data)
    at, size = len(out), max(places) + 1
    out += b"xref\n0 %d\n" % size + b"".join(b"%010d 00000 %s \n" % (places.get(n, 0), b"n" if n in places else b"f") for n in range(size))
    return bytes(out + b"trailer\n<</Size %d/Root 1 0 R%s>>\nstartxref\n%d\n%%%%EOF" % (size, extra, at + 7 * broken))


def modern(objects):
    """Objects without streams packed in an object stream, and a table that is a stream with a predictor."""
    plain = [(n, d) for n, d in objects if b"stream" not in d]
    out, rows = bytearray(b"%PDF-1.5\n"), {0: (0, 0, 0)}
    for number, data in objects:
        if b"stream" in data:
            rows[number] = (1, len(out), 0)
            out += b"%d 0 obj\n%s\nendobj\n" % (number, data)
    texts = [d for _, d in plain]
    starts = [sum(len(t) + 1 for t in texts[:i]) for i in range(len(texts))]
    head = b" ".join(b"%d %d" % (n, s) for (n, _), s in zip(plain, starts)) + b" "
    packed = zlib.compress(head + b"\n".join(texts))
    holder = max(n for n, _ in objects) + 1
    rows |= {n: (2, holder, i) for i, (n, _) in enumerate(plain)} | {holder: (1, len(out), 0)}
    out += b"%d 0 obj\n<</Type/ObjStm/N %d/First %d/Filter/FlateDecode/Length %d>>\nstream\n%s\nendstream\nendobj\n" % (holder, len(plain), len(head), len(packed), packed)
    at, table = len(out), holder + 1
    rows[table] = (1, at, 0)
    raw, before = bytearray(), bytes(6)
    for n in range(table + 1):
        kind, a, b = rows.get(n, (0, 0, 0))
        row = bytes([kind]) + a.to_bytes(4, "big") + bytes([b])
        raw += b"\x02" + bytes((x - y) & 255 for x, y in zip(row, before))
        before = row
    data = zlib.compress(bytes(raw))
    out += b"%d 0 obj\n<</Type/XRef/Size %d/W[1 4 1]/Root 1 0 R/Filter/FlateDecode/DecodeParms<</Predictor 12/Columns 6>>/Length %d>>\nstream\n%s\nendstream\nendobj\n" % (table, table + 1, len(data), data)
    return bytes(out + b"startxref\n%d\n%%%%EOF" % at)


PAGES = [(b"BT (one) Tj ET", b""), (b"two endobj 9 0 obj", b"/MediaBox[0 0 100.5 50]"), (b"three", b"/MediaBox [10 20 110 220] /Rotate 90"), (b"", b"/CropBox [0 0 50 60]/Annots [12 0 R]"), (b"\x00\xff\r\n five", b"")]
BOXES = [(300, 400), (100.5, 50), (200, 100), (50, 60), (300, 400)]


def read(data):
    pdf = P.Pdf(data)
    found = []
    for page in pdf.pages():
        contents = pdf.get(page["/Contents"])
        found.append((pdf.box(page), contents.data, pdf.get(pdf.get(pdf.get(page["/Resources"])["/Font"])["/F1"])["/BaseFont"]))
    return found


WANTED = [(b, t, "/Helvetica") for (t, _), b in zip(PAGES, BOXES)]


@pytest.mark.parametrize("make", [classic, modern, lambda o: classic(o, broken=True), lambda o: re.sub(rb"(?s)xref\n.*", b"trailer <</Root 1 0 R>>", classic(o)), lambda o: b"".join(b"%d 0 obj %s endobj\r" % x for x in o)])
def test_files_of_several_kinds(make):
    assert read(make(body(PAGES))) == WANTED


def test_later_tables_count():
    data = classic(body(PAGES))
    at = len(data)
    data += b"\n13 0 obj\n<</Length 3>>\nstream\nnew\nendstream\nendobj\n"
    table = len(data)
    data += b"xref\n13 1\n%010d 00000 n \ntrailer\n<</Size 20/Root 1 0 R/Prev %d>>\nstartxref\n%d\n%%%%EOF" % (at + 1, int(re.findall(rb"startxref\n(\d+)", data)[-1]), table)
    assert [t for _, t, _ in read(data)] == [b"BT (one) Tj ET", b"new", *[t for _, t, _ in WANTED[2:]]]


@pytest.mark.parametrize("make", [classic, modern])
def test_round_trip_of_single_pages(make):
    pdf = P.Pdf(make(body(PAGES)))
    for page, want in zip(pdf.pages(), WANTED):
        alone = pdf.single(page)
        assert read(alone) == [want] and alone.count(b"/Type /Page ") == 1
        again = P.Pdf(alone)
        assert again.single(next(again.pages())) == alone
        font = again.get(again.get(again.get(next(again.pages())["/Resources"])["/Font"])["/F1"])
        assert again.get(font["/Next"])[:6] == [b"(a \\) (nested) >> string)", b"<00ff>", b"true", None, -1.5, "/Name#20x"]


def test_splitting_numbers_on_over_files(spark):
    files = [("b.pdf", classic(body(PAGES))), ("a, x.PDF", modern(body(PAGES[:3]))), ("c.pdf", b""), ("bad.pdf", b"%PDF no objects"), ("d.pdf", classic(body(PAGES[:2]))), ("e.pdf", classic(body(PAGES[:1]), extra=b"/Encrypt 5 0 R"))]
    rows = P.split_files(spark.createDataFrame(files, SCHEMA), 998).collect()
    found = {r.path: r for r in rows if r.error is None}
    assert sorted(found) == sorted(["a, x/split_pdf/998.pdf", "a, x/split_pdf/999.pdf", "a, x/split_pdf/1000.pdf", *[f"b/split_pdf/{n}.pdf" for n in range(1001, 1006)], "d/split_pdf/1006.pdf", "d/split_pdf/1007.pdf"])
    assert read(bytes(found["b/split_pdf/1003.pdf"].content)) == [WANTED[2]] and (found["b/split_pdf/1003.pdf"].width, found["b/split_pdf/1003.pdf"].height) == BOXES[2]
    errors = {r.file: r.error for r in rows if r.error is not None}
    assert set(errors) == {"c.pdf", "bad.pdf", "e.pdf"} and errors["e.pdf"] == "the file is encrypted" and all(r.path is None for r in rows if r.error)
    small = P.split_files(spark.createDataFrame(files[:1], SCHEMA)).collect()
    assert sorted(r.path for r in small) == [f"b/split_pdf/{n:03d}.pdf" for n in range(5)]
    assert P.split_files(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        P.split_files(spark.createDataFrame(files, SCHEMA), -1)


def test_page_info(spark):
    data = classic(body(PAGES[1:]))
    row = P.page_info(spark.createDataFrame([("x.pdf", data)], SCHEMA), 144).first()
    assert (row.file, row.width_px, row.height_px, row.pdf_size_bytes, row.dpi) == ("x.pdf", 201, 100, len(data), 144)


def test_odd_objects_end():
    deep = b"[" * 50_000 + b"]" * 50_000
    loop = [(1, b"<</Type/Catalog/Pages 2 0 R>>"), (2, b"<</Type/Pages/Kids[2 0 R 3 0 R 3 0 R]>>"), (3, b"<</Type/Page/X " + deep[:20_000] + b"]" * 0 + b"]" * 20_000 + b">>")]
    assert len(list(P.Pdf(classic(loop)).pages())) == 1
    with pytest.raises(Exception):
        list(P.Pdf(b"1 0 obj <</Type/Catalog/Pages 1 0 R").pages())[0]["/Contents"]
