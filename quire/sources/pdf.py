"""PDF files cut into pages: a table function over binary rows walks a file's objects from the cross-reference table to the page tree, and writes each page
with the objects that it refers to as a file of its own. Contents are copied as they are; nothing is rendered.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.sources.shared import computed

POINTS = 72  # an inch
DPI = 200
PAGE_ROW = "page_index int, pages int, width double, height double, page binary, error string"
INHERITED = ("/Resources", "/MediaBox", "/CropBox", "/Rotate")
LETTER = [0, 0, 612, 792]  # fixed value: the box of a page that has none

_SPACE = re.compile(rb"(?:[\x00\t\n\x0c\r ]|%[^\r\n]*)*")
_ATOM = re.compile(rb"/[^\x00\t\n\x0c\r ()<>\[\]{}/%]*|[^\x00\t\n\x0c\r ()<>\[\]{}/%]+")
_REF = re.compile(rb"(\d+)[\x00\t\n\x0c\r ]+(\d+)[\x00\t\n\x0c\r ]+R(?![^\x00\t\n\x0c\r ()<>\[\]{}/%])")
_OBJECT = re.compile(rb"(?<!\d)(\d+)[\x00\t\n\x0c\r ]+(\d+)[\x00\t\n\x0c\r ]+obj(?![a-z])")
_PARENTHESIS = re.compile(rb"\\.|[()]", re.S)


@dataclass(frozen=True)
class Ref:
    number: int


@dataclass
class Stream:
    about: dict
    data: bytes


class Pdf:
    """The objects of a file. Values are dicts with names for keys, lists, references, numbers, and bytes as they stand in the file for all else."""

    def __init__(self, data: bytes) -> None:
        self.data, self.places, self.trailer, self.known = data, {}, {}, {}
        try:
            self.follow(int(re.findall(rb"startxref\s+(\d+)", data[-2048:])[-1]))
            if not isinstance(self.get(self.get(self.trailer["/Root"])["/Pages"]), dict):
                raise ValueError("no pages")
        except (ValueError, KeyError, IndexError, TypeError, zlib.error):
            self.scan()
        if "/Encrypt" in self.trailer:
            raise ValueError("the file is encrypted")

    def scan(self) -> None:
        """Finds the objects without a table: of those with one number the last counts."""
        self.places, self.known = {int(m[1]): m.start() for m in _OBJECT.finditer(self.data)}, {}
        for m in re.finditer(rb"trailer", self.data):
            self.trailer |= self.value(m.end())[0] or {}
        for number in list(self.places):
            found = self.get(Ref(number))
            about = found.about if isinstance(found, Stream) else found
            if isinstance(found, Stream) and about.get("/Type") == "/ObjStm":
                self.places |= {n: (number, i) for i, n in enumerate(self.packed(found)[0]) if n not in self.places}
            if isinstance(about, dict) and (about.get("/Type") == "/Catalog" or "/Root" in about):
                self.trailer.setdefault("/Root", Ref(number) if about.get("/Type") == "/Catalog" else about["/Root"])

    def follow(self, at: int) -> None:
        """Reads the table at a place and those before it; entries of later tables count."""
        seen = set()
        while at is not None and at not in seen:
            seen.add(at)
            start = _SPACE.match(self.data, at).end()
            about = self.table(start + 4) if self.data.startswith(b"xref", start) else self.stream_table(start)
            self.trailer = about | self.trailer
            if "/XRefStm" in about:
                self.stream_table(int(about["/XRefStm"]))
            at = int(about["/Prev"]) if "/Prev" in about else None

    def table(self, at: int) -> dict:
        head = re.compile(rb"\s*(\d+)\s+(\d+)\s*(?=\d)|\s*trailer")
        entry = re.compile(rb"\s*(\d+)\s+(\d+)\s+([nf])")
        while (m := head.match(self.data, at)) and m[1]:
            at = m.end()
            for number in range(int(m[1]), int(m[1]) + int(m[2])):
                e = entry.match(self.data, at)
                if not e:
                    raise ValueError("a broken table")
                at = e.end()
                if e[3] == b"n":
                    self.places.setdefault(number, int(e[1]))
        if not m:
            raise ValueError("a table without a trailer")
        return self.value(m.end())[0]

    def stream_table(self, at: int) -> dict:
        found = self.object_at(at)
        if not isinstance(found, Stream):
            raise ValueError("no table")
        widths, data = [int(w) for w in found.about["/W"]], self.decoded(found)
        index = found.about.get("/Index") or [0, found.about["/Size"]]
        i = 0
        for first, count in zip(index[::2], index[1::2]):
            for number in range(first, first + count):
                fields = []
                for w in widths:
                    fields.append(int.from_bytes(data[i : i + w], "big"))
                    i += w
                kind = fields[0] if widths[0] else 1
                if kind:
                    self.places.setdefault(number, fields[1] if kind == 1 else (fields[1], fields[2]))
        return found.about

    def decoded(self, stream: Stream) -> bytes:
        """The data of a table's or an object stream; those of pages are never decoded."""
        filters, params = self.get(stream.about.get("/Filter", [])), self.get(stream.about.get("/DecodeParms", {}))
        if filters in ([], None):
            return stream.data
        if (filters[0] if isinstance(filters, list) else filters) != "/FlateDecode":
            raise ValueError("a filter that is not known")
        data = zlib.decompressobj().decompress(stream.data)
        params = params[0] if isinstance(params, list) else params
        if not params or int(params.get("/Predictor", 1)) < 10:
            return data
        width = int(params.get("/Columns", 1)) * int(params.get("/Colors", 1)) * int(params.get("/BitsPerComponent", 8)) // 8
        out, before = bytearray(), bytearray(width)
        for k in range(0, len(data), width + 1):
            row = bytearray(data[k + 1 : k + 1 + width])
            if data[k] == 2:
                row = bytearray((a + b) & 255 for a, b in zip(row, before))
            elif data[k]:
                raise ValueError("a predictor that is not known")
            out += row
            before = row
        return bytes(out)

    def packed(self, stream: Stream) -> tuple[list[int], list[int], bytes]:
        data = self.decoded(stream)
        head = [int(x) for x in data[: int(self.get(stream.about["/First"]))].split()][: 2 * int(self.get(stream.about["/N"]))]
        return head[::2], [int(self.get(stream.about["/First"])) + x for x in head[1::2]], data

    def get(self, value):
        """The value that a reference stands for; a reference to nothing is null."""
        hops = 0
        while isinstance(value, Ref) and hops < 32:
            hops += 1
            number = value.number
            if number not in self.known:
                place = self.places.get(number)
                self.known[number] = None
                if isinstance(place, tuple):
                    numbers, starts, data = self.packed(self.get(Ref(place[0])))
                    own, self.data = self.data, data
                    try:
                        self.known[number] = self.value(starts[numbers.index(number)])[0]
                    finally:
                        self.data = own
                elif place is not None:
                    self.known[number] = self.object_at(place)
            value = self.known[number]
        return value

    def object_at(self, at: int):
        m = _OBJECT.match(self.data, _SPACE.match(self.data, at).end())
        if not m:
            raise ValueError("no object where the table says one is")
        value, end = self.value(m.end())
        end = _SPACE.match(self.data, end).end()
        if not isinstance(value, dict) or not self.data.startswith(b"stream", end):
            return value
        start = end + 6 + (2 if self.data.startswith(b"\r\n", end + 6) else 1)
        size = self.get(value.get("/Length"))
        if not isinstance(size, int) or not re.match(rb"\s*endstream", self.data[start + size : start + size + 20]):
            stop = self.data.find(b"endstream", start)
            size = (stop if stop >= 0 else len(self.data)) - start
        return Stream(value, self.data[start : start + size])

    def value(self, at: int) -> tuple[object, int]:
        """(value, end); nested values are kept on a list of open ones, so that deep ones need no recursion."""
        data, open_ = self.data, []
        while True:
            at = _SPACE.match(data, at).end()
            done = None
            if data.startswith(b"<<", at) or data.startswith(b"[", at):
                open_.append((data[at : at + 1], []))
                at += 2 if data.startswith(b"<<", at) else 1
                continue
            if data.startswith(b">>", at) or data.startswith(b"]", at):
                at += 2 if data.startswith(b">>", at) else 1
                kind, items = open_.pop() if open_ else (b"[", [])
                done = items if kind == b"[" else {k: v for k, v in zip(items[::2], items[1::2]) if isinstance(k, str)}
            elif data.startswith(b"(", at):
                depth, end = 0, at
                for m in _PARENTHESIS.finditer(data, at):
                    depth += {b"(": 1, b")": -1}.get(m[0], 0)
                    end = m.end()
                    if not depth:
                        break
                done, at = data[at:end], end
            elif data.startswith(b"<", at):
                end = data.find(b">", at) + 1 or len(data)
                done, at = data[at:end], end
            elif m := _REF.match(data, at):
                done, at = Ref(int(m[1])), m.end()
            elif m := _ATOM.match(data, at):
                atom, at = m[0], m.end()
                if atom.startswith(b"/"):
                    done = atom.decode("latin-1")
                elif re.fullmatch(rb"[+-]?\d+", atom):
                    done = int(atom)
                elif re.fullmatch(rb"[+-]?(?:\d+\.\d*|\.\d+)", atom):
                    done = float(atom)
                else:
                    done = atom if atom != b"null" else None
            else:
                raise ValueError("a value is missing")
            if not open_:
                return done, at
            open_[-1][1].append(done)

    def pages(self) -> Iterator[dict]:
        """The page dicts in order, with what they inherit and without their parent. A node that was met before is passed over."""
        open_, seen = [(self.get(self.trailer["/Root"])["/Pages"], {})], set()
        while open_:
            ref, inherited = open_.pop()
            node = self.get(ref)
            if not isinstance(node, dict) or (isinstance(ref, Ref) and ref in seen):
                continue
            seen.add(ref if isinstance(ref, Ref) else None)
            own = inherited | {k: node[k] for k in INHERITED if k in node}
            kids = self.get(node.get("/Kids"))
            if isinstance(kids, list):
                open_ += [(k, own) for k in reversed(kids)]
            else:
                yield own | {k: v for k, v in node.items() if k != "/Parent"}

    def box(self, page: dict) -> tuple[float, float]:
        """Width and height of what is shown, turned as the page is."""
        found = self.get(page.get("/CropBox")) or self.get(page.get("/MediaBox")) or LETTER
        x0, y0, x1, y1 = (float(self.get(x)) for x in found)
        size = abs(x1 - x0), abs(y1 - y0)
        return size[::-1] if int(self.get(page.get("/Rotate")) or 0) % 180 else size

    def single(self, page: dict) -> bytes:
        """A file with one page and the objects that it refers to, other pages left out."""
        numbers, order, out, places = {}, [], bytearray(b"%PDF-1.7\n%\xe2\xe3\xcf\xd3\n"), []

        def written(value) -> bytes:
            if isinstance(value, dict):
                return b"<<" + b" ".join(k.encode("latin-1") + b" " + written(v) for k, v in value.items()) + b">>"
            if isinstance(value, list):
                return b"[" + b" ".join(map(written, value)) + b"]"
            if isinstance(value, Ref):
                if isinstance(found := self.get(value), dict) and found.get("/Type") in ("/Page", "/Pages", "/Catalog"):
                    return b"null"
                if value not in numbers:
                    numbers[value] = len(numbers) + 4
                    order.append(value)
                return b"%d 0 R" % numbers[value]
            if value is None:
                return b"null"
            return value if isinstance(value, bytes) else str(value).encode("latin-1")

        def add(number: int, body: bytes) -> None:
            places.append((number, len(out)))
            out.extend(b"%d 0 obj\n" % number + body + b"\nendobj\n")

        add(1, b"<</Type /Catalog /Pages 2 0 R>>")
        add(2, b"<</Type /Pages /Kids [3 0 R] /Count 1>>")
        add(3, written({"/Type": "/Page", **page, "/Parent": b"2 0 R"}))
        for ref in order:  # grows while objects are written
            value = self.get(ref)
            if isinstance(value, Stream):
                add(numbers[ref], written(value.about | {"/Length": len(value.data)}) + b"\nstream\n" + value.data + b"\nendstream")
            else:
                add(numbers[ref], written(value))
        table = len(out)
        out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(places) + 1) + b"".join(b"%010d 00000 n \n" % at for _, at in sorted(places))
        return bytes(out + b"trailer\n<</Size %d /Root 1 0 R>>\nstartxref\n%d\n%%%%EOF\n" % (len(places) + 1, table))


@F.udtf(returnType=PAGE_ROW)
class PdfPages:
    def eval(self, content: bytes, with_files: bool):
        try:
            pdf = Pdf(bytes(content or b""))
            found = list(pdf.pages())
            if not found:
                raise ValueError("no pages")
            for i, page in enumerate(found):
                width, height = pdf.box(page)
                yield i, len(found), width, height, pdf.single(page) if with_files else None, None
        except Exception as e:  # noqa: BLE001 - a file that cannot be read is a row with an error
            yield None, 0, None, None, None, str(e) or type(e).__name__


def pages_of(files: DataFrame, with_files: bool = True) -> DataFrame:
    """files with a row for each page in place of the content: page_index (from 0), pages, width and height in points, page (a file of its own) and error. A
    file that cannot be read (empty, encrypted, without pages) has one row with an error."""
    found = files.lateralJoin(PdfPages(F.col("content").outer(), F.lit(with_files)))
    return found.drop("content")


def in_pixels(points: Column, dpi: int = DPI) -> Column:
    return F.ceil(F.round(points * dpi / POINTS, 6)).cast("int")


def page_info(files: DataFrame, dpi: int = DPI) -> DataFrame:
    """files with width_px, height_px, pdf_size_bytes and dpi of the first page at a resolution."""
    sized = files.withColumn("pdf_size_bytes", F.length("content"))
    first = pages_of(sized, False).filter("page_index = 0")
    kept = [c for c in files.columns if c != "content"]
    return first.select(*kept, in_pixels(F.col("width"), dpi).alias("width_px"), in_pixels(F.col("height"), dpi).alias("height_px"), "pdf_size_bytes", F.lit(dpi).alias("dpi"))


def starts(counts: DataFrame, first: int = 0) -> DataFrame:
    """counts (file, pages) with start: the number of each file's first page, counted on over all files in the order of their names. Ranges of files are added
    up apart, so that no task sees all files."""
    if first < 0:
        raise ValueError("pages count from 0 at least")
    dealt = computed(counts.repartitionByRange("file").withColumn("_part", F.spark_partition_id()))
    before, total = [F.lit(-1), F.lit(0).cast("long")], first
    for r in dealt.groupBy("_part").agg(F.sum("pages").alias("n")).orderBy("_part").collect():
        before += [F.lit(r._part), F.lit(total).cast("long")]
        total += r.n
    upto = Window.partitionBy("_part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    start = F.element_at(F.create_map(*before), F.col("_part")) + F.coalesce(F.sum("pages").over(upto), F.lit(0))
    return dealt.withColumn("start", start.cast("long")).drop("_part")


def split_files(files: DataFrame, first: int = 0) -> DataFrame:
    """(path, content, width, height, error) of files (file, content): stem/split_pdf/NNN.pdf, numbered on over all files by name; a file with an error takes no numbers."""
    numbered = starts(pages_of(files, False).groupBy("file").agg(F.max("pages").cast("long").alias("pages")), first)
    each = pages_of(files).join(numbered.select("file", "start"), "file")
    stem = F.regexp_replace("file", r"\.[^.]*\z", "")
    path = F.concat(stem, F.lit("/split_pdf/"), F.format_string("%03d", F.col("start") + F.col("page_index")), F.lit(".pdf"))
    return each.select("file", F.when(F.col("error").isNull(), path).alias("path"), F.col("page").alias("content"), "width", "height", "error")
