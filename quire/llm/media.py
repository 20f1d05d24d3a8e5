"""Netpbm and BMP images as columns: decoded to numpy arrays, area-resized by integral images, cut into NPY tiles, hashed.

An integral image holds the sums over all rectangles from the corner; a target pixel is the mean of the source over its box,
whose fractional borders are read from the integral image by linear interpolation.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from quire.llm.common import with_texts

BLOCK = 576
WIDTH = 24
TILE = 24
PIXELS_AT_ONCE = 1 << 18  # of a strip of an image that is resized
FORMATS = ("pgm", "ppm", "bmp")
_FIELD = re.compile(rb"(?:\s|#[^\n]*\n)*([0-9]+)")


def encode(pixels: np.ndarray, kind: str) -> bytes:
    """An array of bytes, height x width (x 3), as binary PGM, PPM, or BMP (8 bits with a gray palette, or 24 bits)."""
    height, width = pixels.shape[:2]
    if kind in ("pgm", "ppm"):
        return b"%s\n%d %d\n255\n" % (b"P5" if kind == "pgm" else b"P6", width, height) + pixels.tobytes()
    gray = pixels.ndim == 2
    rows = pixels if gray else pixels[:, :, ::-1]
    rows = rows.reshape(height, -1)[::-1]
    rows = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 4)))
    palette = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 4, axis=1)
    palette[:, 3] = 0
    colours = palette.tobytes() if gray else b""
    start = 54 + len(colours)
    head = struct.pack("<2sIHHI", b"BM", start + rows.size, 0, 0, start)
    return head + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8 if gray else 24, 0, rows.size, 2835, 2835, 256 if gray else 0, 0) + colours + rows.tobytes()


def decode(media: bytes) -> np.ndarray:
    """The samples of a Netpbm (P1 to P6) or uncompressed BMP image (1, 4, 8, 24 or 32 bits) as height x width (x 3).

    Samples of over 8 bits come as uint16. Raises ValueError for anything else, and for a file that ends early.
    """
    if media[:2] == b"BM":
        return _bmp(media)
    if media[:1] == b"P" and media[1:2] in b"123456" and len(media) > 2:
        return _netpbm(media)
    raise ValueError("neither Netpbm nor BMP")


def _netpbm(media: bytes) -> np.ndarray:
    kind, at, numbers = int(media[1:2]), 2, []
    for _ in range(2 if kind in (1, 4) else 3):
        found = _FIELD.match(media, at)
        if not found:
            raise ValueError("a broken Netpbm header")
        numbers.append(int(found[1]))
        at = found.end()
    (width, height), top = numbers[:2], numbers[2] if len(numbers) > 2 else 1
    if not width or not height or not 0 < top < 65536:
        raise ValueError("a broken Netpbm header")
    planes = 3 if kind in (3, 6) else 1
    n = width * height * planes
    dtype = np.uint8 if top < 256 else np.dtype(">u2")
    if kind in (1, 2, 3):
        body = re.sub(rb"#[^\n]*", b"", media[at:])
        values = re.findall(rb"[01]", body) if kind == 1 else body.split()
        if len(values) < n:
            raise ValueError("the image ends early")
        samples = np.array(values[:n], dtype=np.int64).astype(np.uint8 if top < 256 else np.uint16)
    elif kind == 4:
        stride = -(-width // 8)
        if len(media) < at + 1 + stride * height:
            raise ValueError("the image ends early")
        samples = np.unpackbits(np.frombuffer(media, np.uint8, stride * height, at + 1).reshape(height, stride), axis=1)[:, :width]
    else:
        if len(media) < at + 1 + n * np.dtype(dtype).itemsize:
            raise ValueError("the image ends early")
        samples = np.frombuffer(media, dtype, n, at + 1)
        samples = samples if top < 256 else samples.astype(np.uint16)
    if kind in (1, 4):
        samples = ((1 - samples) * 255).astype(np.uint8)  # 1 is black
    return samples.reshape((height, width, 3) if planes == 3 else (height, width))


def _bmp(media: bytes) -> np.ndarray:
    if len(media) < 54:
        raise ValueError("the image ends early")
    start, size, width, height, _, bits, packed = struct.unpack("<IIiiHHI", media[10:34])
    if packed or bits not in (1, 4, 8, 24, 32) or width <= 0 or not height:
        raise ValueError("a kind of BMP that is not supported")
    rows, stride = abs(height), (width * bits + 31) // 32 * 4
    if len(media) < start + rows * stride:
        raise ValueError("the image ends early")
    grid = np.frombuffer(media, np.uint8, rows * stride, start).reshape(rows, stride)
    if height > 0:
        grid = grid[::-1]
    if bits >= 24:
        return grid[:, : width * bits // 8].reshape(rows, width, bits // 8)[:, :, 2::-1]
    if bits < 8:
        grid = np.unpackbits(grid, axis=1).reshape(rows, -1, bits)
        grid = np.packbits(np.pad(grid, ((0, 0), (0, 0), (8 - bits, 0))), axis=2)[:, :, 0]
    at = 14 + size
    palette = np.frombuffer(media[at : min(start, at + 4 * (1 << bits))], np.uint8)
    palette = palette[: len(palette) // 4 * 4].reshape(-1, 4)[:, 2::-1]
    index = grid[:, :width]
    if index.size and int(index.max()) >= len(palette):
        raise ValueError("a colour outside the palette")
    gray = bool((palette == palette[:, :1]).all())
    return palette[:, 0][index] if gray else palette[index]


def grayscale(pixels: np.ndarray) -> np.ndarray:
    return pixels.astype(np.float64) if pixels.ndim == 2 else pixels.astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def resized(pixels: np.ndarray, sizes: list[tuple[int, int]]) -> list[np.ndarray]:
    """Gray means of an image over the boxes of grids of these heights and widths. One pass over strips of rows adds up integral images of each strip, so that a
    long image needs no more memory than its strips."""
    rows, columns = pixels.shape[:2]
    out = [np.zeros((h, columns)) for h, _ in sizes]
    step = max(1, PIXELS_AT_ONCE // max(columns, 1))
    for top in range(0, rows, step):
        gray = grayscale(pixels[top : top + step])
        total = np.zeros((len(gray) + 1, columns))
        np.cumsum(gray, axis=0, out=total[1:])
        for sums, (h, _) in zip(out, sizes):
            sums += box_sums(total, np.clip(np.arange(h + 1) * (rows / h) - top, 0, len(gray)))
    made = []
    for sums, (h, w) in zip(out, sizes):
        total = np.zeros((columns + 1, h))
        np.cumsum(sums.T, axis=0, out=total[1:])
        made.append(box_sums(total, np.arange(w + 1) * (columns / w)).T / (rows / h) / (columns / w))
    return made


def box_sums(total: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums between edges along the first axis of an integral image; an edge inside a pixel takes its share."""
    low = np.minimum(edges.astype(np.intp), len(total) - 2)
    part = (edges - low)[:, None]
    return np.diff(total[low] * (1 - part) + total[low + 1] * part, axis=0)


def area_resize(gray: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means of the source over the boxes of a height x width grid."""
    return resized(gray, [(height, width)])[0]


def hash_of(small: np.ndarray) -> str:
    """64 bits in hex: whether each of 8 x 8 cells is darker than its right neighbour, after rounding away float noise."""
    small = np.round(small, 6)
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


def difference_hash(pixels: np.ndarray) -> str:
    return hash_of(area_resize(pixels, 8, 9))


def npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(array), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def tiles(pixels: np.ndarray, size: int = TILE) -> Iterator[tuple[int, int, bytes, str]]:
    """(row, column, NPY bytes, difference hash) of the size x size tiles; those at the right and lower borders are smaller."""
    for r, top in enumerate(range(0, pixels.shape[0], size)):
        for c, left in enumerate(range(0, pixels.shape[1], size)):
            tile = pixels[top : top + size, left : left + size]
            yield r, c, npy(tile), difference_hash(tile)


def media_tiles(df: DataFrame, media: str = "media", size: int = TILE, resize: tuple[int, int] | None = None) -> DataFrame:
    """df's columns but the image, with height, width, error and tiles: structs of row, col, npy (binary) and dhash.

    resize: height and width to which the (gray) image is area-resized before it is cut. A null or broken image has no tiles
    and an error text; repeated rows stay.
    """

    def start():
        def one(blob: bytes | None):
            try:
                pixels = decode(bytes(blob or b""))
            except ValueError as e:
                return None, None, str(e), []
            shape = pixels.shape
            if resize:
                pixels = np.clip(np.round(area_resize(pixels, *resize)), 0, 65535).astype(pixels.dtype)
            return shape[0], shape[1], None, [dict(zip(("row", "col", "npy", "dhash"), t)) for t in tiles(pixels, size)]

        return lambda blobs: [list(x) for x in zip(*map(one, blobs))] or [[], [], [], []]

    return with_texts(df, media, "height int, width int, error string, tiles array<struct<row: int, col: int, npy: binary, dhash: string>>", start)


def as_media(payload: bytes) -> bytes:
    """Bytes (a multiple of 576) as an image 24 pixels wide; the payload's checksum decides the format."""
    kind = FORMATS[zlib.crc32(payload) % len(FORMATS)]
    samples = np.frombuffer(payload, np.uint8)
    return encode(samples.reshape(-1, WIDTH, 3) if kind == "ppm" else samples.reshape(-1, WIDTH), kind)


def text_media(df: DataFrame, text: str = "text") -> DataFrame:
    """df's columns but the text, with the text stored as an image, read back, and described.

    The UTF-8 bytes (null: none) are padded by 255 to a positive multiple of 576. media is the stored image; the other fields
    come from the bytes read back: n_bytes (before padding), payload_bytes, payload_sha256, tail_crc32 (of the last 32 bytes), media_bytes, media_sha256,
    feature (the difference hash) and tile (the 24 x 24 area-resized image as NPY). Equal texts give equal fields.
    """

    def start():
        def one(value: str | None):
            raw = (value or "").encode()
            media = as_media(raw + b"\xff" * (-len(raw) % BLOCK if raw else BLOCK))
            pixels = decode(media)
            back = pixels.tobytes()
            cells, small = resized(pixels, [(8, 9), (TILE, TILE)])
            sha = lambda b: hashlib.sha256(b).hexdigest()
            return len(raw), len(back), sha(back), zlib.crc32(back[-32:]), len(media), sha(media), hash_of(cells), npy(np.round(np.round(small, 6)).astype(np.uint8)), media

        return lambda values: [list(x) for x in zip(*map(one, values))] or [[] for _ in range(9)]

    fields = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary, media binary"
    return with_texts(df, text, fields, start)
