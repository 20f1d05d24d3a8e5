"""Detections against plain loops: suppression, crops, states and resume."""

import json
import random

import pytest

from quire.operators import detections as D

COLUMNS = "book_name string, page_stem string, det_idx int, class_id int, class_name string, confidence double, bbox array<int>"
NAMES = {0: "table", 1: "figure", 2: "formula"}


def made_up(seed):
    rng, rows = random.Random(seed), []
    for page in range(15):
        for i in range(rng.randint(0, 25)):
            x, y, c = rng.randint(-10, 60), rng.randint(-10, 60), rng.randint(0, 2)
            rows.append((f"B{page % 2}", f"{page:03d}", i, c, NAMES[c], rng.choice([0.1, 0.25, 0.5, 0.5, rng.random()]), [x, y, x + rng.randint(0, 40), y + rng.randint(0, 40)]))
    return rows


def area(b):
    return max(0, b[2] - b[0]) * max(0, b[3] - b[1])


def iou(a, b):
    shared = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
    both = area(a) + area(b) - shared
    return shared / both if both else 0.0


def plain(rows, least, most, across):
    out = []
    for r in sorted((r for r in rows if r[5] >= least), key=lambda r: (r[0], r[1], -r[5], r[2])):
        if not any(k[:2] == r[:2] and (across or k[3] == r[3]) and iou(k[6], r[6]) > most for k in out):
            out.append(r)
    return out


@pytest.mark.parametrize(("seed", "least", "most", "across"), [(0, 0.25, 0.7, False), (1, 0.25, 0.3, False), (2, 0.0, 0.2, True), (3, 0.5, 0.0, False)])
def test_suppression(spark, seed, least, most, across):
    rows = made_up(seed)
    found = D.suppressed(spark.createDataFrame(rows, COLUMNS), least, most, across).collect()
    assert sorted(map(tuple, found)) == sorted(plain(rows, least, most, across))


def test_crops(spark):
    rows = plain(made_up(4), 0.25, 0.7, False)
    sizes = {(b, p): (50 + int(p), 40) for b, p, *_ in rows}
    df = spark.createDataFrame([(*k, *v) for k, v in sizes.items()], "book_name string, page_stem string, width int, height int")
    want, seen = [], {}
    for b, p, i, c, name, conf, box in sorted(rows, key=lambda r: (r[0], r[1], -r[5], r[2])):
        n = seen[b, p] = seen.get((b, p), 0) + 1
        w, h = sizes[b, p]
        crop = (max(0, box[0] - 5), max(0, box[1] - 5), min(w, box[2] + 5), min(h, box[3] + 5))
        if crop[2] > crop[0] and crop[3] > crop[1]:
            want.append((b, "tables" if name == "table" else "figures", f"{p}_{n}.jpg", crop))
    got = [(r.book_name, r.folder, r.name, tuple(r.crop)) for r in D.crops(spark.createDataFrame(rows, COLUMNS), df).collect()]
    assert sorted(got) == sorted(want)


def test_states_and_resume(spark):
    rows = plain(made_up(5), 0.25, 0.7, False)
    pages = [(f"B{k % 2}", f"{k:03d}", f"{k:03d}.jpg", 30, 20) for k in range(15)]
    seen = spark.createDataFrame(pages[:9], "book_name string, page_stem string, page_file string, width int, height int")
    states = D.page_states(seen, spark.createDataFrame(rows, COLUMNS))
    read = {(r.book_name, r.page_stem): json.loads(r.value) for r in states.collect()}
    assert len(read) == 9 and all(v["image_shape"] == [20, 30] for v in read.values())
    for (b, p), v in read.items():
        own = sorted((r for r in rows if r[:2] == (b, p)), key=lambda r: (-r[5], r[2]))
        assert v["detections"] == [{"class_id": r[3], "class_name": r[4], "confidence": round(r[5], 4), "bbox_xyxy": r[6]} for r in own]
    again = D.from_states(states).collect()
    assert len(again) == sum(len(v["detections"]) for v in read.values())
    images = spark.createDataFrame(pages, seen.schema)
    assert sorted(r.page_stem for r in D.unseen(images, states).collect()) == [p for _, p, *_ in pages[9:]]
    assert D.page_states(seen.limit(0), spark.createDataFrame(rows, COLUMNS)).count() == 0
