"""Quality classification: held-out accuracy, the solver against a plain version, odd rows."""

import os
import random
import zlib

import numpy as np
import pytest

from quire.llm import quality
from quire.llm import queries as Q

SF = "/root/testdata/sf0.1"


def test_on_the_held_out_fold(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality is not null").collect()}
    rows = Q.op13_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    bad = [r for r in held if not label[r.doc_id]]
    assert len(bad) > 50 and sum(not r.predicted for r in bad) >= 0.95 * len(bad)
    assert sum(not r.predicted for r in held if label[r.doc_id]) <= 0.01 * len(held)


def test_held_out_labels_are_not_learnt_from(spark):
    docs = spark.createDataFrame([(i, f"text {i} {'good' if i % 2 else 'bad ### '}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality")
    one, two = quality.fit(docs, labels), quality.fit(docs, turned)
    assert np.array_equal(one.weights, two.weights) and (one.bias, one.slope, one.offset) == (two.bias, two.slope, two.offset)


def test_ratios_by_hand():
    found = [np.array([1, 2]), np.array([2]), np.array([2, 3])]
    ratios = quality.log_count_ratios(found, np.array([1, 0, 1]))
    size = 1 << quality.BITS
    p, q = size + 4.0, size + 1.0
    assert np.allclose(ratios[[1, 2, 3, 9]], [np.log((2 / p) / (1 / q)), np.log((3 / p) / (2 / q)), np.log((2 / p) / (1 / q)), 0])


def test_descent_reaches_the_least_loss(monkeypatch):
    """The primal value at the solution is no worse than that of long subgradient descent."""
    monkeypatch.setattr(quality, "EPOCHS", 2000)
    rng = np.random.default_rng(6)
    found = [np.sort(rng.choice(30, 8, replace=False)) for _ in range(120)]
    y = np.array([int(f.sum() + rng.normal() * 30 > 116) for f in found])
    ratios = rng.normal(size=1 << quality.BITS).astype(np.float32)
    w, b = quality.hinge(found, y, ratios)
    rows = np.zeros((120, 31))
    for i, f in enumerate(found):
        rows[i, f] = ratios[f] / np.linalg.norm(ratios[f])
    rows[:, 30] = 1
    sign = np.where(y > 0, 1, -1)
    cost = quality.PENALTY * 120 / 2 / np.where(y > 0, (y > 0).sum(), (y == 0).sum())
    loss = lambda v: v @ v / 2 + (cost * np.maximum(0, 1 - sign * (rows @ v))).sum()
    plain, best = np.zeros(31), np.inf
    for t in range(1, 20_000):
        plain -= (plain - rows.T @ (cost * sign * (sign * (rows @ plain) < 1))) / t
        best = min(best, loss(plain))
    assert loss(np.append(w[:30], b)) <= best * 1.001


def test_parts_of_a_long_text(monkeypatch):
    kind, text = quality.kinds(), "".join(random.Random(1).choices("abC 1|#é\n", k=3000))
    whole = quality.features(text, kind)
    monkeypatch.setattr(quality, "CHARS_AT_ONCE", 41)
    assert np.array_equal(quality.features(text, kind), whole)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "12 !!"), (5, "word " * 50_000), (5, "word " * 50_000), (None, "text")], "doc_id long, text string")
    extra = docs.selectExpr("*", "'a' as score", "'b' as note")
    labels = spark.createDataFrame([(i, q) for i in (None, 1, 2, 3, 4, 5) for q in (0, 1, None)], "doc_id long, quality int")
    for given in (labels, labels.filter("quality = 1"), labels.limit(0)):
        rows = quality.quality_scores(extra, quality.fit(docs, given)).collect()
        assert len(rows) == 7 and all(0 <= r.score <= 1 and r.note == "b" and r.predicted == int(r.score >= 0.3) for r in rows)
        assert rows[0].score == rows[1].score == rows[2].score and rows[4].score == rows[5].score
    assert quality.quality_scores(docs.limit(0), quality.Model()).count() == 0
