"""Embedding whitening: equal to a dense eigen-decomposition, exact whole numbers, odd rows."""

import math
import os
from fractions import Fraction

import numpy as np
import pytest

from quire.llm import queries as Q
from quire.llm import whitening

SF = "/root/testdata/sf0.01"


def by_hand(vectors, k):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n = len(x)
    y = n * x - x.sum(axis=0)
    values, directions = np.linalg.eigh(np.cov((y / n).T, bias=True).reshape(x.shape[1], -1))
    values, directions = values[::-1], directions[:, ::-1]
    return [int(v) for v in (y.astype(object) ** 2).sum(axis=1)], values, y / n @ directions[:, :k] / np.sqrt(values[:k])


def test_query_equals_a_dense_decomposition(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    kept = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect() if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    deviations, values, expected = by_hand([v for _, v in kept], 8)
    rows = sorted(Q.op11_whitening(spark, SF).collect(), key=lambda r: (r.vec_id, r.component))
    assert [r.vec_id for r in rows[::8]] == [i for i, _ in kept] and [r.component for r in rows[:8]] == list(range(1, 9))
    found = np.array([r.whitened for r in rows]).reshape(-1, 8)
    assert np.abs(found * np.sign((found * expected).sum(axis=0)) - expected).max() < 1e-9
    assert [r.deviation for r in rows[::8]] == deviations and {r.n for r in rows} == {len(kept)}
    assert np.allclose([r.explained for r in rows[:8]], values[:8] / values.sum(), rtol=1e-9)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9


@pytest.mark.parametrize("spectrum", [np.arange(40, 0, -1.0) ** 2, np.ones(40), np.r_[np.ones(20) * 5, np.ones(20)], np.r_[3.0, 2.0, np.zeros(38)]])
def test_iteration_finds_what_a_dense_decomposition_finds(spectrum):
    turn = np.linalg.qr(np.random.default_rng(1).standard_normal((40, 40)))[0]
    v = turn * spectrum @ turn.T
    values, vectors, residuals, _ = whitening.iterate(lambda q: v @ q, 40, 4)
    assert np.allclose(values, spectrum[:4], atol=1e-12 * spectrum[0]) and residuals.max() <= 1e-10
    assert np.allclose(v @ vectors, vectors * values, atol=1e-9 * spectrum[0]) and np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-12)


def test_a_narrow_block_converges_by_passes():
    """With gaps between the eigenvalues the block stays far narrower than the space."""
    d, widths = 600, []
    spectrum = 0.8 ** np.arange(d)

    def product(q):
        widths.append(q.shape[1])
        return spectrum[:, None] * q

    values, _, residuals, passes = whitening.iterate(product, d, 4)
    assert np.allclose(values, spectrum[:4]) and residuals.max() <= 1e-10 and max(widths) <= 64 and passes == len(widths)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    fine = rng.standard_normal((50, 3)).round(3)
    odd = [None, [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [0.0, float("inf"), 0.0], [], [1.0, 2.0]]
    rows = [(i, [float(c) for c in v], "x", 1) for i, v in enumerate(fine)] + [(0, [float(c) for c in fine[0]], None, 1), (None, [float(c) for c in fine[1]], "y", 1)] + [(100 + i, v, "z", 1) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "id long, v array<double>, note string, whitened int")
    found = whitening.whitened(df, "v").collect()
    kept = [r for r in rows[:52]]
    deviations, values, expected = by_hand([r[1] for r in kept], 3)
    assert len(found) == 52 * 3 and {r.n for r in found} == {52} and {r.note for r in found} == {"x", "y", None}
    first = {(r.id, r.note): r for r in found if r.component == 1}
    sign = np.sign(first[(5, "x")].whitened * expected[5, 0])
    for (i, _, note, _), d, w in zip(kept, deviations, expected):
        assert first[(i, note)].whitened == pytest.approx(sign * w[0], abs=1e-9) and int(first[(i, note)].deviation) == d
    assert whitening.whitened(df.limit(0), "v").count() == 0 and whitening.whitened(df.filter("id = 3"), "v").count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "id long, v array<float>")
    assert whitening.whitened(same, "v").count() == 0  # no variance, no component
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "id long, v array<float>")
    assert {r.component for r in whitening.whitened(line, "v").collect()} == {1}


def test_whole_numbers_stay_exact():
    x = np.array([[1 << 40, -(1 << 41)], [3, 5], [1 << 61, 7]], np.int64)
    sums = [int(c) for c in x.astype(object).sum(axis=0)]
    y = whitening.spread_out(3, x, sums)
    assert [[int(v) for v in row] for row in y] == [[3 * int(v) - s for v, s in zip(row, sums)] for row in x]
    assert whitening.squares(y) == [sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    centred = whitening.centred(3, x, sums)
    assert centred[1, 1] == float(Fraction(int(y[1, 1]), 3))
