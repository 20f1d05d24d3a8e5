import random

import pytest

from quire.llm import hamming_search
from quire.llm.hamming_search import cuts, sign_code, top_k


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute(rows, queries, k):
    out = []
    for q, code in queries:
        if q is None or code is None:
            continue
        near = sorted({((c ^ code) & (2**64 - 1)).bit_count().__index__() * 10**12 + i for i, c in rows if i is not None and c is not None and i != q})[:k]
        out += [(q, n + 1, x % 10**12, x // 10**12) for n, x in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("n,flips", [(300, 3), (5, 64), (900, 30)])
def test_equals_brute_force(spark, n, flips):
    rng = random.Random(n)
    centres = [rng.getrandbits(64) for _ in range(5)]
    rows = []
    for i in range(n):
        code = rng.choice(centres)
        for _ in range(rng.randint(0, flips)):
            code ^= 1 << rng.randrange(64)
        rows.append((i, signed(code)))
    rows += [(n + j, rows[0][1]) for j in range(15)] + [(None, 5), (n + 99, None), rows[1]]
    queries = rows[::7] + rows[-3:]
    df = spark.createDataFrame(rows, "id long, code long")
    got = sorted(map(tuple, top_k(df, spark.createDataFrame(queries, "id long, code long"), k=4).collect()))
    assert got == brute(rows, queries, 4)


def test_empty_and_sign(spark):
    none = spark.createDataFrame([], "id long, code long")
    assert top_k(none, none).count() == 0
    v = [1.0, -1.0, 0.0] + [2.0] * 61
    row = spark.createDataFrame([(v,), (None,), ([1.0],)], "v array<double>").select(sign_code("v").alias("c")).collect()
    assert [r.c for r in row] == [signed(((1 << 64) - 1) & ~0b110), None, 1]


def test_segments_cover_the_code():
    for codes in (0, 1, 100, 2000, 50_000, 10**7, 10**10):
        segments = cuts(codes)
        assert [a for a, _ in segments[1:]] == [a + w for a, w in segments[:-1]] and segments[0][0] == 0 and sum(segments[-1]) == 64
        assert all(1 << w <= max(16, 2 * codes) for _, w in segments)


@pytest.mark.parametrize("segments", [[(0, 20), (20, 22), (42, 22)], [(8 * j, 8) for j in range(8)], [(0, 5)] + [(5 + 4 * j, 4) for j in range(14)] + [(61, 3)]])
def test_any_segments(spark, monkeypatch, segments):
    """Segments with masks from two lists, and narrow ones whose every value is probed for queries far from all codes."""
    monkeypatch.setattr(hamming_search, "cuts", lambda codes: segments)
    rng = random.Random(len(segments))
    flips = 5 if segments[0][1] > 16 else 40
    rows = []
    for i in range(120):
        code = 0x0F0F
        for _ in range(rng.randint(0, flips)):
            code ^= 1 << rng.randrange(64)
        rows.append((i, signed(code)))
    queries = rows[::5]
    if flips > 5:
        queries.append((500, signed(~rows[0][1] & (2**64 - 1))))
    got = sorted(map(tuple, top_k(spark.createDataFrame(rows, "id long, code long"), spark.createDataFrame(queries, "id long, code long"), k=3).collect()))
    assert got == brute(rows, queries, 3)


def test_string_ids_and_a_hot_segment(spark):
    """A third of the codes agree in every segment but one."""
    rng = random.Random(3)
    rows = [(str(i), rng.getrandbits(10) if i % 3 == 0 else signed(rng.getrandbits(64))) for i in range(600)]
    df = spark.createDataFrame(rows, "id string, code long")
    got = {(r.query_id, r["rank"]): (r.distance, r.id) for r in top_k(df, df.filter("cast(id as int) % 20 = 0"), k=2).collect()}
    for q, code in rows[::20]:
        near = sorted((((c ^ code) & (2**64 - 1)).bit_count(), i) for i, c in rows if i != q)[:2]
        assert [got[q, 1], got[q, 2]] == near
