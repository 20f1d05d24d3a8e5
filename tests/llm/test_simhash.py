import random

import pytest

from quire.llm import simhash


def brute(rows, width=3, radius=3):
    """Components by comparing all pairs."""
    fps = [simhash.fingerprint(t or "", width) & (2**64 - 1) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                group[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted((str(d), f"{f:016x}", least.get(root(i))) for i, (d, f) in enumerate(zip((r[0] for r in rows), fps)))


def sample(n=120, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            text = (rng.choice(rows)[1] or "x").split()
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((i, " ".join(text)))
        else:
            rows.append((i, " ".join(rng.choices(words, k=rng.randint(20, 300)))))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (None, "one"), (905, "A b C"), (5, rows[5][1])]


@pytest.mark.parametrize("limit", [simhash.CELL_LIMIT, 3])
def test_links_equal_all_pairs(spark, limit, monkeypatch):
    rows = sample()
    monkeypatch.setattr(simhash.linked, "__defaults__", (3, limit))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_copies(df).collect())
    assert got == brute(rows)


def test_empty_table(spark):
    assert simhash.near_copies(spark.createDataFrame([], "doc_id long, text string, fp string")).count() == 0


def test_hash_is_xxh64_of_spark(spark):
    """One shingle: each bit of the fingerprint is that of its hash, which Spark's xxhash64 (seed 42) gives too."""
    expected = spark.sql("select xxhash64('a é c') as h").first().h
    assert simhash.fingerprint("A é C") == expected


def test_embedding_is_a_lower_bound(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**63, 500, dtype=np.uint64) for _ in range(2))
    counts = lambda x: np.array([[bin((int(v) >> (2 * s)) & 3).count("1") for s in range(32)] for v in x])
    manhattan = np.abs(counts(a) - counts(b)).sum(axis=1)
    assert (np.bitwise_count(simhash.embed(a) ^ simhash.embed(b)) == manhattan).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()
