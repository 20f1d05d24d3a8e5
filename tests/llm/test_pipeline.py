"""The pipeline's stages, each against a plain version on its own input."""

import os

import pytest

import corpus_pipeline as P
from quire.llm import simhash

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


def test_run_equals_its_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, sf)
        if k < len(P.STAGES) - 1:
            assert out.columns == P.COLUMNS and out.schema == docs.schema
            out.write.parquet(str(tmp_path / str(k)))
            docs = spark.read.parquet(str(tmp_path / str(k)))
            assert all(r == before[r.doc_id] for r in docs.collect())
    want = sorted((r.doc_id, r.n_pieces) for r in out.collect())
    got = P.run(spark, sf).collect()
    assert sorted((r.doc_id, r.n_pieces) for r in got) == want and all(r.exact for r in got)


def kept_by_brute_force(rows, width, similarity):
    sets = [frozenset(simhash.shingles(t or "", width)) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return sorted(least.values())


def test_one_of_each_group_stays(spark):
    import random

    rng = random.Random(2)
    words = [f"w{i}" for i in range(900)]
    rows = []
    for i in range(150):
        text = rng.choices(words, k=rng.randint(30, 200))
        if rows and rng.random() < 0.5:
            text = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, len(text) // 60)):
                text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(900, ""), (901, ""), (902, "two words"), (903, "Two  words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in simhash.representatives(df).collect())
    assert got == kept_by_brute_force(rows, 5, 0.8)
    odd = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, None), (1, "d e f"), (1, "d e f"), (None, "d e f")], "doc_id long, text string")
    assert sorted(str((r.doc_id, r.text)) for r in simhash.representatives(odd).collect()) == sorted(map(str, [(None, "a b c"), (None, None), (1, "d e f")]))
    assert simhash.representatives(df.limit(0)).count() == 0


def template_family(seed, n=60, shared=150, own=24, changed=12):
    """Texts of n documents that share a template, some with real copies."""
    import random

    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    template = rng.choices(words, k=shared)
    texts = []
    for i in range(n):
        text = template + rng.choices(words, k=own)
        texts.append(text)
        if i % 3 == 0:
            texts.append(text[:-changed] + rng.choices(words, k=changed))
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("limit", [simhash.GROUP_LIMIT, 4000])
def test_copies_within_a_template_family(spark, limit, monkeypatch):
    """Similarity to the others is from 0.65 to 0.8: a pivot that takes them all must not hide the real copies among them."""
    monkeypatch.setattr(simhash, "GROUP_LIMIT", limit)
    rows = template_family(4)
    want = kept_by_brute_force(rows, 5, 0.8)
    assert len(want) == 60
    got = simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in got.collect()) == want


def test_emitted_words_follow_the_targets(spark):
    """A hot source, whose target is 0.65 of its size or less, and sources that are repeated."""
    import random
    from collections import Counter

    from quire.llm import mixing

    rng = random.Random(6)
    rows = []
    for i in range(6000):
        source = "src1" if rng.random() < 0.22 else f"src{rng.randrange(6)}"
        n = rng.choice([0, 5, 40, 120, 200, 300])
        rows.append((i if i % 10 else None, " ".join(["w"] * (n - 1) + [f"w{i}"]) if n else "", "en", source, n))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").cache()
    target = {r.source: r.target for r in mixing.mixed(docs).select("source", "target").distinct().collect()}
    sizes, emitted = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    out = P.mix_sources(spark, docs, "").collect()
    for r in out:
        emitted[r.source] += len(r.text.split())
    assert target["src1"] < 0.7 * sizes["src1"] and set(map(tuple, out)) <= set(rows)
    assert all(abs(emitted[s] / target[s] - 1) < 0.1 for s in sizes), {s: (sizes[s], target[s], emitted[s]) for s in sizes}
    again = P.mix_sources(spark, docs.repartition(3), "").collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


def test_equal_fingerprints_are_checked_exactly(spark):
    """A shingle with over half of all occurrences decides the fingerprint alone."""
    rows = [(i, "ha " * 400 + " ".join(f"w{i}x{j}" for j in range(300))) for i in range(3)]
    rows.append((3, rows[2][1] + " end"))
    assert len({simhash.fingerprint(t, 5) for _, t in rows}) == 1
    got = simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in got.collect()) == kept_by_brute_force(rows, 5, 0.8) == [0, 1, 2]


def band_points(spark, count, cell):
    """Points of one cell, of which the first two have one sketch but for its first byte, and so lie far apart in the cell."""
    import numpy as np

    rng = np.random.default_rng(3)
    own = rng.integers(1, 255, (count, simhash.BANDS * simhash.BAND), dtype=np.uint8)
    own[1] = own[0]
    own[0, 0], own[1, 0] = 0, 255
    return spark.createDataFrame([(i, [cell, 100 + i], bytearray(own[i].tobytes())) for i in range(count)], "key long, bands array<long>, own binary")


@pytest.mark.parametrize("limit", [8192, 300, 1])
def test_cells_are_compared_whole(spark, limit):
    """A cell above the limit comes in blocks, any two of which meet."""
    points = band_points(spark, 1000 if limit > 1 else 20, 7)
    assert {tuple(sorted((r.a, r.b))) for r in simhash.banded(points, 0.65, limit).collect()} == {(0, 1)}


def test_a_template_of_thousands(spark):
    """Pairs of copies among documents that share most of their text: links as by brute force over all pairs."""
    import random

    rng = random.Random(4)
    words = [f"w{i}" for i in range(30_000)]
    template = rng.choices(words, k=150)
    texts = []
    for _ in range(700):
        text = template + rng.choices(words, k=24)
        near = list(text)
        for _ in range(rng.randint(1, 4)):
            near[rng.randrange(150, 174)] = rng.choice(words)
        texts += [text, near]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = sorted(r.doc_id for r in simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == kept_by_brute_force(rows, 5, 0.8)


def test_links_of_sets_against_all_pairs():
    import random

    import numpy as np

    for seed in range(30):
        rng = random.Random(seed)
        common = list(range(rng.randint(5, 40)))
        sets = []
        for _ in range(rng.randint(2, 60)):
            base = set(rng.choice(sets)) if sets and rng.random() < 0.6 else set(rng.sample(common, rng.randint(1, len(common))))
            sets.append(base - set(rng.sample(sorted(base), min(len(base) - 1, rng.randint(0, 3)))) | set(rng.sample(range(1000), rng.randint(0, 6))))
        pairs = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
        found = simhash.links_of_sets(list(range(len(sets))), [np.array(sorted(x), np.uint64) for x in sets], 0.8)

        def classes(edges, n=len(sets)):
            group = list(range(n))
            for a, b in edges:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
            return {tuple(i for i in range(n) if group[i] == g) for g in group}

        assert {tuple(sorted(e)) for e in found} <= pairs and classes(found) == classes(pairs)


def test_repeated_ids_and_clashing_names(spark):
    """Two texts under one id are two documents, and columns may have the names that the operator uses itself."""
    rows = [(1, "a b c d e f g", 1), (1, "h i j k l m n", 2), (1, "a b c d e f g", 3), (None, "h i j k l m n", 4), (None, "", 5), (2, None, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key long").selectExpr("*", "key as fp", "key as row", "key as _row", "key as _text", "key as bands", "null as own")
    out = simhash.representatives(df)
    assert out.columns == df.columns
    got = sorted(r.key for r in out.collect())
    assert len(got) == 3 and got[0] in (1, 3) and got[1:] == [2, 6] or got == [2, 3, 6]


def test_near_copies_without_ids(spark):
    import random

    rng = random.Random(8)
    text = [rng.choice("abcdefgh") + str(rng.randrange(999)) for _ in range(100)]
    near = " ".join(text[:-6] + ["x1", "x2", "x3", "x4", "x5", "x6"])
    texts = [" ".join(text), near]
    assert ((simhash.fingerprint(texts[0], 5) ^ simhash.fingerprint(near, 5)) & (2**64 - 1)).bit_count() > simhash.RADIUS
    df = spark.createDataFrame([(None, t) for t in texts] + [(1, "other words are in this one")], "doc_id long, text string")
    assert simhash.representatives(df).count() == 2
    named = spark.createDataFrame([(None, near), (4, texts[0])], "doc_id long, text string")
    assert [r.doc_id for r in simhash.representatives(named).collect()] == [4]


ODD = [
    (None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "a", 0), (2, " \n", "en", None, 2), (3, "word " * 40_000, "en", "a", 200_000),
    (4, "some words that are in this text", "en", "b", 32), (4, "some words that are in this text", "en", "b", 32), (None, "and a text without an id here", None, "b", 29), (5, "12345", None, "a", 5),
]


def test_odd_rows_in_every_stage(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, and empty tables."""
    kind = "doc_id long, text string, lang string, source string, n_chars int"
    docs = spark.createDataFrame(ODD, kind)
    (tmp_path / "sf").mkdir()
    spark.createDataFrame([(1, 1, 0), (4, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "sf" / "labels.parquet"))
    sf = str(tmp_path / "sf")
    assert sorted(map(str, P.reject_toxic(spark, docs, sf).collect())) == sorted(map(str, docs.collect()))
    kept = {r.doc_id for r in P.reject_undetermined(spark, docs, sf).collect()}
    assert kept <= {3, 4, None} and 1 not in kept
    left = P.drop_near_copies(spark, docs, sf).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left) == [(False, 1), (False, 3), (False, 4), (False, 5), (True, 0)]
    assert {r.doc_id for r in P.mix_sources(spark, docs, sf).collect()} <= {3, 4, None, 5}
    encoded = P.encode(spark, docs, sf)
    assert encoded.count() == len(ODD) and all(r.exact for r in encoded.collect())
    none = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, none, sf).count() == 0


def test_names_of_columns_that_clash(spark):
    """Columns with the names that the operators use inside pass through, or are replaced where the docstring says so."""
    from quire.llm.common import with_texts

    df = spark.createDataFrame([(1, "ab", "x", "y", 7)], "doc_id long, text string, _text string, _TEXT_ string, n long")
    out = with_texts(df, "text", "n long", lambda: lambda texts: [[len(t) for t in texts]]).first()
    assert (out.doc_id, out["_text"], out["_TEXT_"], out.n) == (1, "x", "y", 2)
