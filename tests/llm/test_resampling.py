"""Importance resampling: equal to plain loops; streams in pieces, odd rows."""

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

from quire.llm import queries as Q
from quire.llm import resampling

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]]


def by_hand(docs, target):
    """(id, n_features, weight, score, rank) of each (id, text)."""
    each = [(i, *features(t)) for i, t in docs]
    own, aim = [0] * 10_000, [0] * 10_000
    for *_, found in each:
        for k in found:
            own[k] += 1
    for t in target:
        for k in features(t)[1]:
            aim[k] += 1
    gain = [math.floor(1000 * math.log((float(a + 1) * float(sum(own) + 10_000)) / (float(s + 1) * float(sum(aim) + 10_000)))) for s, a in zip(own, aim)]
    out, eligible = [], []
    for row, (i, n, found) in enumerate(each):
        weight = sum(gain[k] for k in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None])
        if n >= 20:
            eligible.append((-score, i is None, i, row))
    for rank, (*_, row) in enumerate(sorted(eligible)[: 25 * len(eligible) // 100], 1):
        out[row][4] = rank
    return sorted(map(tuple, out), key=str)


def test_query_equals_plain_loops(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    read = lambda name, *columns: [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*columns).collect()]
    expected = by_hand(read("documents", "doc_id", "text"), [t for (t,) in read("benchmark", "text")])
    assert sorted(map(tuple, Q.op12_resampling(spark, SF).collect()), key=str) == expected


def test_odd_rows_and_clashing_names(spark, monkeypatch):
    words = " ".join(random.Random(3).choices(["Alpha", "beta", "été", "x1", "—", "ЖУК"], k=300))
    texts = [None, "", " \n!?", "one", words, words, words[:400], "nineteen " * 19, "twenty " * 20, "A" * 5000, "Long word, " * 20_000]
    docs = [(i, t) for i, t in enumerate(texts)] + [(4, words), (None, words), (None, None)] + [(100 + i, words[i:]) for i in range(40)]
    df = spark.createDataFrame([(i, t, "kept", 9, [1, None]) for i, t in docs], "doc_id long, text string, note string, rank int, more array<int>")
    target = spark.createDataFrame([("beta x1 " * 30,), (None,), ("",)], "text string")
    monkeypatch.setattr(resampling, "FEATURES_A_STREAM", 700)
    monkeypatch.setattr(resampling, "BYTES_AT_ONCE", 50)
    rows = resampling.resampled(df, target).collect()
    assert all(r.note == "kept" and r.more == [1, None] for r in rows)
    found = sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows), key=str)
    assert found == by_hand(docs, ["beta x1 " * 30, None, ""])
    assert resampling.resampled(df.limit(0), target).count() == 0
    alone = resampling.resampled(df.select("doc_id", "text"), target.limit(0)).collect()
    assert sorted(map(tuple, alone), key=str) == by_hand(docs, [])


def test_run_lengths_and_sums():
    rng = np.random.default_rng(4)
    stream = rng.integers(0, 50, 3000).astype("<u2")
    keys, times = resampling.run_lengths(stream)
    assert dict(zip(keys.tolist(), times.tolist())) == {int(k): int((stream == k).sum()) for k in set(stream.tolist())}
    assert [len(x) for x in resampling.run_lengths(stream[:0])] == [0, 0]
    gain = rng.integers(-9, 9, 50).astype(np.int32)
    ends = np.sort(np.r_[0, 0, rng.integers(0, 3000, 40), 3000, 3000])
    starts = np.r_[0, ends[:-1]]
    assert resampling.sums_by_document(stream, ends, gain).tolist() == [int(gain[stream[a:b]].sum()) for a, b in zip(starts, ends)]


def test_pieces_of_a_text_give_the_features_of_the_whole(monkeypatch):
    text = " ".join(random.Random(5).choices(["ab", "c", "ddd,é", "E-f"], k=500))
    whole = sorted(np.concatenate(list(resampling.bucket_stream(text))).tolist())
    monkeypatch.setattr(resampling, "BYTES_AT_ONCE", 7)
    assert sorted(np.concatenate(list(resampling.bucket_stream(text))).tolist()) == whole == sorted(features(text)[1])
