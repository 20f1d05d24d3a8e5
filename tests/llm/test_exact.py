"""Sentence pieces, images, shards, mixes: brute force and round trips."""

import hashlib
import math
import os
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import media, mixing, sentencepiece, sharding
from quire.llm.queries import tokenizer

PATH = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as file:
        return sentencepiece.read_vocabulary(file.read())


@pytest.fixture(scope="module")
def codec(vocabulary):
    return sentencepiece.Codec(vocabulary)


def test_pieces_equal_the_library(vocabulary):
    import sentencepiece as library

    sp = library.SentencePieceProcessor(model_file=PATH)
    assert vocabulary.pieces == [sp.id_to_piece(i) for i in range(sp.get_piece_size())] and vocabulary.model == sentencepiece.BPE


def test_paths_are_best_and_come_back(vocabulary, codec):
    rng = random.Random(1)
    parts = ["a", "the", "▁", " ", "  ", "é", "日", "\U0010ffff", "\U0010fffe", "\n", "ing", "xxx", "1", "🙂", "\x00"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(800)] + ["ab " * 3 + "z" * 6000, "" * 3]
    score = {vocabulary.pieces[i].encode(): -np.log(2 - max(vocabulary.scores[i], -1e6)) for i in range(len(vocabulary.pieces)) if vocabulary.kinds[i] == 1}
    value = {i: score.get(p.encode(), codec.unknown) for i, p in enumerate(vocabulary.pieces)}
    for text, ids in zip(texts, codec.encode(texts)):
        assert codec.decode(ids) == text
        if text and not {"▁", "\U0010ffff"} & set(text):
            raw = f" {text}".replace(" ", "▁").encode()
            best = [0.0]
            for k in range(1, len(raw) + 1):
                best.append(max([best[k - 1] + codec.unknown, *(best[j] + score[raw[j:k]] for j in range(max(0, k - 48), k) if raw[j:k] in score)]))
            assert sum(value[i] for i in ids.tolist()) == pytest.approx(best[-1])


def test_unigram_vocabulary_without_word_starts():
    pieces = [*(f"<0x{b:02X}>" for b in range(256)), "a", "b", "ab", "a▁b", "▁"]
    kinds = [sentencepiece.BYTE] * 256 + [sentencepiece.NORMAL] * 5
    c = sentencepiece.Codec(sentencepiece.Vocabulary(pieces, [0.0] * 256 + [-1.0, -1.0, -1.5, -1.2, -1.0], kinds, dummy_prefix=False))
    assert not c.by_word
    assert [x.tolist() for x in c.encode(["a b", "ab", "bab", ""])] == [[259], [258], [257, 258], []]


def test_encoded_rows(spark):
    rows = [(1, "some text", 3), (1, "some text", 3), (None, None, None), (2, "", 0), (3, "long " * 40_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = sentencepiece.encoded(df, PATH)
    got = out.collect()
    assert all(r.exact and r.n_pieces == len(r.ids) for r in got) and sum(r.n_pieces == 0 for r in got) == 2
    back = sentencepiece.decoded(out, PATH)
    assert Counter(r.text for r in back.collect()) == Counter(r[1] or "" for r in rows)
    assert sentencepiece.encoded(df.limit(0), PATH).count() == 0


def test_images_come_back():
    rng = np.random.default_rng(0)
    gray, colour = rng.integers(0, 256, (7, 5)).astype(np.uint8), rng.integers(0, 256, (7, 5, 3)).astype(np.uint8)
    for kind, pixels in (("pgm", gray), ("bmp", gray), ("ppm", colour), ("bmp", colour)):
        assert (media.decode(media.encode(pixels, kind)) == pixels).all()
    assert media.decode(b"P1 # note\n2 1\n1 0").tolist() == [[0, 255]]
    assert media.decode(b"P2\n2 1\n300\n7 300").tolist() == [[7, 300]]
    assert media.decode(b"P4\n3 1\n\xa0").tolist() == [[0, 255, 0]]
    assert media.decode(b"P5 1 1 65535 \x01\x02").tolist() == [[258]]
    for broken in (b"", b"P5", b"P5 2 2 255 \x01", b"BM", b"GIF89a", b"P5 0 1 255 ", b"P3 1 1 255 1 2"):
        with pytest.raises(ValueError):
            media.decode(broken)


def test_area_resize_equals_means_of_boxes():
    a = np.random.default_rng(1).random((13, 10))
    for h, w in ((8, 9), (4, 5), (20, 30), (1, 1)):
        want = np.zeros((h, w))
        for i in range(h):
            for j in range(w):
                weight = lambda n, k, m: np.clip(np.minimum(np.arange(1, n + 1), (k + 1) * n / m) - np.maximum(np.arange(n), k * n / m), 0, None)
                y, x = weight(13, i, h), weight(10, j, w)
                want[i, j] = y @ a @ x / y.sum() / x.sum()
        assert media.area_resize(a, h, w) == pytest.approx(want)


def test_text_media_and_tiles(spark):
    rows = [(1, "text é"), (1, "text é"), (None, None), (2, ""), (3, "y" * 576), (4, "z" * 100_000)]
    out = {(r.doc_id, r.n_bytes): r for r in media.text_media(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, text in rows:
        raw = (text or "").encode()
        r = out[doc_id, len(raw)]
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        assert (r.payload_bytes, r.tail_crc32, r.media_bytes) == (len(payload), zlib.crc32(payload[-32:]), len(r.media))
        assert media.decode(bytes(r.media)).tobytes() == payload and np.load(__import__("io").BytesIO(bytes(r.tile))).shape == (24, 24)
    images = spark.createDataFrame([(1, media.encode(np.arange(60 * 30, dtype=np.uint8).reshape(60, 30), "pgm")), (2, b"no"), (3, None)], "id int, media binary")
    got = {r.id: r for r in media.media_tiles(images).collect()}
    assert [(t.row, t.col) for t in got[1].tiles] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (2, 1)] and got[2].error and not got[3].tiles
    assert len(media.media_tiles(images, resize=(24, 24)).filter("id = 1").first().tiles) == 1


def documents(spark, n=400):
    rng = random.Random(6)
    rows = [(i, " ".join(["wörd"] * rng.randint(0, 60)), rng.choice(["hot"] * 5 + ["a", "b", None])) for i in range(n)]
    rows += [(n + i, "one hot copy of a text", "hot") for i in range(n // 2)] + [(None, None, "a"), (None, None, "a"), (3, rows[3][1], rows[3][2]), (n * 2, "x " * 3000, "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


def test_shards(spark):
    df, rows = documents(spark)
    got = sharding.sharded(df, 6).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert {r.law for r in got} == {"bytes"} and {r.shard for r in got} == set(range(6))
    total = Counter()
    for r in got:
        total[r.shard] += r["size"]
    even = sum(total.values()) / 6
    largest = max(size(t) for _, t, _ in rows)
    assert all(abs(t - even) <= largest for t in total.values())
    for s in range(6):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    split = [c for c in {r.text_crc32 for r in got} if len({r.shard for r in got if r.text_crc32 == c}) > 1]
    assert len(split) <= 5  # copies are divided at boundaries alone
    again = sharding.sharded(df.repartition(7), 6).collect()
    assert Counter((r.doc_id, r.shard) for r in got) == Counter((r.doc_id, r.shard) for r in again)
    assert sharding.sharded(df.limit(0), 6).count() == 0 and {r.shard for r in sharding.sharded(df.limit(9), 1).collect()} == {0}


def test_the_tree_against_sorted_points(spark):
    """Each cut of the tree lies on the widest axis, at the weighted median of the points there, to the grain or one point."""
    rng = random.Random(12)
    rows = []
    for _ in range(600):
        dims = [rng.randrange(0, 4096), rng.choice([5, 6, 4000]), rng.randrange(100, 900)]
        rows.append((float(rng.randint(1, 50)), *[d << 36 | rng.getrandbits(36) for d in dims]))
    rows += [(9.0, *rows[0][1:])] * 40  # points that no cut can part
    points = spark.createDataFrame(rows, "weight double, k0 long, k1 long, k2 long")
    axes, grain = ["k0", "k1", "k2"], 0.5
    tree = sharding.kd_tree(points, axes, 11, grain)

    def check(node, inside):
        if not node.parts:
            assert node.shards == 1
            return
        spans = {a: max(r[1 + i] >> 36 for r in inside) - min(r[1 + i] >> 36 for r in inside) for i, a in enumerate(axes)}
        assert spans[node.axis] == max(spans.values())
        i = axes.index(node.axis)
        low, high = [r for r in inside if r[1 + i] < node.line], [r for r in inside if r[1 + i] >= node.line]
        total = sum(r[0] for r in inside)
        goal = total * node.parts[0].shards / node.shards
        ordered = sorted(inside, key=lambda r: r[1 + i])
        best, run = goal, 0.0
        for at, r in enumerate(ordered):
            run += r[0]
            if at + 1 == len(ordered) or ordered[at + 1][1 + i] != r[1 + i]:
                best = min(best, abs(run - goal))
        assert abs(sum(r[0] for r in low) - goal) <= best + 2 * grain
        for part, those in zip(node.parts, (low, high)):
            check(part, those)

    check(tree, rows)
    assert [n.first for n in tree.leaves()] == list(range(11))


def test_metadata_parts_the_rows(spark):
    """The first cut is by source: the sources of the lower shards come before those of the upper ones, but for the source that is cut."""
    rng = random.Random(1)
    rows = [(i, f"{i} " + "w" * rng.randint(1, 90), rng.choice("abcdefgh"), "xy"[i % 2], i) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, place int")
    source = {r[0]: r[2] for r in rows}
    out = sharding.sharded(df, 8).collect()
    low, high = ({source[r.doc_id] for r in out if (r.shard < 4) == side} for side in (True, False))
    assert len(low & high) <= 1 + 2 and max(low - high) < min(high - low)


def test_one_row_a_third_of_the_table(spark):
    rows = [(7, "same text for all of these") for _ in range(300)] + [(None, "and these") for _ in range(300)] + [(i, f"text {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.sharded(df, 6).collect()
    total = Counter()
    for r in out:
        total[r.shard] += r["size"]
    even = sum(total.values()) / 6
    assert len(out) == 900 and all(abs(t - even) < 0.25 * even for t in total.values()), total
    for s in range(6):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))


def targets(sizes):
    """By the rule itself: deal, cap, deal the rest again."""
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, open_, out = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        total = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / total > 2 * sizes[s]]
        if not over:
            return out | {s: left * weights[s] / total for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= set(over)


def test_mix(spark):
    df, rows = documents(spark)
    block = 4
    got = mixing.mixed(df, block=block).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = targets(sizes)
    assert Counter((r.doc_id, r["size"], r.source) for r in got) == Counter((d, len((t or "").split()), s) for d, t, s in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 2 * block for s in sizes)
    again = mixing.mixed(df.repartition(5), block=block)
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again.collect())
    assert mixing.mixed(df.limit(0)).count() == 0


def spark_hash(*values):
    """xxhash64() of longs, ints (as (value,)) and texts."""
    seed = 42
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v)
            seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def permuted(index, n, seed):
    high = math.isqrt(n - 1) + 1
    low = -(-n // high)
    while True:
        a, b = divmod(index, low)
        for k in range(mixing.ROUNDS):
            a = (a + spark_hash(seed, (2 * k,), b)) % high
            b = (b + spark_hash(seed, (2 * k + 1,), a)) % low
        index = a * low + b
        if index < n:
            return index


def plain_mix(rows, block, shard_slots):
    """(shard, place, source, index) of every block, and the words taken of every (source, own)."""
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    target = targets(sizes)
    rank = {s: i for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    slots = {}
    for s, size in sizes.items():
        if size:
            blocks, passes = -(-size // block), int(target[s] / size + 1e-9)
            slots[s] = passes * blocks + round(max(target[s] - passes * size, 0) / size * blocks)
    shards = max(1, -(-sum(slots.values()) // shard_slots))
    counts = {(s, t): 0 for s in slots for t in range(shards)}
    for s, n in slots.items():
        for slot in range(n):
            counts[s, spark_hash(rank[s], slot, (7,)) % shards] += 1
    mix, times = [], Counter()
    for t in range(shards):
        before, everything = 0, sum(counts[s, t] for s in slots)
        for s in sorted(slots, key=rank.get):
            first, blocks = sum(counts[s, u] for u in range(t)), -(-sizes[s] // block)
            for n in range(counts[s, t]):
                turn, at = divmod(first + n, blocks)
                index = permuted(at, blocks, spark_hash(rank[s], turn, (8,)))
                mix.append((t, permuted(before + n, everything, spark_hash(t, (9,))), s, index))
                times[s, index] += 1
            before += counts[s, t]
    taken = {}
    for s in slots:
        own = [(spark_hash(d, t), len((t or "").split())) for d, t, of in rows if of == s]
        at = 0
        for o, size in sorted(own, key=lambda x: (spark_hash(x[0], (5,)) % 1, spark_hash(x[0], (6,)), x[0])):
            taken.setdefault((s, o), []).append(sum(times[s, w // block] for w in range(at, at + size)))
            at += size
    return mix, {k: sorted(v) for k, v in taken.items()}


def test_the_mix_as_a_plain_version_makes_it(spark, monkeypatch):
    """Counts over shards, places, blocks and words taken, for rows with equal, null and repeated ids."""
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 40)
    monkeypatch.setattr(mixing.drawn, "__defaults__", (40,))
    df, rows = documents(spark)
    block = 16
    mix, taken = plain_mix(rows, block, 40)
    got = mixing.mixture(df, block=block).collect()
    assert sorted(map(str, ((r.shard, r.place, r.source, r["index"]) for r in got))) == sorted(map(str, mix))
    by_shard = Counter(r.shard for r in got)
    assert len(by_shard) > 3 and all(sorted(r.place for r in got if r.shard == t) == list(range(n)) for t, n in by_shard.items())
    assert all(r.words == sum(p["words"] for p in r.parts) <= block for r in got)
    totals = {}
    texts = {}
    for d, t, s in rows:
        texts.setdefault((d, s), set()).add(t)
    out = mixing.mixed(df, block=block).collect()
    for r in out:
        totals.setdefault(r.source, []).append(r.taken)
    want = {}
    for (s, _), values in taken.items():
        want.setdefault(s, []).extend(values)
    assert {s: sorted(v) for s, v in totals.items() if sum(v)} == {s: sorted(v) for s, v in want.items() if sum(v)}
    from_mix = Counter()
    for r in got:
        for p in r.parts:
            from_mix[p["doc_id"], r.source] += p["words"]
    assert +Counter(from_mix) == +sum((Counter({(r.doc_id, r.source): r.taken}) for r in out), Counter())


def test_repeated_rows_crowd_a_run(spark, monkeypatch):
    """A third of all rows repeat one another: they are dealt on, and the result is the same."""
    rows = [(i if i % 3 else 0, f"a b {i}" if i % 3 else "x y z", "s") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "ROWS_A_RUN", 40)
    got = mixing.mixed(df, block=8).collect()
    again = mixing.mixed(df.repartition(7), block=8).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    assert len(got) == 900 and abs(sum(r.taken for r in got) - 1.5 * 2700) <= 16 and all(0 <= r.taken <= 6 for r in got)


def test_permutation(spark):
    for n in (1, 2, 3, 5, 7, 10, 1000, 333334, 1000003):
        d = spark.range(min(n, 3000)).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(-12345).cast("long")).alias("x"))
        xs = [r.x for r in d.collect()]
        assert len(set(xs)) == len(xs) and all(0 <= x < n for x in xs)
        if n >= 1000:  # no stretch of the source
            assert xs[:9] == [permuted(i, n, -12345) for i in range(9)] and len({b - a for a, b in zip(xs, xs[1:])}) > len(xs) / 4


def test_targets_on_random_sources(spark):
    rng = random.Random(9)
    for _ in range(6):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 100, 10_000]) for i in range(rng.randint(1, 12))} | {None: 50}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        want = targets(sizes)
        assert all(r.target == pytest.approx(want[r.source]) for r in mixing.targets(df).collect())


def test_a_normaliser_that_changes_texts_is_refused():
    data = open(PATH, "rb").read()
    assert sentencepiece.read_vocabulary(data).dummy_prefix
    settings = next(v for k, v in sentencepiece._fields(data) if k == 3)
    for changed in (settings.replace(b"\x20\x00", b"\x20\x01"), settings + b"\x28\x00"):
        at = data.index(settings)
        other = data[: at - 1] + bytes([len(changed)]) + changed + data[at + len(settings) :]
        with pytest.raises(ValueError, match="not supported"):
            sentencepiece.read_vocabulary(other)


def test_strips_of_a_long_image_add_up(monkeypatch):
    rng = np.random.default_rng(12)
    for shape in ((1000, 24), (7, 5), (333, 24, 3), (24, 24)):
        pixels = rng.integers(0, 256, shape, dtype=np.uint8)
        whole = media.resized(pixels, [(8, 9), (24, 24)])
        for strip in (1, 50, 24 * 37):
            monkeypatch.setattr(media, "PIXELS_AT_ONCE", strip)
            for a, b in zip(whole, media.resized(pixels, [(8, 9), (24, 24)])):
                assert a == pytest.approx(b, abs=1e-9)
        monkeypatch.undo()
        gray = media.grayscale(pixels)
        if shape[:2] == (24, 24):
            assert whole[1] == pytest.approx(gray)


def test_the_query_has_the_tiles(spark):
    from quire.llm import queries as Q

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tiles = {r.doc_id: hashlib.sha256(bytes(r.tile)).hexdigest() for r in media.text_media(docs.select("doc_id", "text")).collect()}
    assert {r.doc_id: r.tile_sha256 for r in Q.op10_media(spark, "/root/testdata/sf0.001").collect()} == tiles
