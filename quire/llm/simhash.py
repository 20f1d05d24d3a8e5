"""SimHash fingerprints and their exact links within a Hamming radius.

A 64-bit fingerprint is embedded as the bit counts of its 32 two-bit segments, each count in unary (0: 00, 1: 01, 2: 11), so
the embedding is one long and the Manhattan distance of two embeddings is the number of differing bits of these longs. That
distance never exceeds the Hamming distance. The range join lays a grid over groups of segments: of GROUPS groups at most
RADIUS hold a difference, so two fingerprints within the radius share the cell of some GROUPS - RADIUS groups. Inside a cell
the Manhattan distance is the lower bound, and the Hamming distance decides.

Texts with one fingerprint are one point, whatever their number. A cell returns a spanning forest of its links, not its
pairs. A cell of over CELL_LIMIT points is not gathered: its points go to a finer grid on the exact bits, whose cells leave
12 bits free and so hold 4096 points at most. Components come from minimum labels with pointer jumping over stored tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import fresh, reliable, stored, with_texts

SEED = 42
RADIUS = 3
GROUPS = 6
SEGMENTS = 32
CELL_LIMIT = 1 << 16
SHINGLES_AT_ONCE = 100_000
BANDS, BAND = 16, 3
LOOSE = 0.3  # how far below the similarity a sketch may estimate a pair that is then compared exactly
BAND_LIMIT = 8192  # different sketches of a band's cell that one task compares
GROUP_LIMIT = 2_000_000  # shingles of a group of candidates that one task compares
_LOW = np.uint64(0x5555555555555555)
_ONE = np.uint64(1)


def shingles(text: str, width: int) -> list[bytes]:
    """Runs of width words of the text with A-Z lower-cased; of a shorter text its words; words end at ASCII white space."""
    words = text.encode().lower().split()
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return [b" ".join(run) for run in zip(*(words[i:] for i in range(width)))]


def fingerprint(text: str, width: int = 3) -> int:
    """The 64-bit SimHash as a signed long; 0 for a text without words."""
    runs = shingles(text, width)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(runs), SHINGLES_AT_ONCE):
        hashes = np.array([digest(run, SEED) for run in runs[at : at + SHINGLES_AT_ONCE]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(runs), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """df's columns but the text, and fp: the fingerprint as a long. A null text counts as empty."""
    def start():
        return lambda texts: [np.array([fingerprint(t, width) if t else 0 for t in texts], np.int64)]

    return with_texts(df, text, "fp long", start)


def embed(fp: np.ndarray) -> np.ndarray:
    """The bit counts of the two-bit segments, in unary."""
    return ((fp | (fp >> _ONE)) & _LOW) | (((fp & (fp >> _ONE)) & _LOW) << _ONE)


def embedded(fp: Column) -> Column:
    """embed() as a column."""
    low, next_bit = F.lit(0x5555555555555555), F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(next_bit).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(next_bit).bitwiseAND(low), 1))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def cell_masks(groups: int = GROUPS, radius: int = RADIUS, segments: int = SEGMENTS) -> list[int]:
    """For each choice of groups - radius groups of segments, the bits that these cover, as signed longs."""
    width = 64 // segments
    cuts = [round(i * segments / groups) for i in range(groups + 1)]
    covered = [sum(((1 << width) - 1) << (width * s) for s in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [signed(sum(covered[g] for g in kept)) for kept in combinations(range(groups), groups - radius)]


def cells(points: DataFrame, place: Column, masks: list[int]) -> DataFrame:
    """(grid, cell, fp): each point once for each mask, in the cell that it has there."""
    grids = F.array(*[F.struct(F.lit(i).alias("grid"), F.lit(m).alias("mask")) for i, m in enumerate(masks)])
    return points.select("fp", place.alias("place"), F.explode(grids).alias("at")).select(
        F.col("at.grid").alias("grid"), F.col("place").bitwiseAND(F.col("at.mask")).alias("cell"), "fp"
    )


def forest(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges (root, point) that join the points of one cell that chains of links within the radius connect."""
    points = fp.view(np.uint64)
    places = embed(points)
    left = np.arange(len(points))
    edges = []
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        queue = [root]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(places[left] ^ places[at]) <= radius  # the lower bound
            near[near] = np.bitwise_count(points[left[near]] ^ points[at]) <= radius
            if near.any():
                hits = left[near]
                left = left[~near]
                queue.extend(hits.tolist())
                edges.extend((int(fp[root]), int(fp[h])) for h in hits)
    return edges


def links_in_cells(placed: DataFrame, radius: int, limit: int) -> DataFrame:
    """(a, b, dense): spanning edges of each cell; for a cell over the limit its points, as (fp, fp, true)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []  # the open cell's points
        last = None
        size, over = 0, False

        def rows(edges, dense):
            a = np.array(edges, np.int64).reshape(-1, 2)
            return pd.DataFrame({"a": a[:, 0], "b": a[:, 1], "dense": dense})

        def closed() -> Iterator[pd.DataFrame]:
            if held and not over and size > 1:
                if edges := forest(np.unique(np.concatenate(held)), radius):
                    yield rows(edges, False)

        for batch in batches:
            grid, cell, fp = (batch[c].to_numpy() for c in ("grid", "cell", "fp"))
            if not len(fp):
                continue
            cuts = np.flatnonzero((grid[1:] != grid[:-1]) | (cell[1:] != cell[:-1])) + 1
            bounds = np.concatenate([[0], cuts, [len(fp)]])
            found: list = []
            for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                key = (grid[a], cell[a])
                if 0 < k < len(bounds) - 2:  # a whole cell inside the batch
                    if b - a == 1:
                        continue
                    if b - a <= limit:
                        found += forest(np.unique(fp[a:b]), radius)
                        continue
                if key != last:
                    yield from closed()
                    held, last, size, over = [], key, 0, False
                size += b - a
                held.append(fp[a:b])
                if size > limit:
                    over = True
                    for part in held:
                        yield rows(np.stack([part, part], axis=1), True)
                    held = []
            if found:
                yield rows(found, False)
        yield from closed()

    return placed.repartition("grid", "cell").sortWithinPartitions("grid", "cell").mapInPandas(run, "a long, b long, dense boolean")


def linked(points: DataFrame, radius: int = RADIUS, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(a, b): edges between fingerprints whose components are those of all links within the radius.

    points: one row for each distinct fp. The coarse grid is exact for radius 3 and less.
    """
    found = reliable(links_in_cells(cells(points, embedded(F.col("fp")), cell_masks(radius=radius)), radius, cell_limit).distinct())
    edges = found.filter("not dense").select("a", "b")
    dense = found.filter("dense").select(F.col("a").alias("fp")).distinct()
    if dense.isEmpty():
        return edges
    fine = cell_masks(16, radius, 16)  # 16 groups of four bits: the free bits are 12
    again = reliable(links_in_cells(cells(dense, F.col("fp"), fine), radius, 1 << (4 * radius)).distinct())
    return edges.unionByName(again.select("a", "b")).distinct()


def contracted(edges: DataFrame) -> DataFrame:
    """Edges with the components of the edges (a, b), no longer as many for a b as it has different a: each b is joined to its smallest a alone, and those
    a to each other. Forests of many cells whose b are the same thus come to about one edge a node, as their a, the roots, are few. A b has at most one a
    for each cell that it is in, so none collects many."""
    parents = edges.filter("a <> b").groupBy("b").agg(F.array_sort(F.collect_set("a")).alias("p"))
    return parents.select(F.col("p")[0].alias("a"), F.explode(F.concat(F.array("b"), F.slice("p", 2, 1 << 30))).alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b), b's own and a the one that it was found by, reaches."""
    edges = contracted(contracted(edges))
    both = reliable(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = reliable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
    while True:
        offered = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("offer"))
        better = labels.join(offered, F.col("node") == F.col("a"), "left").select(
            "node", F.col("root").alias("old"), F.least("root", F.coalesce("offer", "root")).alias("root")
        )
        above = labels.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
        moved = reliable(
            better.join(above, F.col("root") == F.col("n2"), "left").select("node", "old", F.least("root", F.coalesce("r2", "root")).alias("root"))
        )
        labels = moved.select("node", "root")
        if moved.filter("old <> root").isEmpty():
            return labels


def near_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id): the SimHash in 16 hex digits and the smallest id that links reach.

    Links hold between fingerprints that differ in at most radius bits; equal texts and repeated rows have one fingerprint and
    are linked by it. A null, empty or blank text has fingerprint zero, linked like any other. Rows with a null id stay, and a
    class without any id has a null component_id. Other columns are not read.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the grid is exact for a radius from 0 to 3")
    rows = reliable(fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), width=width))
    points = reliable(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(linked(points.select("fp"), radius))
    rooted = points.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    classes = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = reliable(rooted.join(classes, "root").select("fp", "component_id"))
    return rows.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def shingle_hashes(text: str, width: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(run, SEED) for run in shingles(text, width)], np.uint64))


def set_key(hashes: np.ndarray) -> int:
    """A 64-bit hash of a set of shingle hashes, as a signed long."""
    return signed(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """BANDS * BAND minima of the hashes under as many multiplications; zeros without hashes."""
    rng = np.random.default_rng(17)
    factors = rng.integers(0, 2**63, BANDS * BAND, dtype=np.uint64) * np.uint64(2) + _ONE
    if not len(hashes):
        return np.zeros(len(factors), np.uint64)
    best = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 4096):
        mixed = hashes[at : at + 4096, None] * factors
        mixed ^= mixed >> np.uint64(29)
        best = np.minimum(best, (mixed * np.uint64(0x9E3779B97F4A7C15)).min(axis=0))
    return best


def alike(batches: Iterator[pd.DataFrame], least: float, limit: int | None = None) -> Iterator[pd.DataFrame]:
    """(a, b, dense): edges that join the members of a cell (cell, i, j), which comes whole and sorted by sketch, that chains of resembling sketches connect.
    Members with one sketch are one, so that the comparisons of a large cell are those of its different sketches. A cell with more of them than limit is
    given back as (key, cell, true)."""
    held: list = []
    last = None
    over = False

    def edges() -> list[tuple[int, int, bool]]:
        if len(held) < 2:
            return []
        keys = np.array([h[0] for h in held], np.int64)
        own = np.frombuffer(b"".join(h[1] for h in held), np.uint8).reshape(len(held), -1)
        left = np.arange(len(keys))
        out = []
        while len(left) > 1:
            queue, left = [left[0]], left[1:]
            joined = list(queue)
            while queue and len(left):
                at = queue.pop()
                near = (own[left] == own[at]).mean(axis=1) >= least
                if near.any():
                    hits = left[near].tolist()
                    queue.extend(hits)
                    joined += hits
                    left = left[~near]
            # The smallest key is the root, so that the bands of one group give the same edges.
            members = keys[joined]
            root = int(members.min())
            out += [(root, int(k), False) for k in members if k != root]
        return out

    def rows(found):
        a = np.array(found, np.int64).reshape(-1, 3)
        return pd.DataFrame({"a": a[:, 0], "b": a[:, 1], "dense": a[:, 2] > 0})

    for batch in batches:
        found: list[tuple[int, int, bool]] = []
        for cell, i, j, key, own in zip(*(batch[c].tolist() for c in ("cell", "i", "j", "key", "own"))):
            if (cell, i, j) != last:
                found += edges()
                held, last, over = [], (cell, i, j), False
            if held and held[-1][1] == own:
                found.append((held[-1][0], key, False))
                continue
            held.append((key, own))
            if limit and len(held) > limit:
                found += [(k, cell, True) for k, _ in held[:-1]] if not over else []
                found.append((key, cell, True))
                over, held = True, held[-1:]
            elif over:
                found.append((key, cell, True))
                held = held[-1:]
        if found:
            yield rows(found)
    if held and not over and (found := edges()):
        yield rows(found)


def banded(points: DataFrame, least: float, limit: int = BAND_LIMIT) -> DataFrame:
    """(a, b): edges between the keys of points (key, bands, own) that chains of pairs connect which agree in a band and whose sketches agree in a share of at
    least least. A cell of over limit sketches is dealt into blocks, of which any two meet."""
    compared = lambda placed, limit: placed.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "own", "key").mapInPandas(
        lambda batches: alike(batches, least, limit), "a long, b long, dense boolean"
    )
    placed = points.select(F.explode("bands").alias("cell"), F.lit(0).alias("i"), F.lit(0).alias("j"), "key", "own")
    found = reliable(compared(placed, limit))
    edges = found.filter("not dense").select("a", "b")
    dense = found.filter("dense").select(F.col("b").alias("group"), F.col("a").alias("key"), F.lit(1).alias("size")).distinct()
    if dense.isEmpty():
        return edges
    met = meetings(dense, limit).withColumnRenamed("group", "cell").join(points.select("key", "own"), "key")
    return edges.unionByName(compared(met, None).select("a", "b"))


def links_of_sets(names: list[int], sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Edges that join the sets that chains of Jaccard similarities of at least similarity connect. Each set is compared with all that are not joined yet: of its
    members, the rarest first, a prefix is looked up, long enough that a set which has too few of them cannot be similar; the others are compared exactly."""
    sizes = np.array([len(s) for s in sets])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    codes, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    codes = np.argsort(np.argsort(often, kind="stable"))[codes]  # numbered from the rarest
    whose = np.repeat(np.arange(len(sets)), sizes)
    codes = codes[np.lexsort((codes, whose))]
    order = np.argsort(codes, kind="stable")
    holders, held = whose[order], codes[order]
    starts = np.searchsorted(held, np.arange(len(often) + 1))
    left, indexed = np.ones(len(sets), bool), len(sets)
    mark = np.zeros(len(often), bool)
    edges = []
    for root in range(len(sets)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue and (rest := int(left.sum())):
            if 2 * rest < indexed:  # the index forgets what is joined
                kept = left[holders]
                holders, held, indexed = holders[kept], held[kept], rest
                starts = np.searchsorted(held, np.arange(len(starts)))
            at = queue.pop()
            mine = codes[bounds[at] : bounds[at + 1]]
            shared = np.ceil(similarity * (sizes + sizes[at]) / (1 + similarity) - 1e-9)
            prefix = min(len(mine), int(len(mine) * (1 - similarity) + 1e-9) + 1)
            own = mine[:prefix]
            lengths = starts[own + 1] - starts[own]
            ends = np.cumsum(lengths)
            places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[own] - ends + lengths, lengths)
            both = np.bincount(holders[places], minlength=len(sets))
            # Beyond the prefix at most the rest of the set is shared.
            maybe = np.flatnonzero(left & (both >= np.maximum(shared - (len(mine) - prefix), 1)))
            if not len(maybe):
                continue
            mark[mine] = True
            hits = np.array([h for h in maybe.tolist() if np.count_nonzero(mark[codes[bounds[h] : bounds[h + 1]]]) >= shared[h]], np.int64)
            mark[mine] = False
            left[hits] = False
            queue.extend(hits.tolist())
            edges.extend((names[at], names[h]) for h in hits.tolist())
    return edges


def meetings(members: DataFrame, limit: int) -> DataFrame:
    """members (group, size and others) with i, j: a group whose sizes add up to more than limit is dealt into blocks, and any two of its blocks meet in a
    cell (group, i, j), so each two members meet."""
    blocks = members.groupBy("group").agg(F.ceil(F.sum("size") / limit).alias("blocks"))
    dealt = members.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("key", F.lit(11)), F.greatest("blocks", F.lit(1))))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("blocks", F.lit(1)) - 1))).filter("blocks <= 1 or other <> block")
    return dealt.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("blocks", "block", "other")


def resembling(met: DataFrame, width: int, similarity: float) -> DataFrame:
    """(a, b): edges between the members of each cell (group, i, j) that chains of exact Jaccard similarities of their shingle sets, of at least similarity,
    connect. met: group, i, j, key, text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names: list[int] = []
        sets: list[np.ndarray] = []
        last = None

        def edges() -> Iterator[pd.DataFrame]:
            if len(names) > 1 and (found := links_of_sets(names, sets, similarity)):
                a = np.array(found, np.int64)
                yield pd.DataFrame({"a": a[:, 0], "b": a[:, 1]})

        for batch in batches:
            for group, i, j, key, text in zip(*(batch[c].tolist() for c in ("group", "i", "j", "key", "text"))):
                if (group, i, j) != last:
                    yield from edges()
                    names, sets, last = [], [], (group, i, j)
                names.append(key)
                sets.append(shingle_hashes(text or "", width))
        yield from edges()

    dealt = met.select("group", "i", "j", "key", "text").repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "key")
    return dealt.mapInPandas(run, "a long, b long")


def representatives(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """The rows of df that stay when of each group of near copies the one with the smallest id does.

    Near copies resemble each other by similarity or more: the exact Jaccard similarity of their sets of width-word shingles. Candidates are the links of the
    fingerprints within the radius, and, as copies at such a similarity differ in many more bits than a 64-bit fingerprint's grid reaches, pairs that agree in
    a band of a sketch of the same shingle hashes and whose sketches resemble each other. Chains of candidates only form groups: within a group any two
    texts are compared exactly unless links join them already, so no link is hidden by a candidate that fails. Texts with one set of shingles are one; those
    that have but the fingerprint in common are candidates.
    Exactly one row of each group stays: that of the smallest id, null ids last, and of rows with one id and one set of shingles any. Different texts under
    one id are different documents. Null, empty and blank texts are one group. Other columns pass through, whatever their names; an empty table gives no rows.
    """
    at = fresh(df, "_row")
    base = stored(df.withColumn(at, F.monotonically_increasing_id()))
    plain = base.select(F.col(at).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def start():
        def apply(texts):
            names, prints, sizes, keys, own = [], [], [], [], []
            for t in texts:
                prints.append(fingerprint(t or "", width))
                hashes = shingle_hashes(t or "", width)
                names.append(set_key(hashes))
                sizes.append(len(hashes))
                best = sketch(hashes)
                keys.append([signed(xxhash.xxh64_intdigest(best[k * BAND : (k + 1) * BAND].tobytes(), k)) for k in range(BANDS)])
                own.append((best >> np.uint64(56)).astype(np.uint8).tobytes())
            return [names, prints, sizes, keys, own]

        return apply

    rows = reliable(with_texts(plain, "text", "key long, fp long, size long, bands array<long>, own binary", start))
    # Size, bands and sketch depend on the set of shingles alone, so any row of a key has them.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("least")
    points = reliable(rows.groupBy("key").agg(least, F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("own").alias("own")))
    chained = banded(points, similarity - LOOSE)
    prints = reliable(rows.groupBy("fp").agg(F.min("key").alias("anchor")))
    same = rows.select("fp", "key").distinct().join(prints, "fp").filter("key <> anchor").select(F.col("anchor").alias("a"), F.col("key").alias("b"))
    near = linked(prints.select("fp"), radius)
    of = lambda end: prints.select(F.col("fp").alias(end), F.col("anchor").alias(f"{end}_key"))
    near = near.join(of("a"), "a").join(of("b"), "b").select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))
    edges = near.unionByName(same).unionByName(chained)
    grouped = components(reliable(edges.distinct()))
    members = points.join(grouped, F.col("key") == F.col("node")).select(F.col("root").alias("group"), "key", "least.row", "size")
    texts = meetings(reliable(members), GROUP_LIMIT).join(plain.select("row", "text"), "row")
    roots = components(resembling(texts, width, similarity))
    rooted = points.join(roots, F.col("key") == F.col("node"), "left").select("least", F.coalesce("root", "key").alias("root"))
    kept = rooted.groupBy("root").agg(F.min("least").alias("least")).select("least.row")
    dropped = reliable(rows.select("row").join(kept, "row", "left_anti"))  # a small part: then no text is shuffled
    return base.join(dropped.select(F.col("row").alias(at)), at, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
