"""Quality classification by Naive Bayes support vectors.

Features are indicators of hashed n-grams: of the text's characters, and of its shape, in which letters of one case and digits stand for their kind and runs
of a kind are one. Each indicator is scaled by the logarithm of the ratio of its counts in the two classes, and rows have unit length. A linear model with
hinge loss is fitted to them by dual coordinate descent; a logistic curve, fitted to margins of rows that the model has not seen, maps margins to 0..1.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import sampled, with_texts

FOLDS, HELD_OUT = 5, 0
MAX_GOOD, MAX_BAD = 3000, 3000  # rows to learn from, about: the bound of the labelled sample
ORDERS, SHAPE_ORDERS = (1, 2, 3), (1, 2, 3, 4, 5, 6)
BITS = 18
SMOOTHING = 1.0
PENALTY = 4.0  # C of the hinge loss
EPOCHS = 60
GAP = 1e-3  # of the projected gradients, at which the descent ends
CALIBRATION = 4  # one in so many sample rows is kept for the logistic curve
THRESHOLD = 0.3
CHARS_AT_ONCE = 200_000
# Odd multipliers of the n-gram hash.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D)
LOWER, UPPER, DIGIT = 0x110000, 0x110001, 0x110002  # kinds, as numbers that no character has


def held_out(doc_id: str) -> Column:
    """True for the fold that is not learnt from: crc32 of the id's text, mod 5, is 0. A null id is in none."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def kinds() -> np.ndarray:
    """For each code point its kind, or itself."""
    found = np.arange(0x110000, dtype=np.uint32)
    for point in range(0x20000):
        category = unicodedata.category(chr(point))
        if category in ("Ll", "Lo", "Lm"):
            found[point] = LOWER
        elif category in ("Lu", "Lt"):
            found[point] = UPPER
        elif category == "Nd":
            found[point] = DIGIT
    return found


def buckets(points: np.ndarray, order: int, salt: int) -> np.ndarray:
    """The bucket of each n-gram of that order."""
    n = len(points) - order + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    mixed = np.full(n, order + 16 * salt, np.uint32)
    for k in range(order):
        mixed = (mixed ^ points[k : k + n]) * np.uint32(MULTIPLIERS[k])
        mixed ^= mixed >> np.uint32(15)
    return mixed >> np.uint32(32 - BITS)


def points_of(text: str) -> np.ndarray:
    """Code points of the text, each run of white space as one blank, with a blank at both ends."""
    return np.frombuffer(f" {' '.join(text.split())} ".encode("utf-32-le", "replace"), np.uint32)


def shape_of(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Kinds in place of letters and digits, a run of a kind as one."""
    shape = kind[points]
    again = np.zeros(len(shape), bool)
    again[1:] = (shape[1:] == shape[:-1]) & (shape[1:] >= LOWER)
    return shape[~again]


def features(text: str | None, kind: np.ndarray) -> np.ndarray:
    """The different buckets of a text's n-grams, in order; none for a text without characters but white space."""
    present = np.zeros(1 << BITS, bool)
    if text and text.strip():
        points = points_of(text)
        for salt, (units, orders) in enumerate(((points, ORDERS), (shape_of(points, kind), SHAPE_ORDERS))):
            for order in orders:
                # An n-gram that begins in a part is found there.
                for at in range(0, len(units), CHARS_AT_ONCE):
                    present[buckets(units[at : at + CHARS_AT_ONCE + order - 1], order, salt)] = True
    return np.flatnonzero(present)


@dataclass
class Model:
    ratios: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))  # of the scaled indicators
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    def margin(self, found: np.ndarray) -> float:
        own = self.ratios[found].astype(np.float64)
        length = np.sqrt(np.square(own).sum())
        return float((own @ self.weights[found]) / length if length else 0.0) + self.bias

    def score(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_good: int, max_bad: int) -> tuple[DataFrame, dict[int, float]]:
    """(key, quality, text) of labelled documents outside the held-out fold, by a hash of the id about as many as the bounds, and the share taken of each
    class. An id with several labels counts as good if one says so, and has one text, that of the least hash."""
    own = labels.filter("doc_id is not null and quality is not null").filter(~held_out("doc_id")).groupBy("doc_id").agg(F.max((F.col("quality") > 0).cast("int")).alias("quality"))
    sizes = {r.quality: r["count"] for r in own.groupBy("quality").count().collect()}
    shares = {q: min(1.0, (max_good if q else max_bad) / n) for q, n in sizes.items()}
    share = F.coalesce(*[F.when(F.col("quality") == q, F.lit(s)) for q, s in shares.items()], F.lit(0.0))
    chosen = own.filter(sampled(F.xxhash64("doc_id"), share))
    # The number of ids chosen is bounded by the parameters, so they can be broadcast.
    found = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min_by("text", F.xxhash64("text")).alias("text")).select(F.xxhash64("doc_id").alias("key"), "quality", "text"), shares


def fit(docs: DataFrame, labels: DataFrame, max_good: int = MAX_GOOD, max_bad: int = MAX_BAD) -> Model:
    """Learns from at most about max_good and max_bad labelled rows: their n-gram buckets, not their texts, come here. Without rows of both classes
    every score is that of the class there is, or a half."""
    sample, shares = labelled_sample(docs, labels, max_good, max_bad)

    def start():
        kind = kinds()
        return lambda texts: [[features(t, kind).astype(np.int32) for t in texts]]

    rows = with_texts(sample, "text", "buckets array<int>", start).toArrow()
    order = np.lexsort((np.asarray(rows.column("key")), np.asarray(rows.column("quality"))))
    listed = rows.column("buckets")
    found = [np.asarray(listed[int(i)].values, np.int64) for i in order]
    y = np.asarray(rows.column("quality"))[order]
    return train(found, y, np.array([1 / shares[int(q)] for q in y]))


def train(found: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> Model:
    """found: the buckets of each row; y: 0 or 1; weight: the rows that each stands for."""
    model = Model()
    if len(set(y.tolist())) < 2:
        model.offset = 0.0 if not len(y) else 4.0 if y[0] else -4.0
        return model
    rng = np.random.default_rng(5)
    held = np.zeros(len(y), bool)
    for q in (0, 1):
        own = rng.permutation(np.flatnonzero(y == q))
        held[own[::CALIBRATION] if len(own) >= 2 * CALIBRATION else own[:0]] = True
    learnt = [found[i] for i in np.flatnonzero(~held)]
    model.ratios = log_count_ratios(learnt, y[~held])
    model.weights, model.bias = hinge(learnt, y[~held], model.ratios)
    seen = held if held.any() else ~held
    margins = np.array([model.margin(found[i]) for i in np.flatnonzero(seen)])
    model.slope, model.offset = logistic(margins, y[seen], weight[seen])
    return model


def log_count_ratios(found: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log((p / |p|) / (q / |q|)) of each bucket, with p and q the smoothed numbers of good and bad rows that have it. Buckets that no row has get 0."""
    counted = np.zeros((2, 1 << BITS))
    for at, label in zip(found, y):
        counted[label, at] += 1
    p, q = counted[1] + SMOOTHING, counted[0] + SMOOTHING
    ratios = np.log(p / p.sum()) - np.log(q / q.sum())
    return np.where(counted.any(axis=0), ratios, 0.0).astype(np.float32)


def hinge(found: list[np.ndarray], y: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """(weights, bias) of least half the squared weights plus penalties times hinge losses, by dual coordinate descent. Rows are the ratios of their
    buckets, of unit length, and a constant 1. Each class bears half of the penalty."""
    rows = []
    for at in found:
        x = ratios[at].astype(np.float64)
        rows.append(x / max(np.sqrt(np.square(x).sum()), 1e-12))
    sign = np.where(y > 0, 1.0, -1.0)
    most = PENALTY * len(y) / 2 / np.where(y > 0, max((y > 0).sum(), 1), max((y <= 0).sum(), 1))
    curve = np.array([x @ x + 1.0 for x in rows])
    alpha, w, bias = np.zeros(len(y)), np.zeros(len(ratios)), 0.0
    rng = np.random.default_rng(3)
    for _ in range(EPOCHS):
        high, low = -np.inf, np.inf
        for i in rng.permutation(len(y)):
            at, x = found[i], rows[i]
            gradient = sign[i] * (w[at] @ x + bias) - 1
            moved = min(gradient, 0.0) if alpha[i] <= 0 else max(gradient, 0.0) if alpha[i] >= most[i] else gradient
            high, low = max(high, moved), min(low, moved)
            if moved:
                new = min(max(alpha[i] - gradient / curve[i], 0.0), most[i])
                step = (new - alpha[i]) * sign[i]
                w[at] += step * x
                bias += step
                alpha[i] = new
        if high - low <= GAP:
            break
    return w.astype(np.float32), float(bias)


def logistic(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic curve of y over margins, by Newton's method with a weak ridge, as the classes may be separable."""
    a, b = 1.0, 0.0
    weight = weight / weight.sum() * len(y)
    for _ in range(80):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        v = weight * p * (1 - p) + 1e-9
        g = np.array([(weight * margins * (p - y)).sum() + 0.01 * a, (weight * (p - y)).sum() + 0.01 * b])
        h = np.array([[(v * margins * margins).sum() + 0.01, (v * margins).sum()], [(v * margins).sum(), v.sum() + 0.01]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -2, 2)
    return (float(a), float(b)) if a > 0 else (0.0, float(b))


def quality_scores(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """df's columns but the text, with score (0..1, higher is better) and predicted (1 if score >= threshold).

    A null, empty or blank text has no n-grams and the score of the bias. Only the text decides, so equal texts get equal results; repeated rows stay. A
    column of df with the name of a result is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        model, kind = shared.value, kinds()

        def apply(texts):
            scores = [model.score(model.margin(features(t, kind))) for t in texts]
            return [scores, [int(s >= threshold) for s in scores]]

        return apply

    return with_texts(df, text, "score double, predicted int", start)
