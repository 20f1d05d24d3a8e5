"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of the lower-cased text, weighted by their relative frequency and by an inverse document
frequency. Training is follow-the-regularised-leader (proximal) with L1 and L2 penalties for each coordinate; a temperature,
fitted on a part of the sample that the weights have not seen, calibrates the probabilities. Relative frequencies make the
score of a text the mean over its n-grams of one table row, so prediction is one lookup for each n-gram.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import kept_fold, sampled, with_texts

UNDETERMINED = "und"
ROWS_PER_LANGUAGE = 1200  # rows to learn from, about: the bound of the labelled sample
ORDERS = (1, 2, 3)
BITS = 17
SCALE = 60.0
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 1e-3
EPOCHS = 3
CALIBRATION = 5  # one in so many sample rows is kept for the temperature
BATCH_CHARS = 500_000
# Odd multipliers of the n-gram hash.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket x language: weight times inverse document frequency
    bias: np.ndarray
    temperature: float = 1.0


def buckets(points: np.ndarray, order: int) -> np.ndarray:
    """The bucket of each n-gram of that order."""
    n = len(points) - order + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    mixed = np.full(n, order, np.uint32)
    for k in range(order):
        mixed = (mixed ^ points[k : k + n]) * np.uint32(MULTIPLIERS[k])
        mixed ^= mixed >> np.uint32(15)
    return mixed >> np.uint32(32 - BITS)


def points_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of white space as one blank, with a blank at both ends."""
    return np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "replace"), np.uint32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def sample(docs: DataFrame, rows: int) -> DataFrame:
    """(lang, text): about rows documents of each language, chosen by a hash of id and text, outside the held-out fold. Rows that repeat one another are one."""
    known = docs.filter("lang is not null and text is not null").filter(~kept_fold("doc_id"))
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return known.select("lang", "text")
    share: Column = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, rows / n))) for k, n in sizes.items()])
    return known.filter(sampled(F.xxhash64("doc_id", "text"), share)).select("lang", "text").dropDuplicates()


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Learns from about rows_per_language labelled rows of each language: their n-gram counts, not their texts, come here."""

    def start():
        def apply(texts):
            keys, counts = [], []
            for text in texts:
                points = points_of(text)
                key, count = np.unique(np.concatenate([buckets(points, k) for k in ORDERS]), return_counts=True)
                keys.append(key.astype(np.int32))
                counts.append(count.astype(np.float32))
            return [keys, counts]

        return apply

    rows = with_texts(sample(docs, rows_per_language), "text", "keys array<int>, counts array<float>", start).toArrow()
    langs = rows.column("lang").to_pylist()
    keys = [np.asarray(x.values, np.int64) for x in rows.column("keys")]
    counts = [np.asarray(x.values, np.float64) for x in rows.column("counts")]
    return train(langs, keys, counts)


def train(langs: list[str], keys: list[np.ndarray], counts: list[np.ndarray]) -> Model:
    languages = sorted(set(langs))
    width = len(languages)
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    seen = np.zeros(1 << BITS)
    for k in keys:
        seen[k] += 1
    idf = np.log((1 + len(keys)) / (1 + seen)) + 1
    y = np.array([languages.index(x) for x in langs])
    x = [c / c.sum() * idf[k] * SCALE for k, c in zip(keys, counts)]
    order = np.random.default_rng(7).permutation(len(keys))
    held = order[::CALIBRATION] if len(order) >= 10 * CALIBRATION else order[:0]
    used = np.setdiff1d(order, held, assume_unique=True)
    # The last row is the bias. z and n are the sums that the regularised leader follows.
    z = np.zeros((len(seen) + 1, width))
    n = np.zeros((len(seen) + 1, width))
    last = len(seen)

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        penalty = np.where(at == last, 0.0, L1)[:, None]
        return np.where(np.abs(zi) <= penalty, 0.0, -(zi - np.sign(zi) * penalty) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    rng = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for i in rng.permutation(used):
            at = np.append(keys[i], last)
            value = np.append(x[i], 1.0)
            w = weights(at)
            p = softmax(value @ w)
            p[y[i]] -= 1
            g = value[:, None] * p
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
            n[at] = new
    final = weights(np.arange(last + 1))
    model = Model(languages, (final[:-1] * idf[:, None] * SCALE).astype(np.float32), final[-1])
    if len(held):
        scores = np.array([(counts[i] / counts[i].sum()) @ model.table[keys[i]] + model.bias for i in held])
        model.temperature = best_temperature(scores, y[held])
    return model


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def best_temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden section on its logarithm between 0.05 and 20."""

    def loss(log_t: float) -> float:
        return -np.log(softmax(scores / np.exp(log_t))[np.arange(len(y)), y] + 1e-12).mean()

    low, high, g = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The language and its probability for each text."""
    names = [UNDETERMINED] * len(texts)
    scores = np.zeros(len(texts))
    if not model.languages:
        return names, scores
    wanted = [i for i, t in enumerate(texts) if t and has_letter(t)]
    for i in wanted:
        points = points_of(texts[i])
        total = np.zeros(len(model.languages))
        count = 0
        for at in range(0, len(points), BATCH_CHARS):
            part = points[at : at + BATCH_CHARS + ORDERS[-1] - 1]
            for k in ORDERS:
                # an n-gram that begins in the next part is counted there
                found = buckets(part, k)[:BATCH_CHARS]
                total += np.take(model.table, found, axis=0).sum(axis=0, dtype=np.float64)
                count += len(found)
        p = softmax((total / max(count, 1) + model.bias) / model.temperature)
        best = int(p.argmax())
        names[i], scores[i] = model.languages[best], p[best]
    return names, scores


def languages(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """df's columns but the text, with lang_pred (und for a null text or one without a letter) and score, its probability. Of languages with one
    probability the first by name is taken.

    The score of und is 0. Only the text decides, so equal texts get equal results; repeated rows stay. A column of df with the
    name of a result is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        return lambda texts: list(predict(model, texts))

    return with_texts(df, text, "lang_pred string, score double", start)
