"""Toxic passages as maximal-scoring segments of word log-odds, calibrated by extreme-value statistics.

Each word scores the log-odds of toxic against clean documents, under Dirichlet priors in two levels: the prior of a word is
the share of toxic-only words among those with its first letters, and the prior of that share is the share among all words. Words without evidence score
-DRIFT. The linear-time scan for all maximal-scoring segments finds the passages. A segment of score s in a text of n words
is expected K n exp(-lambda s) times in clean text; lambda and K are those of the clean sample's word scores. The negative
log p-values of the significant segments add up to the document's evidence, which a logistic curve maps to 0..1.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import kept_fold, reliable, sampled, with_texts

MAX_TOXIC, MAX_CLEAN = 4000, 16000  # rows to learn from, about: the bound of the labelled sample
MINIMA = 4
BROADCAST_STEMS = 200_000
STEM = 4
PRIOR = 2.0
LEAST = 3.0
DRIFT = 0.25
SIGNIFICANT = 0.05
THRESHOLD = 0.3
_WORD = re.compile(r"\w+")


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)  # log-odds; 0 where a known word has no evidence but its stem has
    stems: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0  # lambda
    factor: float = 1.0  # K
    slope: float = 0.0
    offset: float = -20.0

    def hits(self, text: str) -> tuple[int, list[tuple[int, float]]]:
        """The number of words, and (position, log-odds) of those with evidence."""
        words = _WORD.findall(text.lower())
        heads, own, stems = self.heads, self.words, self.stems
        found = []
        for i in [i for i, w in enumerate(words) if w[:STEM] in heads]:
            score = own.get(words[i])
            if score is None:
                score = stems.get(words[i][:STEM], 0.0)
            if score > 0:
                found.append((i, score))
        return len(words), found

    @property
    def heads(self) -> set[str]:
        if "_heads" not in self.__dict__:
            self._heads = {w[:STEM] for w in self.words} | set(self.stems)
        return self._heads

    def passages(self, n: int, found: list[tuple[int, float]]) -> list[tuple[int, int, float, float]]:
        """(first word, last word, score, p-value) of each significant segment."""
        out = []
        for first, last, score in segments(found, DRIFT):
            p = -np.expm1(-self.factor * n * np.exp(-self.rate * score))
            if p <= SIGNIFICANT:
                out.append((first, last, score, float(max(p, 1e-300))))
        return out

    def score(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * evidence + self.offset, -500, 500))))


def evidence(passages: list[tuple[int, int, float, float]]) -> float:
    return float(-sum(np.log(p) for *_, p in passages))


def segments(found: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of a sequence that scores -drift but at the positions found.

    One pass; each candidate remembers the nearest earlier one with a smaller sum before it, so that the search behind a new
    candidate skips what was ruled out."""
    firsts, lasts, before, after, smaller = [], [], [], [], []
    total, at = 0.0, 0
    for position, score in found:
        low = total - drift * (position - at)
        total, at = low + score, position + 1
        first, last, lo, hi = position, position, low, total
        while True:
            j = len(firsts) - 1
            while j >= 0 and before[j] >= lo:
                j = smaller[j]
            if j < 0 or after[j] >= hi:
                break
            first, lo = firsts[j], before[j]
            for x in (firsts, lasts, before, after, smaller):
                del x[j:]
        for x, value in zip((firsts, lasts, before, after, smaller), (first, last, lo, hi, j)):
            x.append(value)
    return [(a, b, hi - lo) for a, b, lo, hi in zip(firsts, lasts, before, after)]


def labelled_sample(docs: DataFrame, labels: DataFrame, max_toxic: int, max_clean: int) -> DataFrame:
    """(text, toxic) of labelled documents outside the held-out fold: by a hash of the id, about as many as the bounds. An id has one text, that of the least hash."""
    own = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = own.filter(~kept_fold("doc_id"))
    sizes = {r.toxic: r["count"] for r in own.groupBy("toxic").count().collect()}
    share = F.coalesce(*[F.when(F.col("toxic") == t, F.lit(min(1.0, (max_toxic if t else max_clean) / n))) for t, n in sizes.items()], F.lit(0.0))
    chosen = own.filter(sampled(F.xxhash64("doc_id"), share))
    # The number of ids chosen is bounded by the parameters, so they can be broadcast.
    found = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """Learns from at most about max_toxic and max_clean labelled rows. Documents that share their MINIMA least word hashes (copies and
    most near copies) count once, by the text of the least hash."""
    sample = labelled_sample(docs, labels, max_toxic, max_clean)

    def minima():
        digest = xxhash.xxh64_intdigest
        return lambda texts: [[digest(str(sorted(map(digest, set(_WORD.findall(t.lower()))))[:MINIMA])) >> 1 for t in texts]]

    def start():
        return lambda texts: [[sorted(set(_WORD.findall(t.lower()))) for t in texts]]

    texts = reliable(sample.dropDuplicates().withColumn("own", F.xxhash64("text")))
    # Only hashes are grouped; as many rows as the sample has at most come back, so they can be broadcast.
    kept = with_texts(texts, "text", "least long", minima).groupBy("least", "toxic").agg(F.min("own").alias("own")).select("own", "toxic")
    bags = with_texts(texts.join(F.broadcast(kept.distinct()), ["own", "toxic"], "left_semi"), "text", "words array<string>", start)
    counts = bags.select(F.explode("words").alias("word"), "toxic").groupBy("word").agg(
        F.sum("toxic").cast("double").alias("pos"), F.sum(1 - F.col("toxic")).cast("double").alias("neg")
    )
    counts = reliable(counts.withColumn("stem", F.substring("word", 1, STEM)))
    base = counts.agg(
        F.sum(F.when(F.col("neg") == 0, 1.0).otherwise(0.0)).alias("tp"), F.count("*").alias("types"),
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
    ).first()
    if not base.types or not base.pos or not base.neg:
        return Model()
    kind = (base.tp + 0.5) / (base.types + 1)  # the share of the words that occur in toxic texts alone
    kinds = counts.groupBy("stem").agg(F.sum(F.when(F.col("neg") == 0, 1.0).otherwise(0.0)).alias("tp"), F.count("*").alias("types"))
    share = (F.col("tp") + PRIOR * kind) / (F.col("types") + PRIOR)
    kinds = kinds.select("stem", share.alias("share"), (F.log(share / (1 - share)) - np.log(kind / (1 - kind))).alias("by_stem"))
    mass = base.pos / (base.pos + base.neg)
    prior = F.col("share") / (F.col("share") + (1 - F.col("share")) * (kind / (1 - kind)) * ((1 - mass) / mass))
    by_word = F.log((F.col("pos") + PRIOR * prior) / (F.col("neg") + PRIOR * (1 - prior))) - np.log(mass / (1 - mass))
    kinds = reliable(kinds)
    # Some stems have many words: while they are few, as in any sample of the default bounds, they are sent to the words.
    scored = counts.join(F.broadcast(kinds) if kinds.count() <= BROADCAST_STEMS else kinds, "stem").select("word", "stem", "by_stem", by_word.alias("score"))
    kept = scored.filter((F.col("score") >= LEAST) | (F.col("by_stem") >= LEAST)).collect()
    model = Model()
    for r in kept:
        if r.by_stem >= LEAST:
            model.stems[r.stem] = float(r.by_stem)
        model.words[r.word] = float(r.score) if r.score >= LEAST else 0.0

    def scan():
        def apply(batch):
            found = [model.hits(t) for t in batch]
            return [[n for n, _ in found], [[i for i, _ in h] for _, h in found], [[s for _, s in h] for _, h in found]]

        return apply

    rows = with_texts(texts, "text", "n long, at array<long>, scores array<double>", scan).collect()
    return calibrate(model, rows)


def calibrate(model: Model, rows: list) -> Model:
    """Sets lambda and K from the clean rows, then the logistic curve."""
    clean = [r for r in rows if not r.toxic]
    scores, times = np.unique([round(s, 1) for r in clean for s in r.scores] or [LEAST], return_counts=True)
    total = sum(r.n for r in clean) + 1
    often = (times + 0.5) / total

    def above(rate: float) -> float:
        return (1 - often.sum()) * np.exp(-rate * DRIFT) + (often * np.exp(rate * scores)).sum() - 1

    low, high = 1e-3, 50.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (low, middle) if above(middle) > 0 else (middle, high)
    model.rate = low
    found = [s for r in clean for *_, s in segments(list(zip(r.at, r.scores)), DRIFT)]
    model.factor = float((np.exp(low * np.array(found)).clip(max=1e6).mean() if found else 1.0) * (len(found) + 0.5) / total)
    x = np.array([evidence(model.passages(r.n, list(zip(r.at, r.scores)))) for r in rows])
    y = np.array([r.toxic for r in rows], float)
    scale = max(float(x.max(initial=0)), 1.0)
    x = np.minimum(x, 60.0) / 10
    a, b = 1.0, -2.0
    for _ in range(60):  # Newton's method with a weak ridge, as the classes may be separable
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([(x * (p - y)).sum() + 0.01 * a, (p - y).sum() + 0.01 * b])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = np.array([a, b]) - np.clip(step, -2, 2)
    model.slope, model.offset = (a / 10, b) if a > 0 and scale > 0 else (0.0, -20.0)
    return model


def toxic_scores(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """df's columns but the text, with score (0..1), predicted (1 if score >= threshold) and passages.

    passages: structs of the first and last word of each significant segment, its score and its p-value. A null, empty or wordless
    text has no passage and the lowest score. Repeated rows stay; a column of df with the name of a result is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value

        def apply(texts):
            found = [model.passages(*model.hits(t)) if t else [] for t in texts]
            scores = [model.score(min(evidence(p), 60.0)) for p in found]
            return [scores, [int(s >= threshold) for s in scores], [[dict(zip(("first", "last", "score", "p"), x)) for x in p] for p in found]]

        return apply

    return with_texts(df, text, "score double, predicted int, passages array<struct<first: int, last: int, score: double, p: double>>", start)
