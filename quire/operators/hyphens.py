"""Words broken by a hyphen, decided by the words that the corpus knows: a table of word counts, joined on the spellings with and without the hyphen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

WORD = r"[а-яёa-z]+(?:-[а-яёa-z]+)*-?"
LEAST = 2  # a word that occurs so often is known


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): the words of all texts, in lower case, with their inner hyphens. One that a hyphen ends may be broken and is not counted."""
    words = texts.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD), F.lit(0))).alias("word"))
    return words.filter(~F.col("word").endswith("-")).groupBy("word").agg(F.count("*").alias("n"))


def known_words(texts: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """(word) of those that occur often enough."""
    return word_counts(texts, text).filter(F.col("n") >= least).select("word")


def decisions(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(before, after, keeps) for each different pair of the parts before and after a hyphen, in lower case: whether the hyphen belongs to the word.

    It stays before a particle, in a compound that is known, and between two known words that are no known word together. The pairs meet the words in one join.
    """
    each = pairs.select(F.lower("before").alias("before"), F.lower("after").alias("after")).distinct()
    spellings = F.array(*[
        F.struct(F.lit(role).alias("role"), spelling.alias("word"))
        for role, spelling in (("whole", F.concat("before", "after")), ("compound", F.concat_ws("-", "before", "after")), ("before", F.col("before")), ("after", F.col("after")))
    ])
    asked = each.select("before", "after", F.explode(spellings).alias("s")).select("before", "after", "s.role", "s.word")
    found = asked.join(words.select("word").distinct().withColumn("known", F.lit(True)), "word", "left")
    known = lambda role: F.max(F.when(F.col("role") == role, F.coalesce("known", F.lit(False))))
    seen = found.groupBy("before", "after").agg(*[known(role).alias(f"_{role}") for role in ("whole", "compound", "before", "after")])
    keeps = F.col("after").isin(T.PARTICLES) | F.col("_compound") | (~F.col("_whole") & F.col("_before") & F.col("_after"))
    return seen.select("before", "after", keeps.alias("keeps"))
