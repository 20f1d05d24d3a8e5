"""The training-data pipeline: STAGES are applied in turn to documents, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import language, mixing, sentencepiece, simhash, toxicity
from quire.llm.common import shared_folder, table
from quire.llm.queries import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_LANGUAGE_SCORE = 0.4
WIDTH, SIMILARITY = 5, 0.8


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is predicted go. The labels of sf_dir and the texts of docs are learnt from. Null, empty and wordless texts have no passage and
    stay, repeated rows are judged alike, rows without an id are judged and not learnt from; without labels of both kinds all documents stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.toxic_scores(docs.withColumn("_scored", F.col("text")), model, "_scored")
    return scored.filter("predicted = 0").select(*COLUMNS)


def reject_undetermined(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose text is null or has no letter, or whose language has a calibrated probability below LEAST_LANGUAGE_SCORE. Repeated rows are judged
    alike; where no document has a language to learn from, all go as undetermined."""
    found = language.languages(docs.withColumn("_read", F.col("text")), language.fit(docs), "_read")
    return found.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, those without an id last. Texts without words are one group; of repeated rows one stays."""
    return simhash.representatives(docs, width=WIDTH, similarity=SIMILARITY).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes taken / size times, where the mix takes that many of its words: the whole part always, the rest by a draw from a hash of its id, so
    the words of each source follow its target in expectation. Rows of one source with one id, or without one, have their common ratio. Rows without words
    are no part of a mix by words and go."""
    taken = mixing.mixed(docs).filter("size > 0").groupBy(F.col("doc_id").alias("of"), F.col("source").alias("within")).agg((F.sum("taken") / F.sum("size")).alias("times"))
    joined = docs.join(taken.filter("times > 0"), F.col("doc_id").eqNullSafe(F.col("of")) & F.col("source").cast("string").eqNullSafe(F.col("within")))
    # Rows without an id draw by their text.
    drawn = F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")), F.lit(9)), F.lit(1 << 30)) / (1 << 30)
    repeats = F.floor(F.col("times") + drawn).cast("int")
    return joined.withColumn("_repeats", repeats).filter("_repeats > 0").select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("_repeats"))).alias("_copy")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_pieces, exact) of every row; a null or empty text has no ids and is exact."""
    return sentencepiece.encoded(docs.drop("n_chars"), tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", reject_toxic),
    ("language ID", reject_undetermined),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("SentencePiece", encode),
]
ORACLE_SQL = None  # models, fingerprints and the mix cannot be expressed there; tests/llm/test_pipeline.py has a brute-force version


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents of sf_dir. The tables between them lie in the shared folder; each goes when the next one is written, and the last one, which
    the result reads, stays."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/quire-pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            remove(spark, f"{folder}/{number - 1}")
    return docs
