"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer("byte_bpe_50k.json"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.simhash import near_copies

    return near_copies(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.common import kept_fold
    from quire.llm.toxicity import fit, toxic_scores

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxic_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", kept_fold("doc_id").alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.media import text_media

    return text_media(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("tile_sha256", F.sha2("tile", 256)).drop("media", "tile")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.common import kept_fold
    from quire.llm.language import fit, languages

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = languages(docs.drop("lang"), fit(docs))
    return found.select("doc_id", kept_fold("doc_id").alias("held_out"), "lang_pred", "score")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.sentencepiece import encoded

    return encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer("piece_bpe_32k.model"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.sharding import sharded

    return sharded(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.mixing import mixed

    return mixed(table(spark, sf_dir, "documents")).drop("source")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.html_text import main_texts

    return main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.hamming_search import sign_code, top_k

    codes = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), sign_code("embedding").alias("code"))
    found = top_k(codes, codes.filter("id % 20 = 0"), k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.whitening import whitened

    found = whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.resampling import resampled

    return resampled(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.quality import fit, held_out, quality_scores

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    dealt = (
        op3_token_counts, op5_simhash, op7_toxicity, op10_media, op1_language, op4_sentencepiece, op8_shards, op9_mixing, op2_html, op6_topk, op11_whitening, op12_resampling,
        op13_quality,
    )
    return {f.__name__: f for f in dealt}


OP6_SQL = """
select query_id, cast(rank as int) as rank, vec_id, distance from (
  select query_id, vec_id, distance, row_number() over (partition by query_id order by distance, vec_id) as rank from (
    select q.vec_id as query_id, r.vec_id,
      cast(list_sum(list_transform(range(1, 65), lambda i: case when (q.embedding[i] > 0) <> (r.embedding[i] > 0) then 1 else 0 end)) as int) as distance
    from embeddings q join embeddings r on q.vec_id <> r.vec_id where q.vec_id % 20 = 0))
where rank <= 10"""


# The checksum's table by its rule, then checksums of the different features alone.
OP12_SQL = r"""
with recursive table_ as (select list_transform(range(0, 256), lambda n: list_reduce(list_prepend(n, range(0, 8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
 w as (select kind, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
   from (select 'd' as kind, doc_id, text from documents union all select 'b', item_id, text from benchmark)),
 f as (select kind, doc_id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) as f from w),
 own as (select f, hex(f) as h from (select distinct f from f)),
 crc as (select f, xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(range(0, length(h), 2), lambda i: cast(('0x' || substr(h, i + 1, 2)) as bigint))),
   lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 as bucket from own, table_),
 n as (select bucket, count(*) filter (where kind = 'd') as s, count(*) filter (where kind = 'b') as t from f join crc using (f) group by bucket),
 gain as (select bucket, cast(floor(1000 * ln(cast(t + 1 as double) * (sum(s) over () + 10000) / (cast(s + 1 as double) * (sum(t) over () + 10000)))) as bigint) as g from n),
 sums as (select doc_id, cast(floor(sum(g) / cast(count(*) as double)) as bigint) as weight from f join crc using (f) join gain using (bucket) where kind = 'd' group by doc_id),
 scored as (select doc_id, len(ws) as words, cast(case when len(ws) = 0 then 0 else 2 * len(ws) - 1 end as bigint) as n_features, coalesce(weight, 0) as weight,
   coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast(('0x' || substr(sha256('7:' || doc_id), 1, 8)) as bigint) + 0.5e0) / 4294967296))) as bigint) as score from w left join sums using (doc_id) where kind = 'd'),
 placed as (select *, row_number() over (partition by words >= 20 order by score desc, doc_id) as place, count(*) over (partition by words >= 20) as every from scored)
select doc_id, n_features, weight, score, case when words >= 20 and place <= 25 * every // 100 then place end as rank from placed"""


def oracle_sql() -> dict[str, str]:
    """The others need models, hashes or automata that SQL lacks; tests/llm compares them with brute force."""
    return {"op6_topk": OP6_SQL, "op12_resampling": OP12_SQL}
