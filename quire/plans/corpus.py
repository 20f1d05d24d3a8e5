"""Books made from the driver's documents: structure is planted by expressions that Spark and DuckDB read alike.

A page's number follows from its document's id, so that no text is sorted to number pages; a book has gaps in its numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.sources.shared import scratch  # noqa: F401 - queries name it by this module

NL = "chr(10)"
_BASE = """
select 'Author ' || source || ', Title ' || source as book_name, doc_id, source, text as body, 1 + doc_id + cast(floor(doc_id / 7) as bigint) as page_no
from documents"""

_TEXT = f"""
  case when page_no % 5 = 1 then '# Раздел ' || cast(page_no as string) || ' Общие сведения' || {NL} || {NL}
       when page_no % 2 = 0 then '## 1.' || cast(page_no as string) || '. Тема номер ' || cast(page_no as string) || {NL} || {NL} else '' end
  || body
  || case when doc_id % 4 = 0 then ' (см. табл. ' || cast(page_no as string) || '.1, рис. 7.2, на рисунке 8; таблицей 4 и табл 4)' else '' end
  || case when doc_id % 3 = 0 then {NL} || {NL} || '[TABLE_START]' || {NL} || 'Таблица ' || cast(page_no as string) || '.1 Данные' || {NL} || '| a | b |' || {NL} || '|---|---|' || {NL} || '| ' || cast(doc_id as string) || ' | 1 |' || {NL} || '| x |  |' || {NL} || '[TABLE_END]' else '' end
  || case when doc_id % 7 = 0 then {NL} || {NL} || '<table style="w:1"><caption>Сводка ' || cast(page_no as string) || '</caption><tr><td>' || cast(doc_id as string) || '</td></tr></table>' else '' end
  || case when doc_id % 5 = 1 then {NL} || {NL} || '**Рис. ' || cast(page_no as string) || '.** Схема ' || cast(doc_id as string) || {NL} || {NL} || 'tail' else '' end
  || case when doc_id % 5 = 2 then {NL} || '```html' || {NL} || '<p class="x">k</p>' || {NL} || '```' else '' end
  || case when doc_id % 6 = 3 then ' ' || chr(92) || '[q' || {NL} || 'r' || chr(92) || ']  ' || chr(92) || '(s' || chr(92) || ')......' else '' end
  || case when doc_id % 9 = 2 then {NL} || '### Таблица 1 знак' || {NL} || {NL} || {NL} || {NL} || '[IMAGE_1] xx [IMAGE_2]' else '' end
  || case when doc_id % 8 = 4 then {NL} || ' 42 ' when doc_id % 8 = 5 then ' and so-' else '' end"""

PAGES_SQL = f"""
select book_name, source, doc_id, cast(page_no as int) as page_no, lpad(cast(page_no as string), 9, '0') || '.md' as file, {_TEXT} as text
from ({_BASE}) base"""

# Entries with altered levels; those of every seventh page are missing, and one entry of each book has no page.
TOC_SQL = f"""
select book_name, cast(page_no as bigint) as ord,
  case when page_no % 5 = 1 then 'Раздел ' || cast(page_no as string) || ' Общие сведения ..... ' || cast(page_no as string)
       else '1.' || cast(page_no as string) || '. Тема номер ' || cast(page_no as string) || ' .... 12' end as raw_text,
  cast(case when page_no % 4 = 0 then 3 when page_no % 5 = 1 then 1 else 2 end as int) as level
from ({_BASE}) base where (page_no % 5 = 1 or page_no % 2 = 0) and page_no % 7 <> 3
union all select distinct 'Author ' || source || ', Title ' || source, cast(1000000000000 as bigint), 'Послесловие без страницы', 2 from documents"""


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one in fewer parts than the session has cores (small, or of one row group) is dealt out by its first column, as little of it as is used."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, df.columns[0])


def _planted(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("from documents", "from {documents}"), documents=view(spark, sf_dir, "documents"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_name, source, doc_id, page_no, file, text)."""
    return _planted(spark, sf_dir, PAGES_SQL)


def toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_name, ord, raw_text, level)."""
    return _planted(spark, sf_dir, TOC_SQL)
