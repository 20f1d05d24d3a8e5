"""Small tables kept by name (models, prompts, books), step log, and providers for what needs a model."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

# What makes a provider's error final, and the retry policy.
FATAL = (
    "insufficient balance", "no resource package", "please recharge", "invalid api key", "incorrect api key", "authentication", "unauthorized",
    "permission denied", 'code":"1113', 'code": "1113',
)
ATTEMPTS, FIRST_PAUSE = 3, 2.0


def added(table: DataFrame, row: dict, key: str = "name") -> DataFrame:
    """table with one more row; a key that is there already raises."""
    if not table.filter(F.col(key) == row[key]).isEmpty():
        raise ValueError(f"there already: {row[key]}")
    return table.unionByName(table.sparkSession.createDataFrame([row], table.schema))


def prompt_row(name: str, description: str, text: str) -> dict:
    now = time.strftime("%Y-%m-%dT%H:%M:%S")
    return {"id": str(uuid.uuid4()), "name": name, "description": description, "text": text, "created_at": now, "updated_at": now}


def updated(table: DataFrame, key: str, value: str, **changes: str) -> DataFrame:
    hit = F.col(key) == value
    if "updated_at" in table.columns:
        changes = {"updated_at": time.strftime("%Y-%m-%dT%H:%M:%S")} | changes
    return table.select(*[F.when(hit, F.lit(changes[c])).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in table.columns])


def removed(table: DataFrame, key: str, value: str) -> DataFrame:
    return table.filter(~(F.col(key) == value))


def priced(log: DataFrame, models: DataFrame) -> DataFrame:
    """log (model, prompt_tokens, completion_tokens) with cost and unpriced, by models (name, input_price, output_price)."""
    prices = models.select(F.col("name").alias("model"), "input_price", "output_price")
    d = log.join(prices, "model", "left")
    cost = T.token_cost(F.col("prompt_tokens"), F.col("completion_tokens"), F.col("input_price"), F.col("output_price"))
    return d.withColumn("cost", F.coalesce(cost, F.lit(0.0))).withColumn("unpriced", cost.isNull()).drop("input_price", "output_price")


def is_fatal(message: str) -> bool:
    return any(x in message.lower() for x in FATAL)


def asked(call: Callable[[str], str], text: str, pause: float = FIRST_PAUSE) -> tuple[str | None, str | None]:
    """(answer, error): call is tried ATTEMPTS times with doubled pauses; a fatal error is not tried again, and an empty answer is one."""
    error = None
    for k in range(ATTEMPTS):
        try:
            answer = call(text)
            return (answer, None) if answer else (None, "empty answer")
        except Exception as e:  # noqa: BLE001 - whatever a provider raises becomes the row's error
            error = str(e)
            if is_fatal(error):
                break
            if k + 1 < ATTEMPTS:
                time.sleep(pause * 2**k)
    return None, error


def answers(requests: DataFrame, call: Callable[[str], str], prompt: str = "prompt", pause: float = FIRST_PAUSE) -> DataFrame:
    """requests with answer and error. Errors are data: a row that fails does not end the run.

    Each use of the result asks again; answer_log.answered() asks once.
    """

    @F.pandas_udf("answer string, error string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([asked(call, t, pause) for t in texts], columns=["answer", "error"])

    return requests.withColumn("_r", run(prompt)).select(*requests.columns, "_r.*")


def image_tags(pages: DataFrame, around: int = 500) -> DataFrame:
    """(book_name, file, image_no, tag, context) of the tags [IMAGE_n] of pages: the text of so many characters on both sides."""
    each = pages.select("book_name", "file", "text", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\[IMAGE_(\d+)\]"), F.lit(1)))).alias("n"))
    d = each.withColumn("tag", F.concat(F.lit("[IMAGE_"), F.col("n"), F.lit("]"))).withColumn("at", F.position("tag", "text"))
    start = F.greatest(F.col("at") - around, F.lit(1))
    length = F.col("at") - start + F.length("tag") + around
    return d.select("book_name", "file", F.col("n").cast("int").alias("image_no"), "tag", F.substr("text", start, length).alias("context"))


def with_boxes(tags: DataFrame, boxes: DataFrame) -> DataFrame:
    """tags joined to boxes (book_name, file, answer), a model's JSON; a tag without a box is dropped."""
    parsed = boxes.select("book_name", "file", F.explode(T.parse_boxes(F.col("answer"))).alias("key", "box"))
    return tags.withColumn("key", F.concat(F.lit("IMAGE_"), F.col("image_no").cast("string"))).join(parsed, ["book_name", "file", "key"]).drop("key")


def step_totals(log: DataFrame) -> DataFrame:
    """Calls, seconds and tokens by book and step, by book, and in all."""
    return log.rollup("book_name", "step").agg(F.count("*").alias("calls"), F.sum("seconds").alias("seconds"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"))
