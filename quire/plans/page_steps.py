"""Pages read by models in three steps: text, boxes of its images, descriptions of these. The models are calls that the user gives; all else is joins.

Each step takes what the step log does not have yet, so that a run resumes, and gives its answers with errors as data. With the folder of a log each answer
is stored before it is used, and asked for once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.plans import answer_log, registry

# The parts of a description's prompt, the caption of an image without one, the sign of an image to leave out, and the context's width.
CAPTION_HEAD, CONTEXT_HEAD, TASK_HEAD = "ОРИГИНАЛЬНАЯ ПОДПИСЬ:", "КОНТЕКСТ ИЗ КНИГИ (вокруг картинки):", "ЗАДАЧА:"
NO_CAPTION, SKIP = "Нет подписи.", "<SKIP>"
AROUND = 500
PAGE = ["book_name", "file"]


def unread(pages: DataFrame, log: DataFrame, step: str) -> DataFrame:
    """The pages without an entry of the step in the log (book_name, file, step, error) that has no error."""
    done = log.filter((F.col("step") == step) & F.col("error").isNull()).select(*PAGE).distinct()
    return pages.join(done, PAGE, "left_anti")


def answered(requests: DataFrame, call: Callable[[str], str], pause: float, log: str | None, step: str, key: str = answer_log.KEY) -> DataFrame:
    return registry.answers(requests, call, pause=pause) if log is None else answer_log.answered(requests, call, log, step, key, pause=pause)


def page_texts(images: DataFrame, call: Callable[[str], str], pause: float = registry.FIRST_PAUSE, log: str | None = None) -> DataFrame:
    """Step 1: (book_name, file, text, error) of page images (book_name, file, content), which call reads in base 64."""
    asked = images.select(*PAGE, F.base64("content").alias("prompt"))
    return answered(asked, call, pause, log, "text").select(*PAGE, F.col("answer").alias("text"), "error")


def image_requests(pages: DataFrame, boxes: DataFrame, sizes: DataFrame, around: int = AROUND) -> DataFrame:
    """Step 2: (book_name, file, image_no, tag, caption, context, crop_name, crop) of the image tags in texts.

    boxes: (book_name, file, answer), a model's JSON of boxes. sizes: (book_name, file, width, height) of the page's image. An image without a box that
    holds anything is left out; the caption is what follows [CAPTION_n] on its line.
    """
    tags = registry.with_boxes(registry.image_tags(pages, around), boxes)
    found = tags.join(pages.select(*PAGE, "text"), PAGE).join(sizes, PAGE)
    crop = T.crop_box(F.col("box"), F.col("width"), F.col("height"))
    name = F.concat(F.regexp_replace("file", r"\.[^.]*\z", ""), F.lit("_image_"), F.col("image_no").cast("string"), F.lit(".jpg"))
    d = found.select(*PAGE, "image_no", "tag", caption_of(F.col("text"), F.col("image_no")).alias("caption"), "context", name.alias("crop_name"), crop.alias("crop"))
    return d.filter("crop is not null")


def caption_of(text: Column, number: Column) -> Column:
    """What stands behind the text's [CAPTION_n], up to the end of the line or the next tag."""
    tag = F.concat(F.lit("[CAPTION_"), number.cast("string"), F.lit("]"))
    at = F.position(tag, text)
    said = T.stripped(F.regexp_extract(F.substr(text, at + F.length(tag)), r"\A\s*(.*?)(?=\n|\[IMAGE_|\[CAPTION_|\z)", 1))
    return F.when(at > 0, said).otherwise(NO_CAPTION)


def description_prompt(caption: Column, context: Column, task: str) -> Column:
    return F.concat(F.lit(CAPTION_HEAD + "\n"), caption, F.lit("\n\n" + CONTEXT_HEAD + "\n"), context, F.lit("\n\n" + TASK_HEAD + "\n" + task))


def descriptions(requests: DataFrame, task: str, call: Callable[[str], str], pause: float = registry.FIRST_PAUSE, log: str | None = None) -> DataFrame:
    """Step 3: requests with description and error. An answer with SKIP in it is no description."""
    asked = requests.withColumn("prompt", description_prompt(F.col("caption"), F.col("context"), task))
    told = answered(asked, call, pause, log, "description", f"{answer_log.KEY}, image_no int")
    return told.withColumn("description", F.when(~F.col("answer").contains(SKIP), F.col("answer"))).drop("prompt", "answer")


def with_descriptions(pages: DataFrame, described: DataFrame) -> DataFrame:
    """(book_name, file, text): the texts, in which the tag of an image that has no row in described goes with its caption.

    described: (book_name, file, image_no).
    """
    kept = described.groupBy(*PAGE).agg(F.collect_set(F.col("image_no").cast("string")).alias("_kept"))
    d = pages.join(kept, PAGE, "left").withColumn("_kept", F.coalesce("_kept", F.array().cast("array<string>")))
    numbers = F.array_distinct(F.regexp_extract_all("text", F.lit(r"\[IMAGE_(\d+)\]"), F.lit(1)))
    gone = F.array_except(numbers, "_kept")
    caption = lambda n: F.concat(F.lit(r"\[CAPTION_"), n, F.lit(r"\]\s*.*?(?=\n|\[IMAGE_|\[CAPTION_|\z)"))
    cut = F.aggregate(gone, F.col("text"), lambda t, n: F.replace(F.regexp_replace(t, caption(n), F.lit("")), F.concat(F.lit("[IMAGE_"), n, F.lit("]")), F.lit("")))
    return d.select(*PAGE, cut.alias("text"))


def contents_texts(images: DataFrame, call: Callable[[str], str], pause: float = registry.FIRST_PAUSE) -> DataFrame:
    """(book_name, file, text, error) of the images of a book's contents: page_texts() with the file named after its image."""
    return page_texts(images, call, pause).withColumn("file", F.concat(F.regexp_replace("file", r"\.[^.]*\z", ""), F.lit(".md")))


def log_rows(results: DataFrame, step: str) -> DataFrame:
    """(book_name, file, step, error) for the step log."""
    return results.select(*PAGE, F.lit(step).alias("step"), "error").distinct()
