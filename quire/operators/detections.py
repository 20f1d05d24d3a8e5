"""Boxes that a detector found on pages: overlapping ones suppressed, crops with a margin, file names, and the state that a run resumes from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The least confidence, the overlap from which the weaker box goes, the margin of a crop, and the class that has a folder of its own.
CONFIDENCE, OVERLAP, MARGIN, TABLE = 0.25, 0.7, 5, "table"
PAGE = ["book_name", "page_stem"]
BOX = "struct<det_idx: int, class_id: int, class_name: string, confidence: double, bbox: array<int>>"


def area(box: Column) -> Column:
    side = lambda a, b: F.greatest(F.get(box, b) - F.get(box, a), F.lit(0)).cast("long")
    return side(0, 2) * side(1, 3)


def overlap(one: Column, two: Column) -> Column:
    """The shared area of two boxes [x1, y1, x2, y2] over the area of both together; 0 if neither has one."""
    side = lambda a, b: F.greatest(F.least(F.get(one, b), F.get(two, b)) - F.greatest(F.get(one, a), F.get(two, a)), F.lit(0)).cast("long")
    shared = side(0, 2) * side(1, 3)
    both = area(one) + area(two) - shared
    return F.when(both > 0, shared / both).otherwise(F.lit(0.0))


def suppressed(found: DataFrame, least: float = CONFIDENCE, most: float = OVERLAP, across: bool = False) -> DataFrame:
    """found (book_name, page_stem, det_idx, class_id, class_name, confidence, bbox) without weak boxes, and without those that overlap a stronger one that stays
    by more than most, of their class or (across) of any. Of equal confidence the smaller det_idx is stronger.

    The boxes of one page and class are one array, which a fold walks through; the boxes that a detector gives for a page are few.
    """
    kept_if = F.col("confidence") >= least
    box = F.struct("det_idx", "class_id", "class_name", "confidence", "bbox").cast(BOX)
    key = F.struct((-F.col("confidence")).alias("a"), F.col("det_idx").alias("b"), box.alias("box"))
    groups = found.filter(kept_if).groupBy(*PAGE, *([] if across else ["class_id"])).agg(F.transform(F.array_sort(F.collect_list(key)), lambda x: x.box).alias("boxes"))
    stays = lambda kept, b: ~F.exists(kept, lambda k: overlap(k.bbox, b.bbox) > most)
    kept = F.aggregate("boxes", F.array().cast(f"array<{BOX}>"), lambda acc, b: F.when(stays(acc, b), F.concat(acc, F.array(b))).otherwise(acc))
    return groups.select(*PAGE, F.explode(kept).alias("k")).select(*PAGE, "k.*")


def crops(found: DataFrame, sizes: DataFrame, margin: int = MARGIN) -> DataFrame:
    """found with n (1, 2... on its page, the strongest first), folder, name and crop (left, top, right, bottom) within the page's image by sizes (book_name, page_stem,
    width, height). Boxes without any area in the image are numbered, but have no row."""
    n = F.row_number().over(Window.partitionBy(*PAGE).orderBy(F.desc("confidence"), "det_idx"))
    d = found.withColumn("n", n).join(sizes.select(*PAGE, "width", "height"), PAGE)
    left, top = (F.greatest(F.lit(0), F.get("bbox", k) - margin) for k in (0, 1))
    right, bottom = F.least("width", F.get("bbox", 2) + margin), F.least("height", F.get("bbox", 3) + margin)
    crop = F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom"))
    folder = F.when(F.col("class_name") == TABLE, "tables").otherwise("figures")
    name = F.concat_ws("_", "page_stem", F.concat(F.col("n").cast("string"), F.lit(".jpg")))
    d = d.withColumn("folder", folder).withColumn("name", name).withColumn("crop", crop).drop("width", "height")
    return d.filter((F.col("crop.right") > F.col("crop.left")) & (F.col("crop.bottom") > F.col("crop.top")))


def unseen(images: DataFrame, state: DataFrame) -> DataFrame:
    """The images (book_name, page_stem, ...) of pages that the state does not have yet; a page without detections is in the state as well."""
    return images.join(state.select(*PAGE).distinct(), PAGE, "left_anti")


def page_states(pages: DataFrame, found: DataFrame) -> DataFrame:
    """(book_name, page_stem, value): the state of each page of pages (book_name, page_stem, page_file, width, height) as JSON, the strongest box first."""
    one = F.struct("class_id", "class_name", F.round("confidence", 4).alias("confidence"), F.col("bbox").alias("bbox_xyxy"))
    boxes = found.groupBy(*PAGE).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("a"), F.col("det_idx").alias("b"), one.alias("d")))), lambda x: x.d).alias("detections"))
    none = F.array().cast("array<struct<class_id: int, class_name: string, confidence: double, bbox_xyxy: array<int>>>")
    d = pages.join(boxes, PAGE, "left").withColumn("detections", F.coalesce("detections", none))
    return d.select(*PAGE, F.to_json(F.struct("page_file", "page_stem", F.array("height", "width").alias("image_shape"), "detections")).alias("value"))


def from_states(states: DataFrame) -> DataFrame:
    """The detections of states (book_name, page_stem, value)."""
    schema = "page_file string, page_stem string, image_shape array<int>, detections array<struct<class_id: int, class_name: string, confidence: double, bbox_xyxy: array<int>>>"
    d = states.select(*PAGE, F.posexplode(F.from_json("value", schema).detections).alias("det_idx", "d"))
    return d.select(*PAGE, "det_idx", "d.class_id", "d.class_name", "d.confidence", F.col("d.bbox_xyxy").alias("bbox"))


def totals(found: DataFrame) -> DataFrame:
    """(book_name, pages, tables, others), and the same over all books with a null name."""
    table = F.col("class_name") == TABLE
    return found.rollup("book_name").agg(F.count_distinct("page_stem").alias("pages"), F.count_if(table).alias("tables"), F.count_if(~table).alias("others"))
