"""Jobs that report on errors: rankings and totals as CSV, and the images concerned with captioned boxes.

Ground truth is drawn in green, detections in red, of a class that is not asked for in orange; captions name the
class and, for detections, the confidence. Pictures are PNG files, named so that the worst come last in a listing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.functions import imaging
from boxloom.functions import labels as L
from boxloom.functions import text as X
from boxloom.functions.session import cut
from boxloom.jobs import named, pixels_of, sides
from boxloom.operators import curation as C
from boxloom.operators import decisions as D
from boxloom.operators import matching as M
from boxloom.operators import metrics as K
from boxloom.sources import dataset, external, files, sinks

CORNERS = ("x1", "y1", "x2", "y2")
SUMS = ("missed", "spurious", "loose_box", "wrong_class")


def captions(gt: DataFrame, pred: DataFrame, names: dict[int, str] | None = None, only: int | None = None) -> DataFrame:
    """(image_id, boxes): what ``imaging.drawn`` draws of each image."""
    pairs = F.create_map(*[F.lit(x) for kv in (names or {-1: ""}).items() for x in kv])
    name = F.coalesce(F.try_element_at(pairs, F.col("cls")), F.concat(F.lit("class_"), F.col("cls").cast("string")))
    kind = F.lit("pred") if only is None else F.when(F.col("cls") == only, "pred").otherwise("other")
    a = gt.select("image_id", F.lit("gt").alias("kind"), *CORNERS, F.concat(F.lit("gt "), name).alias("caption"))
    b = pred.select("image_id", kind.alias("kind"), *CORNERS, F.concat(name, F.lit(" "), X.fixed(F.col("conf"), 2)).alias("caption"))
    return a.unionByName(b).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("kind", *CORNERS, "caption"))).alias("boxes"))


def _names(spark: SparkSession, images: str) -> DataFrame:
    """(image_id, image, path): the file of each image."""
    return files.images(spark, images).select(F.col("stem").alias("image_id"), F.col("name").alias("image"), "path")


def _draw(spark: SparkSession, images: str, chosen: DataFrame, boxes: DataFrame, out: str) -> None:
    """Writes the images of ``chosen`` (image_id, target) with their ``boxes`` as files; what cannot be read is left out."""
    decoded = pixels_of(spark, images).withColumn("image_id", X.stem(F.col("name"))).drop("name")
    made = decoded.join(chosen, "image_id").join(boxes, "image_id", "left").select(F.col("target").alias("name"), imaging.drawn("data", "height", "width", "channels", "boxes").alias("content"))
    sinks.write_files(made.where("content IS NOT NULL"), out)


def _tag(*parts: tuple[str, str]) -> Column:
    """How a picture's name begins: the badness in five places, then counts."""
    counts = [F.format_string(f"{letter}%d", column) for letter, column in parts]
    return F.concat(F.format_string("%05.1f", F.col("badness").cast("double")), F.lit("_"), F.concat_ws("_", *counts), F.lit("_"), F.regexp_replace("image", r"\.[^.]+$", ""), F.lit(".png"))


def _one_decimal(rows: DataFrame) -> DataFrame:
    return rows.withColumn("badness", X.fixed(F.col("badness").cast("double"), 1))


def bad_predictions(spark: SparkSession, top: int = 100, out: str | None = None, names: dict[int, str] | None = None, least: int = 1, **where) -> DataFrame:
    """The images with the worst detections; with ``out`` also their CSV, the images and overlays of them."""
    gt, pred = sides(spark, **where)
    worst = M.image_errors(gt, pred).where(F.col("badness") >= least).orderBy(F.desc("badness"), "image_id").limit(top)
    if out is None:
        return worst
    worst = cut(worst)
    files_ = worst.join(_names(spark, where["images"]), "image_id")
    sinks.write_csv(files_.orderBy(F.desc("badness"), "image").select("image", "badness", "false_neg", "false_pos", "class_mismatch", "n_gt", "n_pred"), f"{out}/bad_predictions")
    dataset.save_files(files_.select(F.concat(F.lit("images/"), "image").alias("name"), F.lit(None).cast("binary").alias("content"), F.col("path").alias("source")), out)
    _draw(spark, where["images"], files_.select("image_id", F.concat(F.lit("overlays/"), "image_id", F.lit(".png")).alias("target")), captions(gt, pred, names), out)
    return worst.orderBy(F.desc("badness"), "image_id")


def totals(errors: DataFrame, n_gt: str, n_pred: str) -> DataFrame:
    """(what, n, pct): images, images with an error, boxes, and each kind of error with its share of the boxes."""
    one = errors.agg(F.count("*").alias("images"), F.count_if(F.col("badness") > 0).alias("with_error"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (n_gt, n_pred, *SUMS)])
    each = F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).cast("long").alias("n")) for c in ("images", "with_error", n_gt, n_pred, *SUMS)])
    pct = F.when(F.col("x.what").isin(*SUMS), F.round(100.0 * F.col("x.n") / F.greatest(F.lit(1), F.col(n_gt)), 2))
    return one.select(n_gt, F.explode(each).alias("x")).select("x.what", "x.n", pct.alias("pct"))


def plate_errors(spark: SparkSession, top: int = 300, out: str | None = None, names: dict[int, str] | None = None, target: int = 4, split_by_type: bool = False, **where) -> DataFrame:
    """The images with the worst errors of one class; with ``out`` the CSV of all of them, totals and overlays of the worst.

    With ``split_by_type`` overlays lie in folders: missed, else wrong_class, else spurious, else loose_box.
    """
    gt, pred = sides(spark, **where)
    errors = M.plate_errors(gt, pred, target)
    if out is None:
        return errors.where("badness > 0").orderBy(F.desc("badness"), F.desc("missed"), "image_id").limit(top)
    errors = cut(errors)
    order = (F.desc("badness"), F.desc("missed"), "image_id")
    bad = errors.where("badness > 0")
    files_ = bad.join(_names(spark, where["images"]), "image_id")
    sinks.write_csv(_one_decimal(files_.orderBy(*order)).select("image", "badness", "missed", "spurious", "loose_box", "wrong_class", "gt_plates", "pred_plates"), f"{out}/plate_errors")
    sinks.write_csv(totals(errors, "gt_plates", "pred_plates"), f"{out}/totals")
    worst = cut(bad.orderBy(*order).limit(top))
    kind = F.when(F.col("missed") > 0, "missed/").when(F.col("wrong_class") > 0, "wrong_class/").when(F.col("spurious") > 0, "spurious/").otherwise("loose_box/")
    name = F.concat(kind if split_by_type else F.lit(""), _tag(("m", "missed"), ("s", "spurious"), ("l", "loose_box"), ("w", "wrong_class")))
    chosen = worst.join(_names(spark, where["images"]), "image_id").select("image_id", F.concat(F.lit("overlays/"), name).alias("target"))
    _draw(spark, where["images"], chosen, captions(gt.where(F.col("cls") == target), pred, names, target), out)
    return worst.orderBy(*order)


def review(spark: SparkSession, sample: int = 200, out: str | None = None, names: dict[int, str] | None = None, **where) -> DataFrame:
    """A sample of images with their errors, the worst first; with ``out`` also CSV, totals and overlays, bad and good apart."""
    gt, pred = sides(spark, **where)
    ranked = M.ranked_review(M.review(gt, pred), sample)
    if out is None:
        return ranked.orderBy("place")
    ranked = cut(ranked)
    files_ = ranked.join(_names(spark, where["images"]), "image_id")
    sinks.write_csv(_one_decimal(files_.orderBy("place")).select("image", "badness", "missed", "spurious", "wrong_class", "loose_box", "gt_boxes", "pred_boxes"), f"{out}/review_sample")
    sinks.write_csv(totals(ranked, "gt_boxes", "pred_boxes"), f"{out}/totals")
    bad = F.concat(F.lit("bad/"), _tag(("m", "missed"), ("s", "spurious"), ("w", "wrong_class"), ("l", "loose_box")))
    target = F.when(F.col("badness") > 0, bad).otherwise(F.concat(F.lit("good/"), "image_id", F.lit(".png")))
    _draw(spark, where["images"], files_.select("image_id", target.alias("target")), captions(gt, pred, names), out)
    return ranked.orderBy("place")


def infer_draw(spark: SparkSession, images: str, out: str, model: str, sample: int = 100, seed: int = 42, conf: float = 0.25, overlap: float = 0.45, names: dict[int, str] | None = None) -> DataFrame:
    """Draws what a model finds in a seeded sample of images; counts boxes by class."""
    picked = cut(C.sample_by_hash(files.sorted_images(spark, images).select("name", "stem"), "name", sample, seed))
    rows = files.images(spark, images).join(picked.select("name"), "name", "left_semi").select(F.col("stem").alias("image_id"), "content")
    found = cut(D.suppress(external.detect(rows, named(model), "image_id"), conf, overlap))
    chosen = picked.select(F.col("stem").alias("image_id"), F.concat("stem", F.lit(".png")).alias("target"))
    _draw(spark, images, chosen, captions(found.limit(0), found, names), out)
    return found.groupBy("cls").agg(F.count("*").alias("boxes")).orderBy("cls")


def distribution(spark: SparkSession, labels: str, version: int = 1) -> DataFrame:
    """Boxes and images of each class and a row for the total; percentages are of all label files, empty ones included."""
    lines = L.parse(files.label_lines(spark, labels)).withColumnRenamed("stem", "image_id")
    every, boxes = lines.select("image_id").distinct(), lines.where(L.class_only())
    each = K.class_distribution(boxes, version, every)
    total = K.class_totals(boxes, every).where("is_total").select(F.lit(None).cast("int").alias("cls"), F.lit("TOTAL").alias("name"), "boxes", "images", F.lit(None).cast("double").alias("image_pct"))
    rows = each.unionByName(total).orderBy(F.col("cls").asc_nulls_last())
    return rows.withColumn("cls", F.coalesce(F.col("cls").cast("string"), F.lit("")))
