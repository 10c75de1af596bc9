"""Class distribution, confusion, precision and recall, average precision.

Cumulative counts over all detections come from a two-phase prefix sum: rows are range-partitioned in rank
order and kept; totals of each range, one row a partition, become offsets; windows run inside ranges only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom.functions.labels import remap
from boxloom.functions.session import Shelf, cut
from boxloom.operators.matching import hits, true_positives

#: The class names of the three versions of the data.
CLASSES = {
    1: ("bike_front", "bike_back", "non_bike_front", "non_bike_back"),
    2: ("bike_front", "bike_back", "non_bike_front", "non_bike_back", "reg_plate"),
    3: ("bike_front", "bike_back", "car_front", "car_back", "other_front", "other_back", "reg_plate"),
}
#: Detections whose bits travel together in average precision: their sums and peaks, a row for so many, meet in one task.
BLOCK = 1 << 16
IOU_STEPS = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]


def class_distribution(boxes: DataFrame, version: int = 1, files: DataFrame | None = None) -> DataFrame:
    """(cls, name, boxes, images, image_pct) of known classes and of those seen.

    Percentages are of all label files in ``files`` (image_id), empty and unreadable ones included; without
    ``files``, of the images in ``boxes``.
    """
    spark = boxes.sparkSession
    known = spark.createDataFrame(list(enumerate(CLASSES[version])), "cls int, name string")
    seen = boxes.where("cls IS NOT NULL").groupBy("cls").agg(F.count("*").alias("boxes"), F.countDistinct("image_id").alias("images"))
    total = boxes.select(F.countDistinct("image_id").alias("n")) if files is None else files.select(F.count("*").alias("n"))
    both = seen.join(F.broadcast(known), "cls", "full")
    return both.join(F.broadcast(total)).select(
        "cls",
        F.coalesce("name", F.concat(F.lit("class_"), F.col("cls"))).alias("name"),
        F.coalesce("boxes", F.lit(0)).alias("boxes"),
        F.coalesce("images", F.lit(0)).alias("images"),
        F.round(100.0 * F.coalesce("images", F.lit(0)) / F.greatest("n", F.lit(1)), 4).alias("image_pct"),
    )


def class_totals(boxes: DataFrame, files: DataFrame) -> DataFrame:
    """(cls, boxes, images, is_total): a row for each class that occurs and a total of all, in one pass by rollup.

    The total's images are all label files in ``files`` (image_id), those without a box included, as in the report.
    """
    # a row for each file, with no class, so that files without boxes take part in the total alone
    both = boxes.where("cls IS NOT NULL").select("image_id", "cls").unionByName(files.select("image_id", F.lit(None).cast("int").alias("cls")))
    rows = both.rollup("cls").agg(F.count("cls").alias("boxes"), F.count_distinct("image_id").alias("images"), (F.grouping("cls") == 1).alias("is_total"))
    return rows.where("is_total OR cls IS NOT NULL")


def file_totals(files: DataFrame, boxes: DataFrame) -> DataFrame:
    """One row: files, boxes, with_boxes, empty (readable, without a box), unreadable of ``files`` (image_id, readable)."""
    per = boxes.groupBy("image_id").agg(F.count("*").alias("n"))
    each = files.join(per, "image_id", "left").select("readable", F.coalesce("n", F.lit(0)).alias("n"))
    return each.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("boxes"),
        F.count_if(F.col("n") > 0).alias("with_boxes"),
        F.count_if(F.col("readable") & (F.col("n") == 0)).alias("empty"),
        F.count_if(~F.col("readable")).alias("unreadable"),
    )


def confusion(matched: DataFrame, n_classes: int = 4) -> DataFrame:
    """(cls, p0.., missed) of the output of ``best_class``; a match of an unknown class counts as missed."""
    known = F.col("pred_cls").between(0, n_classes - 1)
    cells = [F.count_if(F.col("pred_cls") == k).alias(f"p{k}") for k in range(n_classes)]
    missed = F.count_if(F.col("pred_cls").isNull() | ~known).alias("missed")
    got = matched.where(F.col("cls").between(0, n_classes - 1)).groupBy("cls").agg(*cells, missed)
    every = matched.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("cls"))
    return every.join(got, "cls", "left").fillna(0)


def class_accuracy(confused: DataFrame, n_classes: int = 4) -> DataFrame:
    """(cls, gt, found, correct, class_acc, detection): accuracy over found boxes, and the share found."""
    found = sum([F.col(f"p{k}") for k in range(1, n_classes)], F.col("p0"))
    correct = sum([F.when(F.col("cls") == k, F.col(f"p{k}")).otherwise(0) for k in range(1, n_classes)], F.when(F.col("cls") == 0, F.col("p0")).otherwise(0))
    x = confused.select("cls", (found + F.col("missed")).alias("gt"), found.alias("found"), correct.cast("long").alias("correct"))
    return x.withColumn("class_acc", F.round(F.try_divide(100.0 * F.col("correct"), F.col("found")), 4)).withColumn("detection", F.round(F.try_divide(100.0 * F.col("found"), F.col("gt")), 4))


def overall_accuracy(per_class: DataFrame) -> DataFrame:
    """One row over the rows of ``class_accuracy``: gt, found, correct, class_acc, detection."""
    sums = per_class.agg(*[F.sum(c).alias(c) for c in ("gt", "found", "correct")])
    return sums.withColumn("class_acc", F.round(F.try_divide(100.0 * F.col("correct"), F.col("found")), 4)).withColumn("detection", F.round(F.try_divide(100.0 * F.col("found"), F.col("gt")), 4))


def ranked(flags: DataFrame) -> DataFrame:
    """``flags`` with tp_sum and fp_sum so far, by threshold in falling confidence (then image, then index)."""
    order = [F.desc("conf"), "image_id", "det_idx"]
    # kept first: else the matching runs once to sample its ranges and once more to fill them
    rows = cut(cut(flags).repartitionByRange("threshold", *order).withColumn("range", F.spark_partition_id()))
    totals = rows.groupBy("threshold", "range").agg(F.sum(F.col("tp").cast("long")).alias("t"), F.count("*").alias("n"))
    earlier = Window.partitionBy("threshold").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range and threshold: bounded by the number of partitions
    offsets = totals.select("threshold", "range", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t0"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("threshold", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("t", F.sum(F.col("tp").cast("long")).over(inside)).withColumn("n", F.count("*").over(inside))
    joined = local.join(F.broadcast(offsets), ["threshold", "range"])
    tp, n = F.col("t") + F.col("t0"), F.col("n") + F.col("n0")
    return joined.select("threshold", "range", "image_id", "det_idx", "conf", "tp", tp.alias("tp_sum"), (n - tp).alias("fp_sum"))


def precision_recall(flags: DataFrame, n_gt: int) -> DataFrame:
    """``ranked`` rows with recall, precision and envelope, the best precision at this rank or later."""
    curve = cut(ranked(flags).withColumn("recall", F.col("tp_sum") / F.lit(float(max(1, n_gt)))).withColumn("precision", F.col("tp_sum") / F.greatest(F.col("tp_sum") + F.col("fp_sum"), F.lit(1e-12))))
    best = curve.groupBy("threshold", "range").agg(F.max("precision").alias("best"))
    later = Window.partitionBy("threshold").orderBy("range").rowsBetween(1, Window.unboundedFollowing)
    after = best.select("threshold", "range", F.coalesce(F.max("best").over(later), F.lit(0.0)).alias("after"))
    # this rank or later, read from the end: a frame that grows is linear, one that shrinks is not
    inside = Window.partitionBy("threshold", "range").orderBy("conf", F.desc("image_id"), F.desc("det_idx")).rowsBetween(Window.unboundedPreceding, 0)
    local = curve.withColumn("here", F.max("precision").over(inside))
    return local.join(F.broadcast(after), ["threshold", "range"]).withColumn("envelope", F.greatest("here", "after")).drop("here", "after", "range")


def average_precision(gt: DataFrame, pred: DataFrame, thresholds: list[float], n_gt: int | None = None) -> DataFrame:
    """(threshold, ap, n_tp): the area under the envelope, which only true positives add to. Class-agnostic.

    Filter both sides by class before for a class's own value. ``n_gt`` is the number of rows of ``gt``, for those who
    can count them for less. Raises without ground truth.
    """
    n_gt = gt.count() if n_gt is None else n_gt
    if not n_gt:
        raise ValueError("no ground truth boxes")
    parts = [_areas(gt, pred, thresholds[k : k + 63]) for k in range(0, len(thresholds), 63)]
    return reduce(DataFrame.unionByName, parts).select("threshold", (F.col("area") / n_gt).alias("ap"), "n_tp")


def _blocks(flags: DataFrame, n_thresholds: int) -> DataFrame:
    """(range, block, n, t0.., hits): the bits of up to BLOCK detections in falling confidence, and their sums by threshold.

    The place of a detection is where its bits stand, so confidences, images and indices go no further than this.
    """
    order = [F.desc("conf"), "image_id", "det_idx"]
    # numbers that rise with the order: the range above, the place in it below
    placed = flags.repartitionByRange(*order).sortWithinPartitions(*order).select(F.monotonically_increasing_id().alias("id"), "hits")
    width = next(f"<u{b}" for b in (1, 2, 4, 8) if n_thresholds <= 8 * b)
    names = ["range", "block", "n", *[f"t{k}" for k in range(n_thresholds)], "hits"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, range_, block = np.zeros(0, width), 0, 0

        def row(hits: np.ndarray) -> pa.RecordBatch:
            sums = [int(np.count_nonzero(hits >> hits.dtype.type(k) & hits.dtype.type(1))) for k in range(n_thresholds)]
            return pa.RecordBatch.from_pylist([dict(zip(names, [range_, block, len(hits), *sums, hits.tobytes()]))], schema)

        for batch in batches:
            if batch.num_rows:
                range_ = batch.column("id")[0].as_py() >> 33
                held = np.concatenate([held, batch.column("hits").to_numpy().astype(width)])
            while len(held) >= BLOCK:
                yield row(held[:BLOCK])
                held, block = held[BLOCK:], block + 1
        if len(held):
            yield row(held)

    schema = pa.schema([("range", pa.int32()), *[(c, pa.int64()) for c in names[1:-1]], ("hits", pa.binary())])
    return placed.mapInArrow(pack, "range int, " + ", ".join(f"{c} long" for c in names[1:-1]) + ", hits binary")


def _areas(gt: DataFrame, pred: DataFrame, thresholds: list[float]) -> DataFrame:
    """(threshold, area, n_tp): the sum of the envelope over true positives, at up to 63 thresholds.

    The order of the detections is the same at all thresholds, so each detection is one row of its place and a bit for
    each threshold: kept, shuffled and sorted once for all of them, then only its bits stay, in blocks. What goes
    from block to block is a row for each of them. Precision has its peaks at true positives.
    """
    shelf, every = Shelf(gt.sparkSession), range(len(thresholds))
    width = next(f"<u{b}" for b in (1, 2, 4, 8) if len(thresholds) <= 8 * b)
    flags = shelf.put(hits(gt, pred, thresholds))
    blocks = shelf.put(_blocks(flags, len(thresholds)))
    shelf.clear(blocks)

    def precisions(row: dict) -> list[np.ndarray]:
        """For each threshold the precision at each true positive of a block."""
        bits, out = np.frombuffer(row["hits"], width), []
        for k in every:
            at = np.flatnonzero(bits >> bits.dtype.type(k) & bits.dtype.type(1))
            out.append((row[f"t{k}"] + np.arange(1, len(at) + 1)) / (row["n"] + at + 1))
        return out

    def peaks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"range": r["range"], "block": r["block"]} | {f"p{k}": float(p.max()) if len(p) else None for k, p in enumerate(precisions(r))} for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("range", pa.int32()), ("block", pa.int64()), *[(f"p{k}", pa.float64()) for k in every]]))

    def envelopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                # this place or later, read from the end
                up = [np.maximum(np.maximum.accumulate(p[::-1]), r[f"p{k}"]) for k, p in enumerate(precisions(r))]
                rows.append({f"e{k}": float(e.sum()) for k, e in enumerate(up)} | {f"c{k}": len(e) for k, e in enumerate(up)})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([*[(f"e{k}", pa.float64()) for k in every], *[(f"c{k}", pa.int64()) for k in every]]))

    place = Window.orderBy("range", "block")
    earlier, later = place.rowsBetween(Window.unboundedPreceding, -1), place.rowsBetween(1, Window.unboundedFollowing)
    before = cut(blocks.select("range", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("n", *[f"t{k}" for k in every])]))
    counted = blocks.select("range", "block", "hits").join(F.broadcast(before), ["range", "block"])
    best = counted.mapInArrow(peaks, "range int, block long, " + ", ".join(f"p{k} double" for k in every))
    after = cut(best.select("range", "block", *[F.coalesce(F.max(f"p{k}").over(later), F.lit(0.0)).alias(f"p{k}") for k in every]))
    each = counted.join(F.broadcast(after), ["range", "block"]).mapInArrow(envelopes, ", ".join([*[f"e{k} double" for k in every], *[f"c{k} long" for k in every]]))
    sums = each.agg(*[F.sum(f"e{k}").alias(f"e{k}") for k in every], *[F.coalesce(F.sum(f"c{k}"), F.lit(0)).alias(f"c{k}") for k in every])
    rows = [F.struct(F.lit(float(t)).alias("threshold"), F.coalesce(f"e{k}", F.lit(0.0)).alias("area"), F.col(f"c{k}").alias("n_tp")) for k, t in enumerate(thresholds)]
    areas = cut(sums.select(F.inline(F.array(*rows))))
    shelf.clear()
    return areas


def of_classes(boxes: DataFrame, classes: dict[int, int] | None = None, only: int | None = None) -> DataFrame:
    """``boxes`` with cls through a class map, and of one class only where ``only`` is given; for both sides of a comparison."""
    mapped = boxes.withColumn("cls", remap(F.col("cls"), classes or {}))
    return mapped if only is None else mapped.where(F.col("cls") == only)


def mean_average_precision(gt: DataFrame, pred: DataFrame, thresholds: list[float] = IOU_STEPS, n_gt: int | None = None) -> DataFrame:
    """One row: ap50 and ap, the mean over ``thresholds``, which counts those without a true positive as 0."""
    each = average_precision(gt, pred, thresholds, n_gt)
    return each.agg(F.max(F.when(F.col("threshold") == 0.5, F.col("ap"))).alias("ap50"), F.avg("ap").alias("ap"))


def class_average_precision(gt: DataFrame, pred: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(cls, n_gt, ap) of each class that has ground truth: detections meet boxes of their own class only.

    All classes in one pass: an image and a class together are what is matched.
    """
    together = F.struct("image_id", "cls")
    flags = true_positives(gt.withColumn("image_id", together), pred.withColumn("image_id", together), [threshold])
    per = flags.select(F.col("image_id.cls").alias("threshold"), "image_id", "det_idx", "conf", "tp")  # ranked apart by class
    n_gt = gt.groupBy("cls").agg(F.count("*").alias("n_gt"))
    curve = precision_recall(per, 1).where("tp").groupBy(F.col("threshold").alias("cls")).agg(F.sum("envelope").alias("area"))
    return n_gt.join(curve, "cls", "left").select("cls", "n_gt", (F.coalesce("area", F.lit(0.0)) / F.col("n_gt")).alias("ap"))


def operating_point(gt: DataFrame, pred: DataFrame, conf: float = 0.65, threshold: float = 0.5) -> DataFrame:
    """One row: tp, fp, fn, precision, recall, f1 of detections from ``conf`` on. Greedy matching is closed under prefixes."""
    flags = true_positives(gt, pred.where(F.col("conf") >= conf), [threshold])
    n = flags.agg(F.count_if("tp").alias("tp"), F.count_if(~F.col("tp")).alias("fp")).join(gt.agg(F.count("*").alias("n_gt")))
    p, r = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1)), F.col("tp") / F.greatest("n_gt", F.lit(1))
    f1 = 2 * p * r / F.greatest(p + r, F.lit(1e-12))
    return n.select("tp", "fp", (F.col("n_gt") - F.col("tp")).alias("fn"), p.alias("precision"), r.alias("recall"), f1.alias("f1"))


def error_totals(errors: DataFrame, gt: str, *kinds: str) -> DataFrame:
    """(kind, n, pct_of_gt): the sum of each error column of per-image ``errors``, and its share of the boxes in column ``gt``."""
    sums = errors.agg(F.coalesce(F.sum(gt), F.lit(0)).alias("g"), *[F.coalesce(F.sum(k), F.lit(0)).cast("long").alias(k) for k in kinds])
    each = sums.select("g", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in kinds])).alias("x"))
    return each.select("x.kind", "x.n", (100.0 * F.col("x.n") / F.greatest("g", F.lit(1))).alias("pct_of_gt"))
