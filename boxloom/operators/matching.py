"""Matching ground truth with detections: five policies, each a fold over one image's boxes.

The boxes of an image are gathered by one shuffle on the image; what follows is expressions over its
arrays; but for ``best_class``, which joins the pairs of an image, and images with very many boxes, no pair of
boxes becomes a row. Ground truth has (image_id, box_idx, cls, x1..y2),
detections (image_id, det_idx, cls, conf, x1..y2), det_idx counting in falling confidence.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom.functions.geometry import iou
from boxloom.operators import spatial
from boxloom.operators.curation import sample_by_hash


def gather(gt: DataFrame, pred: DataFrame, box: tuple[str, ...] = ("cls", "x1", "y1", "x2", "y2")) -> DataFrame:
    """(image_id, g, p): arrays of structs of the columns ``box`` in index order, for every image of either side."""
    g = gt.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct(F.col("box_idx").alias("i"), *box))).alias("g"))
    p = pred.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct(F.col("det_idx").alias("i"), *box, "conf"))).alias("p"))
    both = g.join(p, "image_id", "full")
    empty = {c: F.expr("array()").cast(both.schema[c].dataType) for c in "gp"}
    return both.select("image_id", *[F.coalesce(c, empty[c]).alias(c) for c in "gp"])


def _best(of: Column, among: Column, allowed) -> Column:
    """Struct (iou, at) of the first of the best overlaps of ``of`` with allowed members of ``among``; at -1 without."""
    scored = F.transform(among, lambda x, k: F.struct(F.when(allowed(x, k), iou(of, x)).otherwise(F.lit(0.0)).alias("iou"), k.alias("at")))
    start = F.struct(F.lit(0.0).alias("iou"), F.lit(-1).alias("at"))
    return F.aggregate(scored, start, lambda a, x: F.when(x["iou"] > a["iou"], x).otherwise(a))


def _once(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def best_class(gt: DataFrame, pred: DataFrame, least: float = 0.3, few: int = spatial.FEW) -> DataFrame:
    """M1: (image_id, box_idx, cls, pred_cls): the class of the best detection, the last of equal ones; not exclusive.

    Images with more than ``few`` pairs meet by cells of a grid (see ``spatial``), the others in one join.
    """
    box = ["x1", "y1", "x2", "y2"]
    met = spatial.pairs(gt.select("image_id", "box_idx", "cls", *box), pred.select("image_id", "det_idx", "cls", *box), few=few)
    over = met.select("image_id", "a.box_idx", F.col("a.cls").alias("cls"), "b.det_idx", F.col("b.cls").alias("pred_cls"), iou(F.col("a"), F.col("b"), clamped=False).alias("iou"))
    best = over.where(F.col("iou") >= least).groupBy("image_id", "box_idx", "cls").agg(F.max_by("pred_cls", F.struct("iou", "det_idx")).alias("pred_cls"))
    return gt.select("image_id", "box_idx", "cls").join(best, ["image_id", "box_idx", "cls"], "left")


def true_positives(gt: DataFrame, pred: DataFrame, thresholds: list[float]) -> DataFrame:
    """M2: (threshold, image_id, det_idx, conf, tp): detections in falling confidence take the best unused box."""
    both = gather(gt, pred).withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))

    def step(s: Column, p: Column) -> Column:
        def take(b: Column) -> Column:
            tp = b["iou"] >= F.col("threshold")
            return F.struct(
                F.when(tp, F.array_append(s["used"], b["at"])).otherwise(s["used"]).alias("used"),
                F.array_append(s["tp"], tp).alias("tp"),
            )

        return _once(_best(p, F.col("g"), lambda x, k: ~F.array_contains(s["used"], k)), take)

    start = F.struct(F.expr("array()").cast("array<int>").alias("used"), F.expr("array()").cast("array<boolean>").alias("tp"))
    flags = both.select("threshold", "image_id", "p", F.aggregate("p", start, step)["tp"].alias("tp"))
    each = flags.select("threshold", "image_id", F.explode(F.arrays_zip("p", "tp")).alias("x"))
    return each.select("threshold", "image_id", F.col("x.p.i").alias("det_idx"), F.col("x.p.conf").alias("conf"), F.col("x.tp").alias("tp"))


def hits(gt: DataFrame, pred: DataFrame, thresholds: list[float]) -> DataFrame:
    """M2 at up to 63 thresholds: (image_id, det_idx, conf, hits), a row for each detection.

    Bit k of ``hits`` is set where ``true_positives`` has tp at the k-th threshold. Overlaps are computed once for all.
    """
    both = gather(gt, pred, ("x1", "y1", "x2", "y2")).where(F.size("p") > 0)
    least = min(thresholds)

    def met(p: Column) -> Column:
        """The boxes that overlap enough for some threshold, the best first, the first of equal ones before the others."""
        scored = F.transform("g", lambda g, k: F.struct((-iou(p, g)).alias("less"), k.alias("at")))
        return F.sort_array(F.filter(scored, lambda x: x["less"] <= -least))

    def step(threshold: Column):
        def taken(s: Column, c: Column) -> Column:
            def take(b: Column) -> Column:
                tp = b.isNotNull()
                return F.struct(F.when(tp, F.array_append(s["used"], b["at"])).otherwise(s["used"]).alias("used"), F.array_append(s["tp"], tp).alias("tp"))

            return _once(F.get(F.filter(c, lambda x: (x["less"] <= -threshold) & ~F.array_contains(s["used"], x["at"])), F.lit(0)), take)

        return taken

    start = F.struct(F.expr("array()").cast("array<int>").alias("used"), F.expr("array()").cast("array<boolean>").alias("tp"))
    each = _once(F.transform("p", met), lambda c: F.transform(F.array(*map(F.lit, thresholds)), lambda t: F.aggregate(c, start, step(t))["tp"]))

    def masks(tp: Column) -> Column:
        def mask(p: Column, i: Column) -> Column:
            bits = [F.when(F.get(F.get(tp, F.lit(k)), i), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k in range(len(thresholds))]
            return F.struct(p["i"].alias("det_idx"), p["conf"].alias("conf"), sum(bits[1:], bits[0]).alias("hits"))

        return F.transform("p", mask)

    return both.select("image_id", F.inline(_once(each, masks)))


def image_errors(gt: DataFrame, pred: DataFrame, least: float = 0.5, few: int = spatial.FEW) -> DataFrame:
    """M3: (image_id, n_gt, n_pred, true_pos, class_mismatch, false_neg, false_pos, badness): greedy over all pairs by falling overlap.

    Images with more than ``few`` pairs meet by cells of a grid, and only the pairs that overlap enough are gathered.
    """
    busy = spatial.crowded(gt, pred, few=few)
    many = gt.join(busy, "image_id", "left_semi"), pred.join(busy, "image_id", "left_semi")
    matched = _errors_of_few(gt.join(busy, "image_id", "left_anti"), pred.join(busy, "image_id", "left_anti"), least)
    matched = matched.unionByName(_errors_of_many(busy, *many, least))
    n = F.col("true_pos") + F.col("class_mismatch")
    out = matched.withColumn("false_neg", F.col("n_gt") - n).withColumn("false_pos", F.col("n_pred") - n)
    return out.withColumn("badness", F.col("false_neg") + F.col("false_pos") + F.col("class_mismatch"))


def _errors_of_many(busy: DataFrame, gt: DataFrame, pred: DataFrame, least: float) -> DataFrame:
    """``_errors_of_few`` for the images in ``busy`` (image_id, n_one, n_other)."""
    box = ["x1", "y1", "x2", "y2", "cls"]
    met = spatial.overlapping(gt.select("image_id", "box_idx", *box), pred.select("image_id", "det_idx", *box))
    scored = met.select("image_id", iou(F.col("b"), F.col("a")).alias("iou"), F.col("b.det_idx").alias("pi"), F.col("a.box_idx").alias("gi"), (F.col("a.cls") == F.col("b.cls")).alias("same"))

    def greedy(rows: pd.DataFrame) -> pd.DataFrame:
        """One image's pairs, those that overlap enough: some for each box, not all with all."""
        boxes, found, right, wrong = set(), set(), 0, 0
        for x in rows.sort_values(["iou", "pi", "gi", "same"], ascending=False).itertuples(index=False):
            if x.pi not in found and x.gi not in boxes:
                found.add(x.pi)
                boxes.add(x.gi)
                right, wrong = right + bool(x.same), wrong + (not x.same)
        return pd.DataFrame({"image_id": rows["image_id"][:1], "true_pos": [right], "class_mismatch": [wrong]})

    kind = gt.schema["image_id"].dataType.simpleString()
    done = scored.where(F.col("iou") >= least).groupBy("image_id").applyInPandas(greedy, f"image_id {kind}, true_pos int, class_mismatch int")
    counts = busy.select("image_id", F.col("n_one").cast("int").alias("n_gt"), F.col("n_other").cast("int").alias("n_pred")).join(done, "image_id", "left")
    return counts.select("image_id", "n_gt", "n_pred", F.coalesce("true_pos", F.lit(0)).alias("true_pos"), F.coalesce("class_mismatch", F.lit(0)).alias("class_mismatch"))


def _errors_of_few(gt: DataFrame, pred: DataFrame, least: float) -> DataFrame:
    """(image_id, n_gt, n_pred, true_pos, class_mismatch) by a fold over all pairs of an image."""
    both = gather(gt, pred)
    pairs = F.flatten(F.transform("p", lambda p, pi: F.transform(F.col("g"), lambda g, gi: F.struct(iou(g, p).alias("iou"), pi.alias("pi"), gi.alias("gi"), (g["cls"] == p["cls"]).alias("same")))))
    falling = F.reverse(F.sort_array(F.filter(pairs, lambda x: x["iou"] >= least)))

    def step(s: Column, x: Column) -> Column:
        free = ~F.array_contains(s["up"], x["pi"]) & ~F.array_contains(s["ug"], x["gi"])
        return F.struct(
            F.when(free, F.array_append(s["up"], x["pi"])).otherwise(s["up"]).alias("up"),
            F.when(free, F.array_append(s["ug"], x["gi"])).otherwise(s["ug"]).alias("ug"),
            (s["tp"] + F.when(free & x["same"], 1).otherwise(0)).alias("tp"),
            (s["cm"] + F.when(free & ~x["same"], 1).otherwise(0)).alias("cm"),
        )

    ints = F.expr("array()").cast("array<int>")
    start = F.struct(ints.alias("up"), ints.alias("ug"), F.lit(0).alias("tp"), F.lit(0).alias("cm"))
    s = both.select("image_id", F.size("g").alias("n_gt"), F.size("p").alias("n_pred"), F.aggregate(falling, start, step).alias("s"))
    return s.select("image_id", "n_gt", "n_pred", F.col("s.tp").alias("true_pos"), F.col("s.cm").alias("class_mismatch"))


def plate_errors(gt: DataFrame, pred: DataFrame, target: int = 4, least: float = 0.3, good: float = 0.5) -> DataFrame:
    """M4: failures of one class: boxes in file order take the best unused detection of the class.

    Without one, a detection of another class makes it a wrong class and is not used up.
    """
    both = gather(gt.where(F.col("cls") == target), pred)

    def step(s: Column, g: Column) -> Column:
        def judge(b: Column) -> Column:
            own, other = b["own"], b["other"]
            hit = own["iou"] >= least
            return F.struct(
                F.when(hit, F.array_append(s["used"], own["at"])).otherwise(s["used"]).alias("used"),
                (s["loose"] + F.when(hit & (own["iou"] < good), 1).otherwise(0)).alias("loose"),
                (s["wrong"] + F.when(~hit & (other["iou"] >= least), 1).otherwise(0)).alias("wrong"),
                (s["missed"] + F.when(~hit & (other["iou"] < least), 1).otherwise(0)).alias("missed"),
            )

        own = _best(g, F.col("p"), lambda x, k: (x["cls"] == target) & ~F.array_contains(s["used"], k))
        other = _best(g, F.col("p"), lambda x, k: x["cls"] != target)
        return _once(F.struct(own.alias("own"), other.alias("other")), judge)

    zero = F.lit(0)
    start = F.struct(F.expr("array()").cast("array<int>").alias("used"), zero.alias("loose"), zero.alias("wrong"), zero.alias("missed"))
    n_pred = F.size(F.filter("p", lambda x: x["cls"] == target))
    s = both.select("image_id", F.size("g").alias("gt_plates"), n_pred.alias("pred_plates"), F.aggregate("g", start, step).alias("s"))
    out = s.select("image_id", "gt_plates", "pred_plates", F.col("s.missed").alias("missed"), (F.col("pred_plates") - F.size("s.used")).alias("spurious"), F.col("s.loose").alias("loose_box"), F.col("s.wrong").alias("wrong_class"))
    return out.withColumn("badness", 3 * F.col("missed") + 2 * F.col("spurious") + F.col("wrong_class") + F.col("loose_box"))


def review(gt: DataFrame, pred: DataFrame, least: float = 0.3, good: float = 0.5) -> DataFrame:
    """M5: boxes in file order take the best unused detection of any class; a wrong class goes before a loose box."""
    both = gather(gt, pred)

    def step(s: Column, g: Column) -> Column:
        def judge(b: Column) -> Column:
            hit = b["iou"] >= least
            same = F.get(F.col("p"), b["at"])["cls"] == g["cls"]
            return F.struct(
                F.when(hit, F.array_append(s["used"], b["at"])).otherwise(s["used"]).alias("used"),
                (s["missed"] + F.when(hit, 0).otherwise(1)).alias("missed"),
                (s["wrong"] + F.when(hit & ~same, 1).otherwise(0)).alias("wrong"),
                (s["loose"] + F.when(hit & same & (b["iou"] < good), 1).otherwise(0)).alias("loose"),
            )

        return _once(_best(g, F.col("p"), lambda x, k: ~F.array_contains(s["used"], k)), judge)

    zero = F.lit(0)
    start = F.struct(F.expr("array()").cast("array<int>").alias("used"), zero.alias("missed"), zero.alias("wrong"), zero.alias("loose"))
    s = both.select("image_id", F.size("g").alias("gt_boxes"), F.size("p").alias("pred_boxes"), F.aggregate("g", start, step).alias("s"))
    out = s.select("image_id", "gt_boxes", "pred_boxes", F.col("s.missed").alias("missed"), (F.col("pred_boxes") - F.size("s.used")).alias("spurious"), F.col("s.wrong").alias("wrong_class"), F.col("s.loose").alias("loose_box"))
    return out.withColumn("badness", 3 * F.col("missed") + 2 * F.col("spurious") + 2 * F.col("wrong_class") + F.col("loose_box"))


def ranked_review(errors: DataFrame, k: int, key: str = "image_id", seed: int = 42) -> DataFrame:
    """A sample of ``k`` images of ``errors`` with sample_pos, part (bad or good) and place: the worst first, in sample order among equals.

    The sample is bounded, so its order takes one small window.
    """
    sampled = sample_by_hash(errors, key, k, seed)
    place = F.row_number().over(Window.orderBy(F.desc("badness"), "sample_pos")) - 1
    return sampled.withColumn("part", F.when(F.col("badness") > 0, "bad").otherwise("good")).withColumn("place", place)
