"""Per-image decisions as ordered conditions: triage, labelling, validation, plates, relabelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.functions.geometry import area_frac, iou, padded_crop, plate_to_yolo
from boxloom.functions.text import fixed

#: Thresholds that define the semantics.
PLATE_CONF, OCR_CONF, PLATE_LEN = 0.65, 0.80, 5
VEHICLE_AREA, BOX_AREA, MAX_VEHICLES = 0.02, 0.05, 3
TRIAGE_PLATE_CONF = 0.45
PAYLOAD = "struct<plates:array<struct<confidence:string,ocr_confidence:string,plate:string,bbox:array<string>>>>"


def plate_valid(plate_conf: Column, ocr_conf: Column, text: Column) -> Column:
    return (plate_conf >= PLATE_CONF) & (ocr_conf >= OCR_CONF) & (F.length(F.trim(text)) >= PLATE_LEN)


def parse_payload(payload: Column) -> Column:
    """Plates of a service's JSON: (plate_confidence, ocr_confidence, plate, bbox). Wrong shapes give none; a bad number makes both 0."""
    def of(p: Column) -> Column:
        a, b = p["confidence"].try_cast("double"), p["ocr_confidence"].try_cast("double")
        bad = (p["confidence"].isNotNull() & (p["confidence"] != "") & a.isNull()) | (p["ocr_confidence"].isNotNull() & (p["ocr_confidence"] != "") & b.isNull())
        zero = F.lit(0.0)
        return F.struct(
            F.when(bad, zero).otherwise(F.coalesce(a, zero)).alias("plate_confidence"),
            F.when(bad, zero).otherwise(F.coalesce(b, zero)).alias("ocr_confidence"),
            F.coalesce(p["plate"], F.lit("")).alias("plate"),
            F.transform(F.coalesce(p["bbox"], F.array().cast("array<string>")), lambda x: x.try_cast("double")).alias("bbox"),
        )

    plates = F.filter(F.coalesce(F.from_json(payload, PAYLOAD)["plates"], F.expr("array()").cast(PAYLOAD[len("struct<plates:") : -1])), lambda p: p.isNotNull())
    return F.transform(plates, of)


def best_plates(plates: DataFrame, *group: str) -> DataFrame:
    """The plate with the best reading of each group, the first of equal ones; thresholds come after, so it may fail them."""
    order = F.struct("ocr_confidence", (-F.col("plate_idx")).alias("o"))
    best = plates.groupBy(*group).agg(F.max_by(F.struct("plate_idx", "plate_confidence", "ocr_confidence", "plate"), order).alias("b"))
    return best.select(*group, "b.*").withColumn("valid", plate_valid(F.col("plate_confidence"), F.col("ocr_confidence"), F.col("plate")))


def validate(images: DataFrame, boxes: DataFrame, plates: DataFrame, min_side: int = 8) -> DataFrame:
    """(image_id, accepted, reason, vehicle_id): the first failing vehicle decides.

    ``images``: image_id, has_label, readable. ``boxes``: image_id, vehicle_id, crop_w, crop_h; a row without a
    vehicle_id is a line that is no box, and a label of such lines alone is empty.
    ``plates``: image_id, vehicle_id, plate_idx, plate_confidence, ocr_confidence, plate.
    """
    best = best_plates(plates, "image_id", "vehicle_id").select("image_id", "vehicle_id", "valid")
    each = boxes.join(best, ["image_id", "vehicle_id"], "left")
    crop_bad = (F.col("crop_w") < min_side) | (F.col("crop_h") < min_side)
    why = F.when(F.col("vehicle_id").isNotNull(), F.when(F.col("valid").isNull(), "no_plate_detected").when(~F.col("valid"), "plate_below_threshold"))
    per = each.groupBy("image_id").agg(
        F.count("vehicle_id").alias("n"),
        F.min(F.when(crop_bad, F.col("vehicle_id"))).alias("bad_crop"),
        F.min(F.when(why.isNotNull(), F.struct("vehicle_id", why.alias("why")))).alias("bad"),
    )
    reason = (
        F.when(~F.col("has_label"), "missing_label").when(F.coalesce("n", F.lit(0)) == 0, "empty_label").when(~F.col("readable"), "corrupt_image").when(F.col("bad_crop").isNotNull(), "invalid_crop").when(F.col("bad").isNotNull(), F.col("bad.why")).otherwise("ok")
    )
    out = images.join(per, "image_id", "left").select("image_id", reason.alias("reason"), F.when(reason == "invalid_crop", F.col("bad_crop")).when(reason.isin("no_plate_detected", "plate_below_threshold"), F.col("bad.vehicle_id")).alias("vehicle_id"))
    return out.withColumn("accepted", F.col("reason") == "ok")


def with_area(detections: DataFrame, width: int, height: int) -> DataFrame:
    return detections.withColumn("area_frac", area_frac(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), width, height))


def has_vehicle(images: DataFrame, detections: DataFrame, width: int, height: int, least: float = VEHICLE_AREA) -> DataFrame:
    """(image_id, has_vehicle): null for images that cannot be read."""
    found = with_area(detections, width, height).groupBy("image_id").agg(F.bool_or(F.col("area_frac") >= least).alias("any"))
    return images.join(found, "image_id", "left").select("image_id", F.when(F.col("readable"), F.coalesce("any", F.lit(False))).alias("has_vehicle"))


def triage(vehicles: DataFrame, plates: DataFrame, least: float = TRIAGE_PLATE_CONF) -> DataFrame:
    """(image_id, decision): unreadable, no_vehicle, api_fail, clean, no_plate, in this order.

    ``vehicles``: image_id, has_vehicle. ``plates``: image_id, best (double, null if there is none), failed.
    """
    decision = (
        F.when(F.col("has_vehicle").isNull(), "unreadable").when(~F.col("has_vehicle"), "no_vehicle").when(F.coalesce("failed", F.lit(False)), "api_fail").when(F.col("best") >= least, "clean").otherwise("no_plate")
    )
    return vehicles.join(plates, "image_id", "left").select("image_id", decision.alias("decision"))


def label_decision(images: DataFrame, detections: DataFrame, plates: DataFrame, width: int, height: int) -> DataFrame:
    """(image_id, status, kept, skipped_small): large boxes in detection order; the first one without a plate decides.

    ``plates``: image_id, det_idx, visible.
    """
    boxes = with_area(detections, width, height).withColumn("large", F.col("area_frac") >= BOX_AREA)
    boxes = boxes.join(plates, ["image_id", "det_idx"], "left")
    empty = (F.rint(F.least("x2", F.lit(width))) <= F.rint(F.greatest("x1", F.lit(0)))) | (F.rint(F.least("y2", F.lit(height))) <= F.rint(F.greatest("y1", F.lit(0))))
    why = F.when(empty, "no_box").when(~F.coalesce("visible", F.lit(False)), "no_plate")
    per = boxes.groupBy("image_id").agg(
        F.count_if("large").alias("n"), F.count_if(~F.col("large")).alias("small"), F.min(F.when(F.col("large") & why.isNotNull(), F.struct("det_idx", why.alias("why")))).alias("bad")
    )
    n = F.coalesce("n", F.lit(0))
    status = F.when(~F.col("readable"), "read_failed").when(n == 0, "no_box").when(n > MAX_VEHICLES, "too_many").when(F.col("bad").isNotNull(), F.col("bad.why")).otherwise("labeled")
    return images.join(per, "image_id", "left").select("image_id", status.alias("status"), F.when(status == "labeled", n).otherwise(0).alias("kept"), F.coalesce("small", F.lit(0)).alias("skipped_small"))


def plate_status(images: DataFrame, plates: DataFrame, least: float = PLATE_CONF) -> DataFrame:
    """(image_id, status, boxes): api_fail, no_plate, size_fail, plated; boxes of no area are dropped.

    ``images``: image_id, width, height, failed. ``plates``: image_id, plate_idx, confidence, bbox (array).
    """
    joined = plates.where((F.col("confidence") >= least) & (F.size("bbox") >= 4)).join(images.select("image_id", "width", "height"), "image_id")
    x = [F.get("bbox", F.lit(k)) for k in range(4)]
    yolo = plate_to_yolo(*x, F.col("width"), F.col("height"))
    boxes = joined.select("image_id", "plate_idx", F.col("width").isNull().alias("no_size"), F.struct(*[v.alias(c) for v, c in zip(yolo, ("cx", "cy", "w", "h"))]).alias("box"))
    good = (F.col("box.w") > 0) & (F.col("box.h") > 0)
    per = boxes.groupBy("image_id").agg(F.count("*").alias("n"), F.bool_or("no_size").alias("no_size"), F.sort_array(F.collect_list(F.when(good, F.struct("plate_idx", "box")))).alias("kept"))
    status = F.when(F.col("failed"), "api_fail").when(F.col("n").isNull(), "no_plate").when(F.col("no_size"), "size_fail").when(F.size("kept") == 0, "no_plate").otherwise("plated")
    none = F.expr("array()").cast("array<struct<cx:double,cy:double,w:double,h:double>>")
    return images.join(per, "image_id", "left").select("image_id", status.alias("status"), F.when(status == "plated", F.transform("kept", lambda k: k["box"])).otherwise(none).alias("boxes"))


def upsert_plates(lines: DataFrame, plates: DataFrame, plate_class: int = 4) -> DataFrame:
    """Label lines with the plate class replaced by ``plates``: running it again changes nothing. Columns of ``lines`` (with cls)."""
    touched = plates.select("image_id").distinct()
    old = lines.join(touched, "image_id", "left_anti").unionByName(lines.join(touched, "image_id", "left_semi").where(F.col("cls") != plate_class))
    return old.unionByName(plates.withColumn("cls", F.lit(plate_class)), allowMissingColumns=True)


#: Old class to new, and to (car, other) where a crop decides; the car of the detector.
DIRECT = {0: 0, 1: 1, 4: 6}
DECIDE = {2: (2, 4), 3: (3, 5)}
DETECTOR_CAR = 2


def best_detection(crops: DataFrame) -> DataFrame:
    """(image_id, box_idx, best_cls): the class of the surest detection above 0 in each crop, the first of equal ones."""
    sure = F.when(F.col("conf") > 0, F.struct("conf", (-F.col("det_idx")).alias("o")))
    return crops.groupBy("image_id", "box_idx").agg(F.max_by("cls", sure).alias("best_cls"))


def relabel(boxes: DataFrame, decided: DataFrame, fallback_car: bool = True) -> DataFrame:
    """``boxes`` with new_cls and how: direct, decided, fallback; classes that no rule names are dropped."""
    joined = boxes.join(decided, ["image_id", "box_idx"], "left")
    new, how = F, F
    for old, to in DIRECT.items():
        new, how = new.when(F.col("cls") == old, F.lit(to)), how.when(F.col("cls") == old, "direct")
    for old, (car, other) in DECIDE.items():
        is_car = F.when(F.col("best_cls").isNull(), F.lit(fallback_car)).otherwise(F.col("best_cls") == DETECTOR_CAR)
        new = new.when(F.col("cls") == old, F.when(is_car, car).otherwise(other))
        how = how.when(F.col("cls") == old, F.when(F.col("best_cls").isNull(), "fallback").otherwise("decided"))
    return joined.withColumn("new_cls", new).withColumn("how", how).where("new_cls IS NOT NULL").drop("best_cls")


def relabel_reasons(relabelled: DataFrame, crops: DataFrame) -> DataFrame:
    """(how, why, boxes, files, level): relabelled boxes by reason, with sub-totals of each ``how`` and the total, by rollup.

    ``relabelled`` comes from ``relabel``. ``crops``: image_id, box_idx, crop (ok, no_image or bad_crop) of the boxes
    that a crop decides. A fallback is told apart: no_image, bad_crop, or no_detection in a good crop. level is 0
    for a reason, 1 for a sub-total and 3 for the total.
    """
    joined = relabelled.join(crops.select("image_id", "box_idx", "crop"), ["image_id", "box_idx"], "left")
    car = F.when(F.col("new_cls").isin(*[car for car, _ in DECIDE.values()]), "car").otherwise("other")
    missing = F.when(F.col("crop").isin("no_image", "bad_crop"), F.col("crop")).otherwise("no_detection")
    why = F.when(F.col("how") == "decided", car).when(F.col("how") == "fallback", missing).otherwise("direct")
    return joined.withColumn("why", why).rollup("how", "why").agg(F.count("*").alias("boxes"), F.count_distinct("image_id").alias("files"), F.grouping_id().cast("int").alias("level"))


def crop_states(boxes: DataFrame, images: DataFrame, pad: float = 0.15, least: int = 8) -> DataFrame:
    """(image_id, box_idx, crop, x1, y1, x2, y2): the padded window of each box that a crop decides, and whether it can be had.

    ``boxes``: image_id, box_idx, cls, cx, cy, w, h. ``images``: image_id, width, height (null: not readable). no_image
    without a readable image, bad_crop with a side below ``least`` pixels, else ok.
    """
    sized = boxes.where(F.col("cls").isin(*DECIDE)).join(images, "image_id", "left")
    x1, y1, x2, y2 = padded_crop(*[F.col(c) for c in ("cx", "cy", "w", "h")], F.col("width"), F.col("height"), pad)
    state = F.when(F.col("width").isNull(), "no_image").when((x2 - x1 < least) | (y2 - y1 < least), "bad_crop").otherwise("ok")
    return sized.select("image_id", "box_idx", state.alias("crop"), x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


#: The detector's vehicle classes by id; of these, what counts as a bike.
COCO_VEHICLES = {1: "bicycle", 2: "car", 3: "motorcycle", 5: "bus", 7: "truck"}
BIKES = ("bicycle", "motorcycle")


def is_vehicle(cls: Column) -> Column:
    return cls.isin(*COCO_VEHICLES)


def is_bike(cls: Column) -> Column:
    """Whether a detector's class is a bike; any other class is none."""
    return cls.isin(*[k for k, name in COCO_VEHICLES.items() if name in BIKES])


def batch_class(cls: Column, orientation: str) -> Column:
    """The data set's class of a detector's class in a batch that was taken from the ``front`` or the ``back``."""
    if orientation not in ("front", "back"):
        raise ValueError(f"orientation is front or back, not {orientation!r}")
    back = int(orientation == "back")
    return F.when(is_bike(cls), F.lit(back)).otherwise(F.lit(2 + back))


def suppress(detections: DataFrame, conf: float = 0.25, overlap: float = 0.45, classes: bool = True) -> DataFrame:
    """``detections`` from ``conf`` on that no surer kept one of their class overlaps by more than ``overlap``, numbered anew.

    The detections of an image are gathered and folded in falling confidence. Without ``classes`` any kept one counts.
    """
    box = ("x1", "y1", "x2", "y2", "conf", "cls")
    falling = F.sort_array(F.collect_list(F.struct((-F.col("conf")).alias("o"), F.col("det_idx").alias("i"), *box)))
    per = detections.where(F.col("conf") >= conf).groupBy("image_id").agg(falling.alias("d"))

    def step(kept: Column, x: Column) -> Column:
        hides = F.exists(kept, lambda k: ((k["cls"] == x["cls"]) | F.lit(not classes)) & (iou(k, x) > overlap))
        return F.when(hides, kept).otherwise(F.array_append(kept, x))

    kept = per.select("image_id", F.aggregate("d", F.slice("d", 1, 0), step).alias("d"))
    each = kept.select("image_id", F.posexplode("d").alias("det_idx", "x"))
    return each.select("image_id", "det_idx", *[F.col(f"x.{c}").alias(c) for c in box])


def vehicle_lines(lines: DataFrame, plate_class: int = 4) -> DataFrame:
    """The label lines of other classes than ``plate_class``, as they stand; ``lines`` comes from ``labels.parse``."""
    return lines.where((F.col("n_tokens") >= 5) & F.col("cls").isNotNull() & (F.col("cls") != plate_class))


def recover_plates(images: DataFrame, lines: DataFrame, detections: DataFrame, plate_class: int = 4, model_class: int = 0) -> DataFrame:
    """(image_id, status, lines): recovered with the vehicle lines and a line for each plate found, rejected without one, read_failed.

    ``images``: image_id, width, height (null: not readable). ``lines``: image_id, line_no, line, with the columns of
    ``labels.parse``. ``detections`` of the plate model: image_id, det_idx, cls, x1..y2. A plate of no area counts as none;
    what is left is clamped only after that.
    """
    found = detections.where(F.col("cls") == model_class).join(images.where("width IS NOT NULL"), "image_id").where((F.col("x1") != F.col("x2")) & (F.col("y1") != F.col("y2")))
    yolo = plate_to_yolo(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], F.col("width"), F.col("height"))
    plate = F.concat_ws(" ", F.lit(str(plate_class)), *[fixed(v, 6) for v in yolo])
    plates = found.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("det_idx", plate.alias("line")))).alias("plates"))
    vehicles = vehicle_lines(lines, plate_class).groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("line_no", F.trim("line").alias("line")))).alias("vehicles"))
    none = F.expr("array()").cast("array<string>")
    status = F.when(F.col("width").isNull(), "read_failed").when(F.col("plates").isNotNull(), "recovered").otherwise("rejected")
    text = F.concat(F.coalesce(F.transform("vehicles", lambda x: x["line"]), none), F.coalesce(F.transform("plates", lambda x: x["line"]), none))
    joined = images.join(vehicles, "image_id", "left").join(plates, "image_id", "left")
    return joined.select("image_id", status.alias("status"), F.when(status == "recovered", text).otherwise(none).alias("lines"))


def relabel_counts(relabelled: DataFrame) -> DataFrame:
    """(new_cls, how, n, pct): boxes by new class and reason, and their share of all."""
    per = relabelled.groupBy("new_cls", "how").agg(F.count("*").alias("n"))
    every = relabelled.agg(F.count("*").alias("every"))
    return per.join(F.broadcast(every)).select("new_cls", "how", "n", (100.0 * F.col("n") / F.greatest("every", F.lit(1))).alias("pct"))
