"""Jobs that filter and relabel a data set: triage, validation of plates, five classes to seven.

Images stay where they are. What a job decides is a log and lists, and, where asked for, copies or links in a
folder for each decision. Jobs that call a service or a model can go on where they broke off, by a record of the
images that are done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.functions import geometry as G
from boxloom.functions import imaging
from boxloom.functions import labels as L
from boxloom.functions import text as X
from boxloom.functions.session import cut, cut_counted
from boxloom.jobs import VEHICLE_CONF, counts_of, named, pixels_of
from boxloom.operators import curation as C
from boxloom.operators import decisions as D
from boxloom.sources import dataset, external, files, sinks

TRIAGE = ("clean", "no_vehicle", "no_plate", "api_fail", "unreadable")
INVALID = ("missing_label", "empty_label", "corrupt_image", "invalid_crop", "no_plate_detected", "plate_below_threshold", "worker_exception")
CORNERS = ("x1", "y1", "x2", "y2")


def triage(spark: SparkSession, images: str, out: str, model: str, service: str, conf: float = VEHICLE_CONF, least_area: float = D.VEHICLE_AREA, plate_conf: float = D.TRIAGE_PLATE_CONF, limit: int = 0, aside: bool = False, link: bool = False) -> DataFrame:
    """Which images show a vehicle and a plate: clean, no_vehicle, no_plate, api_fail or unreadable, in ``out``/filter_log.

    Only images with a vehicle are sent to the service. With ``aside`` the first three lie in folders of their names
    below ``out``, as copies or links; the others stay in place only.
    """
    listed = files.sorted_images(spark, images, limit).select("name", "path")
    rows = files.images(spark, images).join(listed.select("path"), "path", "left_semi").select(F.col("name").alias("image_id"), "path", "content")
    sizes = cut(pixels_of(spark, images).join(listed.select("name"), "name", "left_semi").select(F.col("name").alias("image_id"), "width", "height"))
    good = sizes.where("width IS NOT NULL")
    found = external.detect(rows.join(good.select("image_id"), "image_id", "left_semi"), named(model), "image_id")
    boxes = D.suppress(found.where(D.is_vehicle(F.col("cls"))), conf)
    unit = 1_000_000
    scaled = boxes.join(good, "image_id").select("image_id", "det_idx", *[(F.col(c) / F.col(m) * unit).alias(c) for c, m in zip(CORNERS, ("width", "height", "width", "height"))])
    vehicles = cut(D.has_vehicle(sizes.select("image_id", F.col("width").isNotNull().alias("readable")), scaled, unit, unit, least_area))
    asked = external.ask_service(rows.join(vehicles.where("has_vehicle"), "image_id", "left_semi"), named(service), "image_id")
    plates = asked.select("image_id", F.col("api_error").isNotNull().alias("failed"), F.array_max(F.transform(D.parse_payload(F.col("payload")), lambda p: p["plate_confidence"])).alias("best"))
    decided, counts = cut_counted(D.triage(vehicles, plates, plate_conf), "decision", TRIAGE)
    sinks.write_csv(decided.select(F.col("image_id").alias("image"), "decision"), f"{out}/filter_log")
    if aside:
        kept = decided.where(F.col("decision").isin(*TRIAGE[:3])).join(listed.withColumnRenamed("name", "image_id"), "image_id")
        dataset.save_files(kept.select(F.concat("decision", F.lit("/"), "image_id").alias("name"), F.lit(None).cast("binary").alias("content"), F.col("path").alias("source")), out, link)
    return counts_of(spark, counts, "decision")


def validate(spark: SparkSession, images: str, labels: str, out: str, service: str, record: str | None = None, aside: bool = False, link: bool = False) -> DataFrame:
    """Whether each vehicle of an image has a readable plate; the reasons of those that are rejected go to ``out``/removed.

    The service gets the crop of each box. With ``record`` images that were accepted before are not asked for again.
    A call that fails gives no plate. With ``aside`` rejected images and labels lie below ``out``/removed_pairs too.
    """
    listed = files.images(spark, images).select("name", "stem", "path")
    done = files.name_records(spark, record) if record and dataset.exists(spark, record) else None
    pending = cut(listed if done is None else C.pending(listed, done, "name"))
    lines = L.parse(files.label_lines(spark, labels)).join(pending.select("stem"), "stem", "left_semi")
    boxes = lines.where(L.strict()).select(F.col("stem").alias("image_id"), "line_no", "cx", "cy", "w", "h")
    decoded = pixels_of(spark, images).withColumn("image_id", X.stem(F.col("name"))).where("width IS NOT NULL")
    vehicles = boxes.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "cx", "cy", "w", "h"))).alias("v")).select("image_id", F.posexplode("v").alias("vehicle_id", "v")).select("image_id", "vehicle_id", "v.*")
    window = G.to_pixels(*[F.col(c) for c in ("cx", "cy", "w", "h")], F.col("width"), F.col("height"))
    each = vehicles.join(decoded, "image_id").withColumn("box", F.struct(*[v.alias(k) for v, k in zip(window, CORNERS)]))
    crops = cut(vehicles.select("image_id", "vehicle_id").join(each.select("image_id", "vehicle_id", (F.col("box.x2") - F.col("box.x1")).alias("crop_w"), (F.col("box.y2") - F.col("box.y1")).alias("crop_h")), ["image_id", "vehicle_id"], "left"))
    content = imaging.cropped("data", "height", "width", "channels", "box")
    asked = external.ask_service(each.select(F.struct("image_id", "vehicle_id").alias("at"), content.alias("content")).where("content IS NOT NULL"), named(service), "at")
    plates = asked.select("at.*", F.posexplode(D.parse_payload(F.col("payload"))).alias("plate_idx", "p")).select("image_id", "vehicle_id", "plate_idx", "p.plate_confidence", "p.ocr_confidence", "p.plate")
    plates = cut(plates)
    labelled = lines.select(F.col("stem").alias("image_id")).distinct().withColumn("has_label", F.lit(True))
    state = pending.select(F.col("stem").alias("image_id")).distinct().join(labelled, "image_id", "left").join(decoded.select("image_id", F.lit(True).alias("readable")).distinct(), "image_id", "left")
    state = state.select("image_id", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("has_label", "readable")])
    verdict = D.validate(state, crops, plates).join(D.best_plates(plates, "image_id", "vehicle_id").select("image_id", "vehicle_id", "plate_confidence", "ocr_confidence"), ["image_id", "vehicle_id"], "left")
    named_ = verdict.join(pending.select(F.col("stem").alias("image_id"), F.col("name").alias("image"), "path"), "image_id")
    decided, counts = cut_counted(named_, "reason", ("ok", *INVALID))
    gone = decided.where("NOT accepted")
    zero = F.when(F.col("reason") == "no_plate_detected", F.lit(0.0))
    sinks.append_removals(gone.select("image", "reason", "vehicle_id", *[F.coalesce(F.when(F.col("reason") == "plate_below_threshold", F.col(c)), zero).alias(c) for c in ("plate_confidence", "ocr_confidence")]), f"{out}/removed")
    if aside:
        none, nothing = F.lit(None).cast("string"), F.lit(None).cast("binary")
        texts = files.label_texts(spark, labels).withColumnRenamed("stem", "image_id")
        pairs = gone.select(F.concat(F.lit("removed_pairs/images/"), "image").alias("name"), nothing.alias("content"), F.col("path").alias("source"))
        pairs = pairs.unionByName(gone.join(texts, "image_id").select(F.concat(F.lit("removed_pairs/labels/"), "image_id", F.lit(".txt")).alias("name"), F.col("text").cast("binary").alias("content"), none.alias("source")).distinct())
        dataset.save_files(pairs, out, link)
    if record:
        decided.where("accepted").select("image").write.mode("append").text(record)
    return counts_of(spark, counts, "reason")


def relabel(spark: SparkSession, images: str, labels: str, out: str, model: str, conf: float = 0.25, pad: float = 0.15, fallback: str = "car", crops_of_each: int = 0) -> DataFrame:
    """Labels of five classes as labels of seven below ``out``/labels; the model's crop of a box decides between two.

    Decisions go to ``out``/decisions as CSV, what they rest on is the result, with sub-totals. Boxes without an
    image, with too small a crop or without a detection get the ``fallback`` (car or other). With ``crops_of_each``
    so many crops of each reason lie below ``out``/review.
    """
    if fallback not in ("car", "other"):
        raise ValueError("the fallback is car or other")
    lines = L.parse(files.label_lines(spark, labels)).where(L.strict())
    boxes = cut(lines.select(F.col("stem").alias("image_id"), F.col("line_no").alias("box_idx"), "cls", "cx", "cy", "w", "h"))
    found = files.images(spark, images).select("name", "stem")
    chosen = files.find_images(found, boxes.select(F.col("image_id").alias("stem")).distinct()).select(F.col("stem").alias("image_id"), F.col("image").alias("name"))
    decoded = chosen.join(pixels_of(spark, images), "name", "left")
    states = cut(D.crop_states(boxes, decoded.select("image_id", "width", "height"), pad))
    window = F.struct(*CORNERS)
    cropped = states.where("crop = 'ok'").join(decoded, "image_id").select(F.struct("image_id", "box_idx").alias("at"), imaging.cropped("data", "height", "width", "channels", window).alias("content"))
    cropped = cut(cropped) if crops_of_each else cropped
    seen = external.detect(cropped, named(model), "at").where((F.col("conf") >= conf) & D.is_vehicle(F.col("cls"))).select("at.*", "det_idx", "cls", "conf")
    seen = cut(seen)
    best = D.best_detection(seen)
    relabelled = cut(D.relabel(boxes, best, fallback == "car"))
    row = F.concat_ws(" ", F.col("new_cls").cast("string"), *[X.fixed(F.col(c), 6) for c in ("cx", "cy", "w", "h")])
    text = relabelled.groupBy("image_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("box_idx", row.alias("line")))), lambda x: x["line"]), "\n").alias("text"))
    every = files.label_texts(spark, labels).select(F.col("stem").alias("image_id")).join(text, "image_id", "left")
    sinks.write_files(every.select(F.concat(F.lit("labels/"), "image_id", F.lit(".txt")).alias("name"), F.when(F.col("text").isNotNull(), F.concat("text", F.lit("\n"))).otherwise(F.lit("")).alias("content")), out)
    names = F.create_map(*[F.lit(x) for kv in D.COCO_VEHICLES.items() for x in kv])
    sure = seen.groupBy("image_id", "box_idx").agg(F.max("conf").alias("conf"))
    log = relabelled.where("how <> 'direct'").join(states.where("crop = 'ok'").select("image_id", "box_idx"), ["image_id", "box_idx"]).join(best, ["image_id", "box_idx"], "left").join(sure, ["image_id", "box_idx"], "left")
    sinks.write_csv(log.select(F.col("image_id").alias("stem"), F.col("cls").alias("old_class"), F.col("new_cls").alias("new_class"), F.coalesce(F.try_element_at(names, F.col("best_cls")), F.lit("none")).alias("coco_class"), X.fixed(F.coalesce("conf", F.lit(0.0)), 3).alias("conf")), f"{out}/decisions")
    if crops_of_each:
        kind = F.when(F.col("how") == "fallback", "fallback").when(F.col("new_cls").isin(*[car for car, _ in D.DECIDE.values()]), "car").otherwise("other")
        bucketed = cropped.select("at.*", "content").join(relabelled.select("image_id", "box_idx", kind.alias("bucket")), ["image_id", "box_idx"]).withColumn("crop", F.format_string("%s_%d_%s", "image_id", "box_idx", "bucket"))
        picked = C.crops_to_review(bucketed, "bucket", "crop", crops_of_each)
        sinks.write_files(picked.select(F.format_string("review/%s/%s.png", "bucket", "crop").alias("name"), "content"), out)
    return D.relabel_reasons(relabelled, states).orderBy("level", "how", "why")
