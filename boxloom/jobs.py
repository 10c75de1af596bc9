"""The jobs of the command line: each reads folders or tables, composes operators and writes its results.

Every job gives a small table for the console. What runs outside of Spark, a detector or a plate service, is
named as ``module:function``, a function that makes a client once for each partition.
"""

from __future__ import annotations

import importlib
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from boxloom.functions import geometry as G
from boxloom.functions import imaging
from boxloom.functions import labels as L
from boxloom.functions import text as X
from boxloom.functions.session import cut, cut_counted
from boxloom.operators import curation as C
from boxloom.operators import decisions as D
from boxloom.operators import dedup as U
from boxloom.operators import matching as M
from boxloom.operators import metrics as K
from boxloom.operators.hash_index import HashIndex
from boxloom.sources import dataset, external, files, filesets, sinks
from boxloom.streaming import incremental

VEHICLE_CONF = 0.4
LABEL = ("labeled", "no_box", "no_plate", "too_many", "read_failed")
PLATES = ("plated", "no_plate", "api_fail", "size_fail")
REASONS = ("ok", "exact_duplicate", "near_duplicate", "corrupt_image")


def named(function: str) -> Callable:
    """``module:function``."""
    module, _, name = function.partition(":")
    return getattr(importlib.import_module(module), name)


def http_client() -> Callable[[str], bytes]:
    def get(url: str) -> bytes:
        with urllib.request.urlopen(url, timeout=30) as answer:  # noqa: S310  http and https only, see urls
            return answer.read()

    return get


# ---- images and their places --------------------------------------------------------------------------


def extract_urls(spark: SparkSession, csv: str, out: str) -> DataFrame:
    """The distinct valid addresses of a CSV of transactions, in order, as a list."""
    urls = cut(C.urls_of(files.transactions(spark, csv), "entry_image_url", "exit_image_url"))
    sinks.write_url_list(urls, out)
    return urls.agg(F.count("*").alias("urls"))


def download(spark: SparkSession, urls: str, out: str, client: str = "boxloom.jobs:http_client", tries: int = 3, partitions: int = 32) -> DataFrame:
    """Fetches the addresses of a list that are not in ``out`` yet; failures go to ``out`` + ``_failed`` as CSV.

    A file is there as a whole or not at all, so a job that broke off goes on where it was. What is left to
    fetch is a list of its own, ``out`` + ``_wanted.txt``, of which each task reads a range.
    """
    place = out.rstrip("/")
    wanted = files.url_list(spark, urls).select("url", X.url_file_name(F.col("url")).alias("name")).where("name <> ''")
    wanted = C.pending(wanted, dataset.listing(spark, out), "name")
    first = cut(wanted.groupBy("name").agg(F.min("url").alias("url")))  # one file for a name
    dataset.save_lines(first.select("url").orderBy("url"), f"{place}_wanted.txt")
    fetched = spark.read.format("fetched").option("urls", filesets.reachable(spark, f"{place}_wanted.txt"))
    got = cut(fetched.option("client", client).option("tries", tries).option("partitions", partitions).load().join(first, "url"))
    sinks.write_files(got.where("status = 'ok'").select("name", "content"), out)
    sinks.write_csv(got.where("status <> 'ok'").select("url", "error"), f"{place}_failed")
    return got.groupBy("status").agg(F.count("*").alias("n"))


def pixels_of(spark: SparkSession, images: str) -> DataFrame:
    return files.decoded(spark, images).withColumn("name", X.file_name(F.col("path")))


def remove_duplicates(spark: SparkSession, images: str, out: str, within: int = 6, state: str | None = None, records: str | None = None) -> DataFrame:
    """The reason for each image of a folder: ok, exact or near duplicate of a kept one, or corrupt.

    With ``state`` what earlier runs have kept counts too, and what this one keeps is added: an index of hashes. A
    new one begins with the ``records`` of an earlier tool (JSON lines of name, sha and phash), where these are given.
    """
    hashed = pixels_of(spark, images).select("name", imaging.phash("data", "height", "width", "channels").alias("hash"))
    rows = files.images(spark, images).select("name", "content").join(hashed, "name", "left")
    if state is None:
        decided = U.curated(rows, "name", "content", "hash", within)
    else:
        named_ = cut(rows.select(F.col("name").alias("key"), F.sha2("content", 256).alias("sha"), "hash"))
        index = HashIndex(spark, state, within)
        if records is not None and not index.manifest.version():
            index.adopt(files.dedup_records(spark, records).withColumnRenamed("phash", "hash"))
        decided = index.curate(named_).withColumnRenamed("key", "name")
    decided, counts = cut_counted(decided.select("name", "reason"), "reason", REASONS)
    sinks.write_csv(decided, out)
    return counts_of(spark, counts, "reason")


def brightness(spark: SparkSession, images: str, out: str, threshold: float = 40.0, per_band: int = 25, apply: bool = False, link: bool = False) -> DataFrame:
    """Brightness of each image, its bands with samples, percentiles, and the images below the threshold.

    With ``apply`` those lie below ``out``/too_dark and the other readable ones below ``out``/bright, as copies or links.
    """
    scores = cut(pixels_of(spark, images).select("name", imaging.brightness("data", "height", "width", "channels").alias("brightness")))
    bands = cut(C.bands(scores, "brightness"))
    for name, rows in (("brightness", scores), ("bands", bands), ("samples", C.band_samples(scores, "name", "brightness", per_band)), ("percentiles", C.percentiles(scores, "brightness")), ("dark", scores.where(C.dark(F.col("brightness"), threshold)))):
        sinks.write_csv(rows, f"{out}/{name}")
    if apply:
        folder = F.when(C.dark(F.col("brightness"), threshold), "too_dark/").otherwise("bright/")
        dealt = scores.where("brightness >= 0").join(files.images(spark, images).select("name", "path"), "name")
        dataset.save_files(dealt.select(F.concat(folder, "name").alias("name"), F.lit(None).cast("binary").alias("content"), F.col("path").alias("source")), out, link)
    return bands.orderBy("band")


# ---- data sets ----------------------------------------------------------------------------------------


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    """(stem, text, nonempty, classes) of label files."""
    lines = L.parse(files.label_lines(spark, folder))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    return lines.groupBy("stem").agg(text.alias("text"), F.bool_or(L.any_text(F.col("line"))).alias("nonempty"), F.collect_set("cls").alias("classes"))


def _stems(spark: SparkSession, images: str) -> DataFrame:
    """The image of each stem: of several files, the one whose kind comes first."""
    found = files.images(spark, images).select("path", "name", "stem")
    best = files.find_images(found, found.select("stem").distinct())
    return best.join(found.select(F.col("name").alias("image"), F.col("path")), "image").select("stem", F.col("image").alias("name"), F.col("path").alias("image"))


def counts_of(spark: SparkSession, counts: dict[str, int], name: str, number: str = "n") -> DataFrame:
    return spark.createDataFrame(sorted(counts.items()), f"{name} string, {number} long")


def _source(spark: SparkSession, source: str) -> DataFrame | None:
    """(name, stem, image, text, nonempty) of a folder with ``images`` and ``labels``; None if it has no images folder."""
    if not dataset.exists(spark, f"{source}/images"):
        return None
    labels = _labels(spark, f"{source}/labels").select("stem", "text", "nonempty")
    return files.images(spark, f"{source}/images").select("name", "stem", F.col("path").alias("image")).join(labels, "stem", "left")


def merge(spark: SparkSession, sources: list[str], out: str, images: str = "reference") -> DataFrame:
    """Adds data sets (folders with ``images`` and ``labels``) to one; what it holds and the first of equal names win.

    A source that is not there is skipped. ``images``: reference, link or copy (see ``dataset.Grown``).
    """
    every = None
    for rank, source in enumerate(sources):
        rows = _source(spark, source)
        if rows is not None:
            rows = rows.withColumn("rank", F.lit(rank)).withColumn("source", F.lit(source))
            every = rows if every is None else every.unionByName(rows)
    counts = dataset.Grown(spark, out, images).merge(every, ["rank", "name"]) if every is not None else {}
    return counts_of(spark, counts, "outcome")


def split(spark: SparkSession, images: str, labels: str, out: str, ratios: tuple[float, float, float] = (0.7, 0.2, 0.1), seed: int = 42, by_hash: bool = True, names: dict[int, str] | None = None, layout: str = "by_kind", link: bool = False) -> DataFrame:
    """Valid pairs of images and labels dealt out to train, val and test, with images, labels, lists and a configuration.

    ``images`` is a folder, or the root of a grown data set. ``layout``: by_kind (images/train) or by_split
    (train/images). Images are copied, or linked to with ``link``.
    """
    labelled = _labels(spark, labels)
    stems = dataset.Grown(spark, images).held().where("image IS NOT NULL").select("stem", "name", "image") if dataset.is_grown(spark, images) else _stems(spark, images)
    pairs = cut(C.gather_pairs(stems, labelled).where("outcome = 'valid'").join(labelled.select("stem", "text", "classes"), "stem"))
    parts = tuple(zip(dataset.SPLITS, ratios))
    dealt = cut(C.split_by_hash(pairs, "name", parts, seed) if by_hash else C.split_seeded(pairs, "name", parts, seed))
    counts = dataset.save_splits(dealt.select("split", "stem", "name", "image", "text"), out, layout, link)
    seen = dealt.select(F.explode("classes").alias("cls")).distinct()
    every = [r.cls for r in seen.where("cls IS NOT NULL").collect()]  # a number for each class
    root = filesets.reachable(spark, out).removeprefix("file://")
    text = sinks.data_yaml(dict(enumerate(sinks.class_names(every, names or {}))), root, dataset.split_folders(layout))
    sinks.write_files(spark.createDataFrame([("data.yaml", text)], "name string, content string"), out)
    return counts_of(spark, counts, "split", "images")


def label(spark: SparkSession, images: str, out: str, orientation: str, model: str, conf: float = VEHICLE_CONF, service: str | None = None, rejects: bool = False) -> DataFrame:
    """Labels of a batch: detections of vehicles, decided image by image, with plates seen by the service where one is given.

    The service gets the crop of each vehicle. With ``rejects`` the images without a label are copied below
    ``out``/rejected, by the reason.
    """
    rows = files.images(spark, images).select(F.col("name").alias("image_id"), "stem", "content")
    sizes = cut(files.image_sizes(rows, "image_id"))
    found = external.detect(rows, named(model), "image_id")
    boxes = cut(D.suppress(found.where(D.is_vehicle(F.col("cls"))), conf))
    if service is None:
        seen = boxes.select("image_id", "det_idx", F.lit(True).alias("visible"))
    else:
        seen = plates_in_crops(spark, images, boxes, service)
    images_ = sizes.select("image_id", F.col("width").isNotNull().alias("readable"), "width", "height")
    decided, counts = cut_counted(_decided(images_, boxes, seen), "status", LABEL)
    kept = boxes.join(decided.where("status = 'labeled'").select("image_id"), "image_id").join(sizes, "image_id")
    corners, size = [F.col(c) for c in ("x1", "y1", "x2", "y2")], (F.col("width"), F.col("height"))
    kept = kept.where((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) >= D.BOX_AREA * size[0] * size[1])
    yolo = dict(zip(("cx", "cy", "w", "h"), G.to_yolo(*corners, *size)))
    text = sinks.label_text(kept.select("image_id", F.col("det_idx").alias("box_idx"), D.batch_class(F.col("cls"), orientation).alias("cls"), *[v.alias(k) for k, v in yolo.items()]))
    sinks.write_files(text.select(F.concat(F.lit("labels/"), X.stem(F.col("image_id")), F.lit(".txt")).alias("name"), F.col("text").alias("content")), out)
    sinks.write_files(rows.join(decided.where("status = 'labeled'"), "image_id").select(F.concat(F.lit("images/"), "image_id").alias("name"), "content"), out)
    if rejects:
        aside = decided.where("status <> 'labeled'").join(files.images(spark, images).select(F.col("name").alias("image_id"), "path"), "image_id")
        dataset.save_files(aside.select(F.concat(F.lit("rejected/"), "status", F.lit("/"), "image_id").alias("name"), F.lit(None).cast("binary").alias("content"), F.col("path").alias("source")), out)
    sinks.append_record(decided, f"{out}/label_log")
    return counts_of(spark, counts, "status")


def plates_in_crops(spark: SparkSession, images: str, boxes: DataFrame, service: str) -> DataFrame:
    """(image_id, det_idx, visible): whether the service finds a plate in the crop of a box; its own crop for each.

    Crops are cut on the workers, between detector and service. A box of less than a pixel, or of an image that
    cannot be read, has no visible plate, nor has one whose call fails.
    """
    window = G.crop_box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], F.col("width"), F.col("height"))
    each = boxes.join(pixels_of(spark, images).where("width IS NOT NULL").withColumnRenamed("name", "image_id"), "image_id")
    each = each.withColumn("box", window).where("box IS NOT NULL")
    content = imaging.cropped("data", "height", "width", "channels", "box")
    rows = each.select(F.struct("image_id", "det_idx").alias("at"), content.alias("content")).where("content IS NOT NULL")
    asked = external.ask_service(rows, named(service), "at").select("at", F.explode(D.parse_payload(F.col("payload"))).alias("p"))
    best = asked.groupBy("at").agg(F.max("p.plate_confidence").alias("best"))
    return boxes.select("image_id", "det_idx", F.struct("image_id", "det_idx").alias("at")).join(best, "at", "left").select("image_id", "det_idx", F.coalesce(F.col("best") >= D.PLATE_CONF, F.lit(False)).alias("visible"))


def _decided(images: DataFrame, boxes: DataFrame, seen: DataFrame) -> DataFrame:
    """``decisions.label_decision`` for images of different sizes: corners as if all were one by one."""
    sized = boxes.join(images.select("image_id", "width", "height"), "image_id")
    unit = 1_000_000
    scaled = sized.select("image_id", "det_idx", "conf", "cls", *[(F.col(c) / F.col(m) * unit).alias(c) for c, m in (("x1", "width"), ("y1", "height"), ("x2", "width"), ("y2", "height"))])
    return D.label_decision(images.select("image_id", "readable"), scaled, seen, unit, unit)


def add_dataset(spark: SparkSession, name: str, orientation: str, base: str, merged: str, model: str, csv: str | None = None, images: str | None = None, skip_download: bool = False, plates: str | None = None, client: str | None = None, conf: float = VEHICLE_CONF) -> DataFrame:
    """A new batch from addresses or images to the merged data set: extract, download, label, merge, plates."""
    if (csv is None) == (images is None):
        raise ValueError("either transactions or images are needed")
    if images is None:
        images = f"{base}/{name}_images"
        extract_urls(spark, csv, f"{base}/{name}_urls")
        if not skip_download:
            download(spark, f"{base}/{name}_urls", images, *([client] if client else []))
    label(spark, images, f"{base}/{name}_dataset", orientation, model, conf)
    counts = merge(spark, [f"{base}/{name}_dataset"], merged)
    if plates is not None:
        add_plates(spark, images, f"{merged}/labels", plates)
    return counts


def add_plates(spark: SparkSession, images: str, labels: str, service: str, record: str | None = None) -> DataFrame:
    """Plate boxes of a service in the label files of a folder, in place of those there; images without a label are left out.

    With ``record`` images that are done are not asked for again; those whose call or size failed are.
    """
    rows = files.images(spark, images).select(F.col("stem").alias("image_id"), "content")
    lines = L.parse(files.label_lines(spark, labels)).withColumnRenamed("stem", "image_id")
    rows = rows.join(lines.select("image_id").distinct(), "image_id", "left_semi")

    def ask(rows: DataFrame) -> DataFrame:
        asked = cut(external.ask_service(rows, named(service), "image_id"))
        sizes = files.image_sizes(rows, "image_id").join(asked.select("image_id", F.col("api_error").isNotNull().alias("failed")), "image_id")
        plates = asked.select("image_id", F.posexplode(D.parse_payload(F.col("payload"))).alias("plate_idx", "p")).select("image_id", "plate_idx", F.col("p.plate_confidence").alias("confidence"), F.col("p.bbox").alias("bbox"))
        return D.plate_status(sizes, plates)

    def write(status: DataFrame) -> None:
        found = status.where("status = 'plated'").select("image_id", F.posexplode("boxes").alias("k", "b"))
        added = found.select("image_id", (F.lit(1_000_000) + F.col("k")).alias("line_no"), F.concat_ws(" ", F.lit("4"), *[X.fixed(F.col(f"b.{c}"), 6) for c in ("cx", "cy", "w", "h")]).alias("line"))
        kept = lines.where(L.any_text(F.col("line"))).select("image_id", "line_no", "line", F.coalesce("cls", F.lit(-1)).alias("cls"))
        touched = D.upsert_plates(kept, added).join(status.where("status = 'plated'").select("image_id"), "image_id", "left_semi")
        text = touched.groupBy("image_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text"))
        sinks.write_files(cut(text).select(F.concat("image_id", F.lit(".txt")).alias("name"), F.col("text").alias("content")), labels)

    if record is None:
        status, counts = cut_counted(ask(rows), "status", PLATES)
        write(status)
    else:
        status = incremental.retry_failures(record, rows, "image_id", ask, sink=write)
        counts = {r.status: r.n for r in status.groupBy("status").agg(F.count("*").alias("n")).collect()}  # one row a status
    return counts_of(spark, counts, "status")


def recover_plates(spark: SparkSession, images: str, labels: str, out: str, model: str, conf: float = 0.45, overlap: float = 0.45) -> DataFrame:
    """Labels with the plates that a local model finds, below ``out``/recovered, and lists of the images recovered and rejected."""
    rows = files.images(spark, images).select(F.col("stem").alias("image_id"), "path", "content")
    sizes = files.image_sizes(rows, "image_id")
    lines = L.parse(files.label_lines(spark, labels)).withColumnRenamed("stem", "image_id")
    found = D.suppress(external.detect(rows, named(model), "image_id"), conf, overlap)
    decided = cut(D.recover_plates(sizes, lines, found).join(rows.select("image_id", "path"), "image_id"))
    done = decided.where("status = 'recovered'")
    sinks.write_files(done.select(F.concat(F.lit("labels/"), "image_id", F.lit(".txt")).alias("name"), F.concat(F.array_join("lines", "\n"), F.lit("\n")).alias("content")), f"{out}/recovered")
    for status in ("recovered", "rejected"):
        decided.where(F.col("status") == status).select("path").orderBy("path").write.mode("overwrite").text(f"{out}/{status}.list")
    return decided.groupBy("status").agg(F.count("*").alias("n"))


def draw(spark: SparkSession, images: str, labels: str, out: str, detections: str | None = None, limit: int = 0, captions: bool = False, names: dict[int, str] | None = None) -> DataFrame:
    """PNG copies of images with their boxes, and of detections where they are given; counts what is drawn of each class.

    With ``captions`` each box says its class, and its confidence if it is a detection.
    """
    rows = files.images(spark, images).select(F.col("stem").alias("image"), "content")
    gt = files.ground_truth(files.boxes(spark, labels), files.image_sizes(rows).withColumnRenamed("image", "stem"))
    box = ["x1", "y1", "x2", "y2"]
    every = gt.select("image_id", F.lit("gt").alias("kind"), "cls", *box, F.lit(None).cast("double").alias("conf"))
    if detections is not None:
        every = every.unionByName(files.detections(spark, detections).select("image_id", F.lit("pred").alias("kind"), "cls", *box, "conf"))
    if captions:
        pairs = F.create_map(*[F.lit(x) for kv in (names or {-1: ""}).items() for x in kv])
        name = F.coalesce(F.try_element_at(pairs, F.col("cls")), F.concat(F.lit("class_"), F.col("cls").cast("string")))
        every = every.withColumn("caption", F.concat_ws(" ", name, X.fixed(F.col("conf"), 2)))
        box.append("caption")
    listed = files.sorted_images(spark, images, limit).select("name")
    drawn_ = pixels_of(spark, images).join(listed, "name", "left_semi").withColumn("image_id", X.stem(F.col("name")))
    every = cut(every.join(drawn_.select("image_id"), "image_id", "left_semi"))
    per = every.groupBy("image_id").agg(F.collect_list(F.struct("kind", *box)).alias("boxes"))
    made = drawn_.join(per, "image_id", "left").select(F.concat("image_id", F.lit(".png")).alias("name"), imaging.drawn("data", "height", "width", "channels", "boxes").alias("content"))
    sinks.write_files(made.where("content IS NOT NULL"), out)
    return every.groupBy("kind", "cls").agg(F.count("*").alias("boxes")).orderBy("kind", "cls")


def crops(spark: SparkSession, images: str, labels: str, out: str, pad: float = 0.15, least: int = 8) -> DataFrame:
    """PNG crops of all boxes with ``pad`` of their size around them; those with a side below ``least`` pixels are left out."""
    boxes = files.boxes(spark, labels).withColumnRenamed("stem", "image_id")
    decoded = pixels_of(spark, images).where("width IS NOT NULL").withColumn("image_id", X.stem(F.col("name")))
    window = G.padded_crop(*[F.col(c) for c in ("cx", "cy", "w", "h")], F.col("width"), F.col("height"), pad)
    each = decoded.join(boxes, "image_id").withColumn("box", F.struct(*[v.alias(k) for v, k in zip(window, ("x1", "y1", "x2", "y2"))]))
    good = each.where((F.col("box.x2") - F.col("box.x1") >= least) & (F.col("box.y2") - F.col("box.y1") >= least))
    made = good.select(F.format_string("%d/%s_%d.png", "cls", "image_id", "line_no").alias("name"), imaging.cropped("data", "height", "width", "channels", "box").alias("content"))
    seen = Observation("crops")
    sinks.write_files(made.where("content IS NOT NULL").observe(seen, F.count("*").alias("crops")), out)
    return spark.createDataFrame([(seen.get["crops"],)], "crops long")


# ---- evaluation ---------------------------------------------------------------------------------------


def sides(spark: SparkSession, images: str, labels: str, detections: str, class_map: str = "", only: int | None = None) -> tuple[DataFrame, DataFrame]:
    classes = L.parse_class_map(class_map)
    rows = files.images(spark, images).select(F.col("stem").alias("image"), "content")
    sizes = files.image_sizes(rows).withColumnRenamed("image", "stem")
    gt = files.ground_truth(files.boxes(spark, labels), sizes, classes, only)
    return cut(gt), cut(files.detections(spark, detections, classes, only))


def classification(spark: SparkSession, n_classes: int = 4, least: float = 0.3, **where) -> DataFrame:
    """Accuracy of each class and over all of them (cls is null there)."""
    per = cut(K.class_accuracy(K.confusion(M.best_class(*sides(spark, **where), least), n_classes), n_classes))
    return per.unionByName(K.overall_accuracy(per), allowMissingColumns=True)


def metrics(spark: SparkSession, conf: float = 0.65, **where) -> DataFrame:
    """Mean average precisions, and precision and recall from ``conf`` on."""
    gt, pred = sides(spark, **where)
    return K.mean_average_precision(gt, pred).join(K.operating_point(gt, pred, conf))
