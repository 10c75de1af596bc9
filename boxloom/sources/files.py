"""Scans: images, label files, address lists, transactions, and the records of earlier runs."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxloom.functions import geometry as G
from boxloom.functions import labels as L
from boxloom.functions import text as X
from boxloom.sources import filesets


def images(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(path, name, stem, length) of image files; contents are not read unless a column ``content`` is asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(folder)
    name = X.file_name(F.col("path"))
    return files.withColumn("name", name).withColumn("stem", X.stem(F.col("name"))).where(X.is_image(F.col("name"))).select("path", "name", "stem", "length", "content")


def source_images(spark: SparkSession, folder: str) -> DataFrame:
    """Images below a folder named ``images`` and none named ``images_no_ocr``; if there are none, those of the folder itself."""
    parts = F.split("path", "/")
    found = images(spark, folder, True).where(F.array_contains(parts, "images") & ~F.array_contains(parts, "images_no_ocr"))
    return found if not found.isEmpty() else images(spark, folder)


def decoded(spark: SparkSession, folder: str) -> DataFrame:
    """(path, height, width, channels, data) of images that Spark's own reader decodes; width is null for corrupt ones."""
    raw = spark.read.format("image").load(folder).select("image.*")
    good = F.col("width") > 0
    return raw.select(F.col("origin").alias("path"), F.when(good, F.col("height")).alias("height"), F.when(good, F.col("width")).alias("width"), F.col("nChannels").alias("channels"), "data")


def label_texts(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(stem, text) of text files, a row each, empty ones included."""
    found = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    texts = found.select(X.stem(X.file_name(F.col("_metadata.file_path"))).alias("stem"), F.col("value").alias("text"))
    # empty files are left out by that reader
    empty = filesets.listed(spark, folder, recursive).where("size = 0 AND name LIKE '%.txt'")
    return texts.unionByName(empty.select(X.stem(F.col("name")).alias("stem"), F.lit("").alias("text")))


def label_lines(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(stem, line_no, line) of text files; an empty file is one empty line."""
    return label_texts(spark, folder, recursive).select("stem", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("line_no", "line"))


def boxes(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(stem, line_no, cls, cx, cy, w, h) of the lines that are whole boxes; the others are skipped."""
    return L.parse(label_lines(spark, folder, recursive)).where(L.strict()).select("stem", "line_no", "cls", "cx", "cy", "w", "h")


def find_images(names: DataFrame, stems: DataFrame, order: tuple[str, ...] = ("jpg", "jpeg", "png", "webp", "bmp", "tif", "tiff")) -> DataFrame:
    """``stems`` with the image of each stem whose extension, in either case, comes first in ``order``; null without one.

    Of names that differ in case only the first in their order is taken.
    """
    rank = F.array_position(F.array(*map(F.lit, order)), F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)))
    best = names.withColumn("_r", rank).where("_r > 0").groupBy("stem").agg(F.min_by("name", F.struct("_r", "name")).alias("image"))
    return stems.join(best, "stem", "left")


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, url): distinct lines that begin with http, the first of equal ones. A missing file raises."""
    return urls(spark, path).groupBy("url").agg(F.min("line_no").alias("line_no")).select("line_no", "url")


def transactions(spark: SparkSession, path: str) -> DataFrame:
    """The two address columns of a CSV with a header; a missing column is null."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in ("entry_image_url", "exit_image_url")])


def dedup_records(spark: SparkSession, path: str) -> DataFrame:
    """(name, sha, phash) of an append-only JSON-lines record: the last of each name; broken lines are skipped."""
    rows = spark.read.schema("name string, sha string, phash decimal(20,0), _corrupt_record string").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    placed = rows.withColumn("at", F.monotonically_increasing_id()).where("_corrupt_record IS NULL AND name IS NOT NULL")
    signed = F.expr("CAST(CASE WHEN phash >= 9223372036854775808BD THEN phash - 18446744073709551616BD ELSE phash END AS BIGINT)")
    last = placed.withColumn("n", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("at")))).where("n = 1")
    return last.select("name", "sha", signed.alias("phash"))


def name_records(spark: SparkSession, path: str) -> DataFrame:
    """Distinct non-blank names of a text record."""
    return spark.read.text(path).select(X.strip(F.col("value")).alias("name")).where("name <> ''").distinct()


def sorted_images(spark: SparkSession, folder: str, limit: int = 0, recursive: bool = False) -> DataFrame:
    """Images in the order of their names, the first ``limit`` of them unless it is 0; contents are not read."""
    listed = images(spark, folder, recursive).drop("content").orderBy("name", "path")
    return listed.limit(limit) if limit else listed


def count_images(spark: SparkSession, folder: str, recursive: bool = False) -> int:
    """How many image files a folder has; contents are not read."""
    return images(spark, folder, recursive).select("path").count()


def urls(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, url): lines that begin with http, equal ones as often as they are there.

    Many tasks read one list; line_no rises from line to line of a file, but skips numbers.
    """
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), X.strip(F.col("value")).alias("url"))
    return lines.where(F.col("url").startswith("http"))


def _png(b: bytes) -> tuple[int, int] | None:
    return struct.unpack(">II", b[16:24]) if b[:8] == b"\x89PNG\r\n\x1a\n" and b[12:16] == b"IHDR" else None


def _jpeg(b: bytes) -> tuple[int, int] | None:
    at = 2
    while b[:2] == b"\xff\xd8" and at + 9 <= len(b) and b[at] == 0xFF:
        kind = b[at + 1]
        if kind == 0xFF or kind == 1 or 0xD0 <= kind <= 0xD8:  # fill bytes and marks without a body
            at += 1 if kind == 0xFF else 2
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):  # a frame
            height, width = struct.unpack(">HH", b[at + 5 : at + 9])
            return width, height
        else:
            at += 2 + struct.unpack(">H", b[at + 2 : at + 4])[0]
    return None


def _bmp(b: bytes) -> tuple[int, int] | None:
    if b[:2] != b"BM" or len(b) < 26:
        return None
    width, height = struct.unpack("<ii", b[18:26])
    return width, abs(height)


def _gif(b: bytes) -> tuple[int, int] | None:
    return struct.unpack("<HH", b[6:10]) if b[:6] in (b"GIF87a", b"GIF89a") and len(b) >= 10 else None


def _webp(b: bytes) -> tuple[int, int] | None:
    if b[:4] != b"RIFF" or b[8:12] != b"WEBP" or len(b) < 30:
        return None
    if b[12:16] == b"VP8X":
        return 1 + int.from_bytes(b[24:27], "little"), 1 + int.from_bytes(b[27:30], "little")
    if b[12:16] == b"VP8L":
        bits = int.from_bytes(b[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
    if b[12:16] == b"VP8 ":
        width, height = struct.unpack("<HH", b[26:30])
        return width & 0x3FFF, height & 0x3FFF
    return None


def _tiff(b: bytes) -> tuple[int, int] | None:
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(b[:4])
    if order is None or len(b) < 8:
        return None
    at = struct.unpack(order + "I", b[4:8])[0]
    found: dict[int, int] = {}
    for k in range(struct.unpack(order + "H", b[at : at + 2])[0] if len(b) >= at + 2 else 0):
        entry = b[at + 2 + 12 * k : at + 14 + 12 * k]
        if len(entry) < 12:
            break
        tag, kind = struct.unpack(order + "HH", entry[:4])
        if tag in (256, 257):
            found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), entry[8 : 10 if kind == 3 else 12])[0]
    return (found[256], found[257]) if len(found) == 2 else None


def size_in_header(content: bytes) -> tuple[int, int] | None:
    """(width, height) that the header of an image file says; None for what is none or is cut short. No pixel is decoded."""
    for read in (_png, _jpeg, _bmp, _gif, _webp, _tiff):
        try:
            if (size := read(content)) and min(size) > 0:
                return size
        except struct.error:
            continue
    return None


def image_sizes(rows: DataFrame, key: str = "image") -> DataFrame:
    """(key, width, height) of files in column ``content``, from their headers; null where there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [(c and size_in_header(c)) or (None, None) for c in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), *[pa.array([s[k] for s in sizes], pa.int32()) for k in (0, 1)]], [key, "width", "height"])

    return rows.select(key, "content").mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, width int, height int")


def ground_truth(boxes_: DataFrame, sizes: DataFrame, classes: dict[int, int] | None = None, only: int | None = None) -> DataFrame:
    """(image_id, box_idx, cls, x1, y1, x2, y2): boxes (see ``boxes``) in pixels of the ``sizes`` (stem, width, height) of their images.

    Classes go through a class map, and only one of them stays where ``only`` is given. Boxes of images
    without a size are left out. box_idx counts the whole boxes of a file from 0.
    """
    cls = L.remap(F.col("cls"), classes or {})
    sized = boxes_.withColumn("cls", cls).join(sizes.where("width > 0 AND height > 0").select("stem", "width", "height"), "stem")
    x1, y1, x2, y2 = G.to_xyxy(F.col("cx"), F.col("cy"), F.col("w"), F.col("h"), F.col("width"), F.col("height"))
    place = (F.row_number().over(Window.partitionBy("stem").orderBy("line_no")) - 1).cast("int")
    out = sized.select(F.col("stem").alias("image_id"), place.alias("box_idx"), "cls", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    return out if only is None else out.where(F.col("cls") == only)


def detections(spark: SparkSession, path: str, classes: dict[int, int] | None = None, only: int | None = None) -> DataFrame:
    """Detections of a Parquet table or a CSV with a header (image_id, x1, y1, x2, y2, conf, cls), det_idx counted in falling confidence."""
    rows = spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path)
    box = [F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2", "conf")]
    typed = rows.select(F.col("image_id").cast("string").alias("image_id"), *box, L.remap(F.col("cls").cast("int"), classes or {}).alias("cls"))
    if only is not None:
        typed = typed.where(F.col("cls") == only)
    place = F.row_number().over(Window.partitionBy("image_id").orderBy(F.desc("conf"), "x1", "y1", "x2", "y2", "cls")) - 1
    return typed.withColumn("det_idx", place.cast("int"))
