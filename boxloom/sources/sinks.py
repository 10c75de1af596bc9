"""Sinks: append-only logs, split tables, label texts, configuration text, drawing instructions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.functions import text as X
from boxloom.sources import dataset


def append_removals(rows: DataFrame, path: str) -> None:
    """Adds (image, reason, vehicle_id, plate_confidence, ocr_confidence) to a CSV log; nulls are empty, scores have four places."""
    scores = ("plate_confidence", "ocr_confidence")
    four = [(X.fixed(F.col(c), 4) if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in scores]
    rows.select("image", "reason", "vehicle_id", *four).write.mode("append").option("header", True).option("nullValue", "").csv(path)


def append_record(rows: DataFrame, path: str) -> None:
    """Adds rows to a JSON-lines record, a batch at a time: all of a batch or nothing."""
    rows.write.mode("append").json(path)


def write_splits(rows: DataFrame, path: str) -> None:
    """One folder for each split; images stay where they are and are named by path."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def write_files(rows: DataFrame, root: str) -> None:
    """Writes each row (name, content: binary or string) as a file of its own below ``root``: all of them or none.

    For data sets that a trainer reads file by file. Rows without a name are left out; a null content is empty.
    """
    body = F.coalesce(F.col("content").cast("binary"), F.lit(b""))
    dataset.save_files(rows.where("name IS NOT NULL").select("name", body.alias("content")), root)


def materialise_splits(rows: DataFrame, root: str) -> DataFrame:
    """Writes labels as ``labels/<split>/<stem>.txt`` below ``root`` and one list of images for each split, ``<split>.list``.

    ``rows``: split, stem, image (where it lies), text (its label file). Images are listed, not copied, for tools
    that take lists; ``dataset.save_splits`` writes what a trainer reads. Gives (split, images).
    """
    name = F.concat(F.lit("labels/"), "split", F.lit("/"), "stem", F.lit(".txt"))
    write_files(rows.select(name.alias("name"), F.col("text").alias("content")), root)
    for split in [r.split for r in rows.select("split").distinct().orderBy("split").collect()]:
        dataset.save_lines(rows.where(F.col("split") == split).select("image").orderBy("image"), f"{root.rstrip('/')}/{split}.list")
    return rows.groupBy("split").agg(F.count("*").alias("images"))


def merge_into(rows: DataFrame, root: str) -> DataFrame:
    """Adds the label files of rows with outcome ``added`` (see ``curation.merge``) to a data set; gives (outcome, n).

    ``rows``: name (image), image (where it lies), stem, text, outcome. The images' places are appended to
    ``images`` as a table: a reference each, no copy. What the output holds is for the caller to know;
    ``dataset.Grown`` keeps that.
    """
    added = rows.where("outcome = 'added'")
    write_files(added.select(F.concat(F.lit("labels/"), "stem", F.lit(".txt")).alias("name"), F.col("text").alias("content")), root)
    added.select("name", "image").write.mode("append").parquet(f"{root.rstrip('/')}/images")
    return rows.groupBy("outcome").agg(F.count("*").alias("n"))


def write_url_list(urls: DataFrame, path: str) -> None:
    """The distinct URLs in order, a line each."""
    dataset.save_lines(urls.select("url").distinct().orderBy("url"), path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def label_text(boxes: DataFrame) -> DataFrame:
    """(image_id, text): the label file of each image, with six places."""
    line = F.concat_ws(" ", F.col("cls").cast("string"), *[X.fixed(F.col(c), 6) for c in ("cx", "cy", "w", "h")])
    return boxes.groupBy("image_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("box_idx", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))


def class_names(seen: list[int], names: dict[int, str]) -> list[str]:
    """A name for each id from 0 to the greatest of ``seen``, made up where ``names`` has none; one at least."""
    return [names.get(k) or f"class_{k}" for k in range(1 + max([0, *seen]))]


def data_yaml(names: dict[int, str], root: str, folders: dict[str, str], as_list: bool = True) -> str:
    """The data set's configuration with its names as a list or, in the other dialect, one to a line by id.

    Without any name there is one class, ``class_0``.
    """
    every = class_names(list(names), names)
    head = {"path": root, **folders, "nc": len(every)}
    named = f" {every}" if as_list else "".join(f"\n  {k}: {name}" for k, name in enumerate(every))
    return "".join(f"{k}: {v}\n" for k, v in head.items()) + f"names:{named}\n"


def classes_text(names: list[str]) -> str:
    """The dialect of labelling tools: a name a line."""
    return "".join(f"{name}\n" for name in names)


def overlays(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """What to draw, for any renderer: (image_id, kind, x1, y1, x2, y2, label, colour)."""
    box = ["x1", "y1", "x2", "y2"]
    a = gt.select("image_id", F.lit("gt").alias("kind"), *box, F.concat(F.lit("gt "), "cls").alias("label"), F.lit("green").alias("colour"))
    b = pred.select("image_id", F.lit("pred").alias("kind"), *box, F.format_string("%d %.2f", "cls", "conf").alias("label"), F.lit("red").alias("colour"))
    return a.unionByName(b)
