"""Data sets of images and label files on disk: one that grows by merges, and the splits of one.

A grown data set is a manifest (``_manifest``: what it holds, by version) and the files that follow from it:
``labels/<stem>.txt``, and ``images/<name>`` where images are linked or copied. A merge decides against a version
and commits on top of it; files are written from what has been committed, so they can be written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from boxloom.functions import text as X
from boxloom.operators import curation as C
from boxloom.sources import filesets
from boxloom.sources.manifest import Conflict, Manifest

HELD = "name string, stem string, image string, source string, text string"
ATTEMPTS = 20
OUTCOMES = ("added", "no_label", "collision")
SPLITS = ("train", "val", "test")
#: Where images and labels of a split lie, below the root.
LAYOUTS = {"by_kind": ("images/{0}", "labels/{0}"), "by_split": ("{0}/images", "{0}/labels")}


def save_files(rows: DataFrame, root: str, link: bool = False) -> None:
    """Writes rows (name, content[, source]) below ``root``: all of them or none (see ``filesets``)."""
    spark = rows.sparkSession
    filesets.register(spark)
    rows.write.format("filesets").mode("append").option("link", str(link).lower()).save(filesets.reachable(spark, root))


def save_lines(rows: DataFrame, path: str) -> None:
    """Writes one column of strings as one file, in the order of the rows."""
    spark = rows.sparkSession
    filesets.register(spark)
    rows.toDF("line").write.format("linefile").mode("append").save(filesets.reachable(spark, path))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(name) of the files of a folder; none if there is no such folder. Contents are not read."""
    return filesets.listed(spark, folder).select("name")


class Grown:
    """The data set at ``root``. ``images``: reference (by the manifest only), link or copy."""

    def __init__(self, spark: SparkSession, root: str, images: str = "reference"):
        if images not in ("reference", "link", "copy"):
            raise ValueError("images are kept as reference, link or copy")
        self.spark, self.root, self.images = spark, root.rstrip("/"), images
        self.manifest = Manifest(spark, f"{self.root}/_manifest")

    def held(self, version: int | None = None) -> DataFrame:
        """(name, stem, image, source, text) of all images; a label that was there before the first merge has a stem only."""
        return self.manifest.read("images", HELD, version)

    def adopt(self) -> None:
        """Makes files that lie in ``root`` without a manifest its first version, so that nothing replaces them."""
        labels = listing(self.spark, f"{self.root}/labels").where("name LIKE '%.txt'").select(F.lit(None).cast("string").alias("name"), X.stem(F.col("name")).alias("stem"))
        images = listing(self.spark, f"{self.root}/images").select("name", F.lit(None).cast("string").alias("stem"))
        found = labels.unionByName(images.where(X.is_image(F.col("name"))))
        if not found.isEmpty():
            empty = [F.lit(None).cast("string").alias(c) for c in ("image", "source", "text")]
            version = self.manifest.commit(0, {"images": self.manifest.stage("images", found.select("name", "stem", *empty))}, note="adopted")
            self.manifest.mark(version, "files")

    def merge(self, rows: DataFrame, order: list[str], attempts: int = ATTEMPTS) -> dict[str, int]:
        """Adds what collides neither with what is held nor with what comes before it in ``order``; counts by outcome.

        ``rows``: name, stem, image (where it lies), source, text and nonempty (whether the label has a box). What
        is decided is staged and counted in one pass, and decided anew where another merge has committed meanwhile.
        """
        for _ in range(attempts):
            try:
                if not (base := self.manifest.version()):
                    self.adopt()
                    base = self.manifest.version()
                decided = C.merge(rows, order, "stem", F.col("nonempty"), self.held(base) if base else None, "name")
                seen = Observation("merge")
                counted = decided.observe(seen, *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])
                staged = self.manifest.stage("images", counted.where("outcome = 'added'").select("name", "stem", "image", "source", "text"))
                counts = {o: n for o, n in seen.get.items() if n}
                if counts.get("added"):
                    self.manifest.commit(base, {"images": staged})
                self.publish()
                return counts
            except Conflict:
                continue
        raise Conflict(f"others have merged {attempts} times meanwhile")

    def publish(self) -> None:
        """Writes the files of all versions that have none yet."""
        for version in self.manifest.unmarked("files"):
            rows = self.manifest.rows_of("images", HELD, version)
            files = rows.select(F.concat(F.lit("labels/"), "stem", F.lit(".txt")).alias("name"), F.coalesce("text", F.lit("")).cast("binary").alias("content"), F.lit(None).cast("string").alias("source"))
            if self.images != "reference":
                files = files.unionByName(rows.select(F.concat(F.lit("images/"), "name").alias("name"), F.lit(None).cast("binary").alias("content"), F.col("image").alias("source")))
            save_files(files, self.root, self.images == "link")
            self.manifest.mark(version, "files")


def is_grown(spark: SparkSession, root: str) -> bool:
    return Manifest(spark, f"{root.rstrip('/')}/_manifest").version() > 0


def save_splits(rows: DataFrame, root: str, layout: str = "by_kind", link: bool = False, splits: tuple[str, ...] = SPLITS) -> dict[str, int]:
    """Writes images and labels in folders of their split, and one sorted list of images for each, ``<split>.txt``.

    ``rows``: split, stem, name, image (where it lies), text (its label file). A trainer finds the label of an
    image by putting ``labels`` for ``images`` in its path, in either layout. Empty splits have an empty list and
    folders without files but a mark. Counts by split.
    """
    images, labels = ((F.format_string(x.replace("{0}", "%s"), "split")) for x in LAYOUTS[layout])
    none, nothing = F.lit(None).cast("string"), F.lit(None).cast("binary")
    files = rows.select(F.concat(images, F.lit("/"), "name").alias("name"), nothing.alias("content"), F.col("image").alias("source"))
    files = files.unionByName(rows.select(F.concat(labels, F.lit("/"), "stem", F.lit(".txt")).alias("name"), F.coalesce("text", F.lit("")).cast("binary").alias("content"), none.alias("source")))
    spark = rows.sparkSession
    keep = [(f"{x.format(s)}/.keep", b"", None) for s in splits for x in LAYOUTS[layout]]
    files = files.unionByName(spark.createDataFrame(keep, "name string, content binary, source string"))
    save_files(files, root, link)
    at = filesets.reachable(spark, root)
    for s in splits:
        mine = rows.where(F.col("split") == s)
        save_lines(mine.select(F.concat(F.lit(f"{at.removeprefix('file://')}/{LAYOUTS[layout][0].format(s)}/"), "name").alias("line")).orderBy("line"), f"{root.rstrip('/')}/{s}.txt")
    found = {r.split: r.n for r in rows.groupBy("split").agg(F.count("*").alias("n")).collect()}  # a number for each split
    return {s: found.get(s, 0) for s in splits}


def split_folders(layout: str, splits: tuple[str, ...] = SPLITS) -> dict[str, str]:
    """What a configuration names for each split."""
    return {s: LAYOUTS[layout][0].format(s) for s in splits}
