"""Merging, splitting, sampling, bands, and what is left to do."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom.functions.session import cut
from boxloom.functions.text import band_label, valid_url


def merge(rows: DataFrame, order: list[str], label: str, nonempty: Column | None = None, held: DataFrame | None = None, name: str | None = None) -> DataFrame:
    """``rows`` with outcome added, no_label or collision: sources in rank order, a label that is already there collides.

    A label is named after its image's stem, so images with equal names have equal labels, and the label
    decides for both. The first row by ``order`` of those with a label that is not empty wins. ``held`` has the
    ``label`` and ``name`` of what the output holds (either may be null): a row whose label or name is among
    them collides, and does not stand in the way of others.
    """
    ok = F.lit(True) if nonempty is None else F.coalesce(nonempty, F.lit(False))
    if held is None:
        rank = F.row_number().over(Window.partitionBy(label, ok).orderBy(*order))
        return rows.withColumn("outcome", F.when(~ok, "no_label").when(rank == 1, "added").otherwise("collision"))
    met = F.lit(False)
    for k, c in enumerate((label, name)):
        there = held.where(F.col(c).isNotNull()).select(F.col(c).alias(f"_held{k}")).distinct()
        rows = rows.join(there, rows[c] == there[f"_held{k}"], "left")
        met = met | F.col(f"_held{k}").isNotNull()
    rank = F.row_number().over(Window.partitionBy(label, ok & ~met).orderBy(*order))
    outcome = F.when(~ok, "no_label").when(met, "collision").when(rank == 1, "added").otherwise("collision")
    return rows.withColumn("outcome", outcome).drop("_held0", "_held1")


def gather_pairs(images: DataFrame, labels: DataFrame, stem: str = "stem", nonempty: str = "nonempty") -> DataFrame:
    """``images`` with outcome: valid, missing_label or empty_label; ``labels`` has ``stem`` and a boolean ``nonempty``.

    Several label files of a stem count as one, which is not empty if one of them is not.
    """
    have = labels.groupBy(stem).agg(F.bool_or(nonempty).alias("_nonempty"))
    outcome = F.when(F.col("_nonempty").isNull(), "missing_label").when(~F.col("_nonempty"), "empty_label").otherwise("valid")
    return images.join(have, stem, "left").withColumn("outcome", outcome).drop("_nonempty")


def labels_with_images(labels: DataFrame, images: DataFrame, stem: str = "stem", image: str = "image") -> DataFrame:
    """``labels`` with ``image``, null where no image has their stem: such labels stay and are counted."""
    return labels.join(images.select(stem, image).dropDuplicates([stem]), stem, "left")


def still_there(kept: DataFrame, earlier: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """Keys kept now, and those that an earlier run kept and that ``listing`` still has."""
    return kept.select(key).union(earlier.select(key).join(listing.select(key), key, "left_semi")).distinct()


def classes_seen(boxes: DataFrame) -> DataFrame:
    """One row: the sorted classes that occur and the number of names that a configuration needs (greatest id + 1, at least 1)."""
    return boxes.agg(F.sort_array(F.collect_set("cls")).alias("classes"), (F.coalesce(F.max("cls"), F.lit(0)) + 1).alias("n_names"))


def with_class(boxes: DataFrame, cls: int, key: str = "image_id") -> DataFrame:
    """The images that have a box of ``cls``."""
    return boxes.where(F.col("cls") == cls).select(key).distinct()


def sample_by_hash(rows: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """``rows`` with sample_pos from 0: the first ``k`` in the order of md5(seed, key), without an order over all rows."""
    h = F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))
    # the k rows come from partial tops of each partition
    picked = rows.withColumn("_h", h).orderBy("_h", key).limit(k)
    return picked.withColumn("sample_pos", F.row_number().over(Window.orderBy("_h", key)) - 1).drop("_h")


def crops_to_review(crops: DataFrame, bucket: str, key: str, per_bucket: int = 50, percent: int = 50, seed: int = 42) -> DataFrame:
    """The first ``per_bucket`` crops of each bucket of those that a seeded hash picks with ``percent``."""
    picked = crops.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string")), F.lit(100)) < percent)
    return picked.withColumn("pos", F.row_number().over(Window.partitionBy(bucket).orderBy(key))).where(F.col("pos") <= per_bucket)


def split_by_hash(rows: DataFrame, key: str, ratios: tuple[tuple[str, float], ...] = (("train", 0.75), ("val", 0.10), ("test", 0.15)), seed: int = 42) -> DataFrame:
    """``rows`` with split: in the order of md5(seed, key), cut at floor(n * ratio); the last part takes the rest.

    Ranks come from counts of hash prefixes, so no window spans more than one prefix.
    """
    if abs(sum(r for _, r in ratios) - 1) > 1e-9:
        raise ValueError("the ratios do not sum to 1")
    h = F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))
    hashed = rows.withColumn("_h", h).withColumn("_p", F.substring("_h", 1, 3))
    per = hashed.groupBy("_p").agg(F.count("*").alias("_n"))
    # at most 4096 prefixes
    before = per.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_all"))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy("_h", key)) + F.col("_before") - 1
    ranked = hashed.join(F.broadcast(before), "_p").withColumn("_r", rank)
    out, edge = F, F.lit(0)
    for name, ratio in ratios[:-1]:
        edge = edge + F.floor(F.col("_all") * F.lit(ratio))
        out = out.when(F.col("_r") < edge, name)
    return ranked.withColumn("split", out.otherwise(ratios[-1][0])).drop("_h", "_p", "_before", "_all", "_r")


def permutation(n: int, seed: int = 42) -> list[int]:
    """Where Mersenne Twister shuffling puts each of n positions; n numbers on the driver, for parity with small sets."""
    order = list(range(n))
    random.Random(seed).shuffle(order)
    return order


def split_seeded(rows: DataFrame, name: str, ratios=(("train", 0.7), ("val", 0.2), ("test", 0.1)), seed: int = 42) -> DataFrame:
    """``rows`` with split by the seeded shuffle of the sorted names, as a script over a listing gives it. For listings that fit the driver."""
    n = rows.count()
    spark = rows.sparkSession
    places = spark.createDataFrame([(i, at) for at, i in enumerate(permutation(n, seed))], "_i int, _at int")
    ranked = rows.withColumn("_i", F.row_number().over(Window.orderBy(name)) - 1)
    out, edge = F, 0
    for part, ratio in ratios[:-1]:
        edge += int(n * ratio)
        out = out.when(F.col("_at") < edge, part)
    return ranked.join(places, "_i").withColumn("split", out.otherwise(ratios[-1][0])).drop("_i", "_at")


def sample_seeded(rows: DataFrame, name: str, k: int, seed: int = 42) -> DataFrame:
    """``rows`` with sample_pos: k of the sorted names by the seeded sampling of positions."""
    n = rows.count()
    picked = random.Random(seed).sample(range(n), min(k, n))
    places = rows.sparkSession.createDataFrame(list(enumerate(picked)), "sample_pos int, _i int")
    return rows.withColumn("_i", F.row_number().over(Window.orderBy(name)) - 1).join(F.broadcast(places), "_i").drop("_i")


def bands(scores: DataFrame, value: str) -> DataFrame:
    """(band, n) of readable values; -1 marks what could not be read."""
    return scores.where(F.col(value) >= 0).groupBy(band_label(F.col(value)).alias("band")).agg(F.count("*").alias("n"))


def band_samples(scores: DataFrame, key: str, value: str, per_band: int = 25) -> DataFrame:
    """The first ``per_band`` keys of each band."""
    banded = scores.where(F.col(value) >= 0).select(key, value, band_label(F.col(value)).alias("band"))
    return banded.withColumn("pos", F.row_number().over(Window.partitionBy("band").orderBy(key))).where(F.col("pos") <= per_band)


def percentiles(scores: DataFrame, value: str, at: tuple[int, ...] = (1, 5, 10, 25, 50, 75, 90)) -> DataFrame:
    """(pct, v) by linear interpolation between order statistics; exact. Without readable values v is null.

    Values are counted, ranges of them are summed, and only the ranges that hold a wanted rank are numbered;
    the driver gets a number for each range and two values for each percentile.
    """
    spark = scores.sparkSession
    counts = scores.where(F.col(value) >= 0).groupBy(F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    ranged = cut(counts.repartitionByRange("v").withColumn("range", F.spark_partition_id()))
    totals = ranged.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect()
    n, before = sum(r.n for r in totals), {}
    for r in totals:
        before[r.range] = sum(x.n for x in totals if x.range < r.range)
    places = {p: (n - 1) * p / 100 for p in at}
    wanted = sorted({k for x in places.values() for k in (math.floor(x), math.ceil(x))}) if n else []
    holds = {r.range for r in totals if any(before[r.range] <= k < before[r.range] + r.n for k in wanted)}
    found: dict[int, float] = {}
    if holds:
        offsets = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
        last = offsets[F.col("range")] + F.sum("n").over(Window.partitionBy("range").orderBy("v"))
        placed = ranged.where(F.col("range").isin(*holds)).withColumn("last", last)
        hit = placed.select("v", F.explode(F.filter(F.array(*map(F.lit, wanted)), lambda k: (k < F.col("last")) & (k >= F.col("last") - F.col("n")))).alias("k"))
        found = {r.k: r.v for r in hit.collect()}
    rows = []
    for p, x in places.items():
        low, high = (found.get(f(x)) for f in (math.floor, math.ceil))
        rows.append((p, None if low is None or high is None else low + (high - low) * (x - math.floor(x))))
    return spark.createDataFrame(rows, "pct int, v double")


def score_summary(scores: DataFrame, value: str) -> DataFrame:
    """One row: n, mean, least and greatest of the readable values, and how many could not be read."""
    good = F.when(F.col(value) >= 0, F.col(value))
    return scores.agg(F.count(good).alias("n"), F.avg(good).alias("mean"), F.min(good).alias("least"), F.max(good).alias("greatest"), F.count_if(F.col(value) < 0).alias("unreadable"))


def dark(score: Column, threshold: float = 40.0) -> Column:
    """Readable and below the threshold; what cannot be read stays."""
    return (score >= 0) & (score < threshold)


def urls_of(transactions: DataFrame, *columns: str) -> DataFrame:
    """Distinct valid URLs of several columns."""
    either = transactions.select(F.explode(F.array(*[valid_url(F.col(c)) for c in columns])).alias("url"))
    return either.where("url IS NOT NULL").distinct()


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def overlap(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """The distinct keys that both batches have."""
    return one.select(key).intersect(other.select(key))
