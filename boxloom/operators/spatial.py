"""Boxes that overlap, without all pairs of an image: grids of cells whose sides are powers of two.

The level of a box is that of the smallest cell that is at least as large as the box, so it lies in four cells of
its level at most. Two boxes that overlap share a cell of the greater of their levels; a box is dealt out to
its cells at its own level and at the greater levels that other boxes of its image have. Of the cells that two
boxes share, the one with the least corner of their intersection counts, so a pair comes up once.

Images with few pairs join as they are; only ``crowded`` ones are dealt out by cells, which also spreads one
image over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.functions.session import cut

#: Pairs of an image up to which all of them are looked at.
FEW = 10_000
BOX = ("x1", "y1", "x2", "y2")
_LEVELS = (-30, 60)


def crowded(one: DataFrame, other: DataFrame, key: str = "image_id", few: int = FEW) -> DataFrame:
    """(key, n_one, n_other) of images with more than ``few`` pairs."""
    a, b = (rows.groupBy(key).agg(F.count("*").alias(n)) for rows, n in ((one, "n_one"), (other, "n_other")))
    return a.join(b, key).where(F.col("n_one") * F.col("n_other") > few)


def _level(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    side = F.greatest(x2 - x1, y2 - y1)
    return F.greatest(F.lit(_LEVELS[0]), F.least(F.lit(_LEVELS[1]), F.ceil(F.log2(side)))).cast("int")


def _cell(v: Column, level: Column) -> Column:
    return F.floor(v / F.pow(F.lit(2.0), level)).cast("long")


def _dealt(rows: DataFrame, levels: DataFrame, key: str, row: str) -> DataFrame:
    """(key, row, level, at, cx, cy): a row for each cell of each level that concerns a box."""
    x1, y1, x2, y2 = (F.col(c) for c in BOX)

    def of(at: Column) -> Column:
        ys = F.sequence(_cell(y1, at), _cell(y2, at))
        return F.flatten(F.transform(F.sequence(_cell(x1, at), _cell(x2, at)), lambda cx: F.transform(ys, lambda cy: F.struct(at.alias("at"), cx.alias("cx"), cy.alias("cy")))))

    cells = F.flatten(F.transform(F.filter("levels", lambda at: at >= F.col("level")), of))
    each = rows.withColumn("level", _level(x1, y1, x2, y2)).join(levels, key)
    return each.select(key, F.struct(*rows.columns).alias(row), "level", F.explode(cells).alias("cell")).select(key, row, "level", "cell.at", "cell.cx", "cell.cy")


def overlapping(one: DataFrame, other: DataFrame, key: str = "image_id") -> DataFrame:
    """(key, a, b): structs of the rows of both whose boxes share some area; corners are never null."""
    solid = (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))
    one, other = one.where(solid), other.where(solid)
    level = _level(*[F.col(c) for c in BOX])
    levels = one.select(key, level.alias("l")).unionByName(other.select(key, level.alias("l"))).groupBy(key).agg(F.collect_set("l").alias("levels"))
    a = _dealt(one, levels, key, "a").withColumnRenamed("level", "level_a")
    b = _dealt(other, levels, key, "b").withColumnRenamed("level", "level_b")
    met = a.join(b, [key, "at", "cx", "cy"]).where(F.col("at") == F.greatest("level_a", "level_b"))
    x, y = (F.greatest(f"a.{c}", f"b.{c}") for c in ("x1", "y1"))
    share = (F.least("a.x2", "b.x2") > x) & (F.least("a.y2", "b.y2") > y)
    return met.where(share & (_cell(x, F.col("at")) == F.col("cx")) & (_cell(y, F.col("at")) == F.col("cy"))).select(key, "a", "b")


def meeting(one: DataFrame, other: DataFrame, key: str = "image_id", few: int = FEW) -> DataFrame:
    """(key, a, b) as ``overlapping``: a join by image, in which boxes are compared before they become a row; by cells in crowded images."""
    solid = (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))
    one, other = one.where(solid), other.where(solid)
    busy = cut(crowded(one, other, key, few).select(key))
    if busy.isEmpty():
        return _joined(one, other, key)
    calm = _joined(one.join(busy, key, "left_anti"), other, key)
    return calm.unionByName(overlapping(one.join(busy, key, "left_semi").select(*one.columns), other.join(busy, key, "left_semi").select(*other.columns), key))


def _joined(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """(key, a, b) of all that overlap. Rows travel as plain columns, without structs beside them."""
    a, b = (rows.select(key, *[F.col(c).alias(f"_{side}_{c}") for c in rows.columns if c != key]) for rows, side in ((one, "a"), (other, "b")))
    x, y = (F.greatest(f"_a_{c}", f"_b_{c}") for c in ("x1", "y1"))
    met = a.join(b, key).where((F.least("_a_x2", "_b_x2") > x) & (F.least("_a_y2", "_b_y2") > y))
    back = [F.struct(*[F.col(c) if c == key else F.col(f"_{side}_{c}").alias(c) for c in rows.columns]).alias(side) for rows, side in ((one, "a"), (other, "b"))]
    return met.select(key, *back)


def pairs(one: DataFrame, other: DataFrame, key: str = "image_id", few: int = FEW) -> DataFrame:
    """(key, a, b): all pairs of images with few of them, the overlapping pairs of the others."""
    busy = crowded(one, other, key, few).select(key)
    calm = one.join(busy, key, "left_anti")
    plain = calm.select(key, F.struct(*one.columns).alias("a")).join(other.select(key, F.struct(*other.columns).alias("b")), key)
    return plain.unionByName(overlapping(one.join(busy, key, "left_semi").select(*one.columns), other.join(busy, key, "left_semi").select(*other.columns), key))
