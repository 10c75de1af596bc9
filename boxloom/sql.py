"""The engine's functions by name, for ``spark.sql``.

    parse_label(text)                 table function: line_no, cls, cx, cy, w, h of the whole boxes of a label file
    box_area(a), box_share(a, b)      areas of structs with x1, y1, x2, y2, and of what two share
    box_iou(a, b)                     their intersection over union
    hamming(a, b)                     differing bits of two hashes
    band_label(brightness)            the band of a brightness

The scalar ones are SQL functions, so Catalyst inlines them like any expression. The table function is a
Python one, with Arrow batches; a lateral join gives it the text of each row.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from boxloom.functions.labels import CLASS_LIMIT, NUMBER
from boxloom.functions.text import BAND_TOPS

_NUMBER = re.compile(NUMBER, re.ASCII)
_BOX = "STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>"


def _number(token: str) -> float | None:
    value = float(token) if _NUMBER.match(token) else math.inf
    return value if math.isfinite(value) else None


class ParseLabel:
    """The lines of a label file that are whole boxes, by the number of the line; null text has none."""

    def eval(self, text: str):
        for k, line in enumerate(re.split(r"\r\n|\r|\n", text or "")):
            numbers = [_number(t) for t in line.split()[:5]]
            if len(numbers) == 5 and None not in numbers and abs(numbers[0]) < CLASS_LIMIT:
                yield k, int(numbers[0]), *numbers[1:]


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session."""
    spark.udtf.register("parse_label", udtf(ParseLabel, returnType="line_no int, cls int, cx double, cy double, w double, h double"))
    bottoms = (0, *BAND_TOPS[:-1])
    cases = "".join(f" WHEN v < {top} THEN '{low:03d}-{top:03d}'" for low, top in zip(bottoms, BAND_TOPS))
    share = "greatest(0D, least(a.{1}, b.{1}) - greatest(a.{0}, b.{0}))"
    for name, sql in (
        ("hamming", "(a BIGINT, b BIGINT) RETURNS INT RETURN bit_count(a ^ b)"),
        ("band_label", f"(v DOUBLE) RETURNS STRING RETURN CASE{cases} ELSE '{bottoms[-1]:03d}-plus' END"),
        ("box_area", f"(a {_BOX}) RETURNS DOUBLE RETURN greatest(0D, a.x2 - a.x1) * greatest(0D, a.y2 - a.y1)"),
        ("box_share", f"(a {_BOX}, b {_BOX}) RETURNS DOUBLE RETURN {share.format('x1', 'x2')} * {share.format('y1', 'y2')}"),
        ("box_iou", f"(a {_BOX}, b {_BOX}) RETURNS DOUBLE RETURN CASE WHEN box_area(a) + box_area(b) - box_share(a, b) > 0 THEN box_share(a, b) / (box_area(a) + box_area(b) - box_share(a, b)) ELSE 0D END"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{sql}")
