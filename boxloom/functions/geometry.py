"""Box geometry as column expressions: everything stays in JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, low, high) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high) if not isinstance(high, Column) else high)


def to_xyxy(cx: Column, cy: Column, w: Column, h: Column, width, height) -> tuple[Column, Column, Column, Column]:
    """Corners in pixels, neither rounded nor clamped."""
    return (cx - w / 2) * width, (cy - h / 2) * height, (cx + w / 2) * width, (cy + h / 2) * height


def to_pixels(cx: Column, cy: Column, w: Column, h: Column, width, height) -> tuple[Column, ...]:
    """Integer corners, rounded half to even, clamped to the image."""
    x1, y1, x2, y2 = to_xyxy(cx, cy, w, h, width, height)
    return tuple(clamp(F.rint(v).cast("int"), 0, m) for v, m in ((x1, width), (y1, height), (x2, width), (y2, height)))


def to_yolo(x1: Column, y1: Column, x2: Column, y2: Column, width, height) -> tuple[Column, ...]:
    """Normalised centre and size of a box, clamped to 0..1."""
    raw = ((x1 + x2) / 2 / width, (y1 + y2) / 2 / height, (x2 - x1) / width, (y2 - y1) / height)
    return tuple(clamp(v, 0.0, 1.0) for v in raw)


def plate_to_yolo(x1: Column, y1: Column, x2: Column, y2: Column, width, height) -> tuple[Column, ...]:
    """As ``to_yolo`` for corners in any order."""
    raw = ((x1 + x2) / 2 / width, (y1 + y2) / 2 / height, F.abs(x2 - x1) / width, F.abs(y2 - y1) / height)
    return tuple(clamp(v, 0.0, 1.0) for v in raw)


def padded_crop(cx: Column, cy: Column, w: Column, h: Column, width, height, pad: float = 0.15) -> tuple[Column, ...]:
    """The window around a box with ``pad`` of its size on each side: clamped, then truncated to pixels."""
    edges = (cx - w / 2 - w * pad, cy - h / 2 - h * pad, cx + w / 2 + w * pad, cy + h / 2 + h * pad)
    return tuple((clamp(v, 0.0, 1.0) * m).cast("int") for v, m in zip(edges, (width, height, width, height)))


def crop_box(x1: Column, y1: Column, x2: Column, y2: Column, width: int, height: int) -> Column:
    """Struct of the integer crop of a box; null if it is empty."""
    a, b = (clamp(F.rint(v).cast("int"), 0, m - 1) for v, m in ((x1, width), (y1, height)))
    c, d = (clamp(F.rint(v).cast("int"), 0, m) for v, m in ((x2, width), (y2, height)))
    return F.when((c > a) & (d > b), F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2")))


def area_frac(x1: Column, y1: Column, x2: Column, y2: Column, width, height) -> Column:
    """The share of the image that a box covers; nothing for swapped corners."""
    zero = F.lit(0.0)
    return F.greatest(zero, x2 - x1) * F.greatest(zero, y2 - y1) / F.greatest(F.lit(1), F.lit(width * height))


def iou(a: Column, b: Column, clamped: bool = True) -> Column:
    """Intersection over union of two structs with x1, y1, x2, y2; 0 where the union is not positive.

    ``clamped`` areas of swapped corners are 0; else they count as they come out.
    """
    zero = F.lit(0.0)
    inter = F.greatest(zero, F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])) * F.greatest(zero, F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))

    def area(r: Column) -> Column:
        w, h = r["x2"] - r["x1"], r["y2"] - r["y1"]
        return F.greatest(zero, w) * F.greatest(zero, h) if clamped else w * h

    union = area(a) + area(b) - inter
    return F.when(union > 0, inter / union).otherwise(zero)


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit hashes held as bigint."""
    return F.bit_count(a.bitwiseXOR(b))
