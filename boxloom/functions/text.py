"""Names, URLs and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Upper edges of the brightness bands.
BAND_TOPS = (10, 20, 30, 40, 50, 70, 100, 256)
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "webp", "tif", "tiff")


def strip(s: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(s, r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$", "")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/*$", 1)


def stem(name: Column) -> Column:
    """The name without its last suffix; a leading dot begins no suffix."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]+$", "")


def extension(name: Column) -> Column:
    """The last suffix in lower case, without its dot."""
    return F.lower(F.regexp_extract(name, r"(?<=[^.])\.([^.]+)$", 1))


def is_image(name: Column) -> Column:
    return extension(name).isin(*IMAGE_EXTENSIONS)


def valid_url(url: Column) -> Column:
    """The stripped URL; null unless it begins with http and is no written-out none."""
    s = strip(url)
    return F.when((s != "") & (F.lower(s) != "none") & s.startswith("http"), s)


def url_file_name(url: Column) -> Column:
    """The base name of the URL's path, else what stands behind its last slash."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    base = F.element_at(F.split(path, "/"), -1)
    return F.when(base != "", base).otherwise(F.element_at(F.split(url, "/"), -1))


def band_label(v: Column) -> Column:
    """``010-020`` and so on: the first band whose top is above the value, ``100-plus`` beyond all."""
    bottoms = (0, *BAND_TOPS[:-1])
    out = F
    for low, top in zip(bottoms, BAND_TOPS):
        out = out.when(v < top, f"{low:03d}-{top:03d}")
    return out.otherwise(f"{bottoms[-1]:03d}-plus")


def fixed(x: Column, places: int) -> Column:
    """A number with so many places: its exact value rounded, halves to even, as Python writes it."""
    return F.replace(F.format_number(x, places), F.lit(","), F.lit(""))
