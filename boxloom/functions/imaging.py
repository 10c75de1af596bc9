"""Pixels: brightness, perceptual hash, outlines and crops, in Arrow batches of the decoded data."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from boxloom.functions import glyphs


def gray(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Luma of a blue-green-red image."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(float)
    return x[:, :, 0] if channels == 1 else x[:, :, 0] * 0.114 + x[:, :, 1] * 0.587 + x[:, :, 2] * 0.299


def shrink(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over equal cells."""
    rows = np.linspace(0, x.shape[0], height + 1).astype(int)[:-1]
    cols = np.linspace(0, x.shape[1], width + 1).astype(int)[:-1]
    sums = np.add.reduceat(np.add.reduceat(x, rows, 0), cols, 1)
    n = np.add.reduceat(np.add.reduceat(np.ones_like(x), rows, 0), cols, 1)
    return sums / n


def luma(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Gray bytes of a blue-green-red image: weights in 65,536ths, rounded."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(np.int64)
    if channels == 1:
        return x[:, :, 0].astype(np.uint8)
    return ((x[:, :, 2] * 19595 + x[:, :, 1] * 38470 + x[:, :, 0] * 7471 + 0x8000) >> 16).astype(np.uint8)


#: Bits behind the point of the weights of a resampling, and its reach in pixels of the smaller image.
_BITS, _REACH = 22, 3.0


@lru_cache(maxsize=256)
def lanczos(size: int, to: int) -> np.ndarray:
    """(to, size) whole-number weights that resample ``size`` pixels to ``to``, each row's sum near 2^22."""
    scale = size / to
    wide = max(scale, 1.0)
    out = np.zeros((to, size), np.int64)
    for k in range(to):
        centre = (k + 0.5) * scale
        low, high = max(0, int(centre - _REACH * wide + 0.5)), min(size, int(centre + _REACH * wide + 0.5))
        x = (np.arange(low, high) - centre + 0.5) / wide
        w = np.where((x >= -_REACH) & (x < _REACH), np.sinc(x) * np.sinc(x / _REACH), 0.0)
        w = w / w.sum() * (1 << _BITS)
        out[k, low:high] = np.trunc(w + np.where(w < 0, -0.5, 0.5)).astype(np.int64)
    return out


def resampled(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """Gray bytes at another size: rows first, then columns, each rounded to bytes; a side that fits stays."""

    def rounded(sums: np.ndarray) -> np.ndarray:
        return np.clip((sums + (1 << (_BITS - 1))) >> _BITS, 0, 255)

    y = x.astype(np.int64)
    if x.shape[1] != width:
        y = rounded(y @ lanczos(x.shape[1], width).T)
    return (rounded(lanczos(x.shape[0], height) @ y) if x.shape[0] != height else y).astype(np.uint8)


def phash_of(x: np.ndarray) -> int:
    """64 bits, most significant first: which of the 8 x 8 lowest cosine terms of a 32 x 32 image exceed their median.

    The cosine transform is not normalised, and the image is gray bytes, made smaller by Lanczos resampling in
    whole numbers, as the usual libraries do it: hashes of the same pixels are theirs, bit by bit, but for images
    (such as flat ones) whose terms differ from their median by less than a rounding error.
    """
    k = np.arange(32)
    basis = 2 * np.cos(np.pi * np.outer(np.arange(8), 2 * k + 1) / 64)
    small = resampled(np.clip(np.rint(x), 0, 255).astype(np.uint8), 32, 32).astype(float)
    low = basis @ small @ basis.T
    bits = (low > np.median(low)).ravel()
    h = int("".join("1" if b else "0" for b in bits), 2)
    return h - (1 << 64) if h >> 63 else h


def _each(series: tuple[pd.Series, ...], of, missing, as_gray=gray):
    return pd.Series([missing if pd.isna(w) or h < 1 or w < 1 else of(as_gray(d, int(h), int(w), int(c))) for d, h, w, c in zip(*series)])


def brightness(data: Column, height: Column, width: Column, channels: Column) -> Column:
    """Mean luma at an eighth of the size; -1 for what cannot be read."""

    def of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for s in batches:
            yield _each(s, lambda x: float(shrink(x, max(1, x.shape[0] // 8), max(1, x.shape[1] // 8)).mean()), -1.0).astype(float)

    return F.pandas_udf(of, "double")(data, height, width, channels)


def phash(data: Column, height: Column, width: Column, channels: Column) -> Column:
    """The perceptual hash as a signed 64-bit pattern; null for what cannot be read."""

    def of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for s in batches:
            yield _each(s, phash_of, None, luma).astype("Int64")

    return F.pandas_udf(of, "long")(data, height, width, channels)


# ---- drawing and cropping ------------------------------------------------------------------------------

#: Blue, green and red of what is drawn, by kind; anything else is drawn like a detection.
COLOURS = {"gt": (0, 255, 0), "pred": (0, 0, 255), "plate": (255, 255, 0), "other": (0, 165, 255)}


def pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """A blue-green-red image as an array that may be written to."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(x, 3, 2) if channels == 1 else x[:, :, :3].copy()


def png(image: np.ndarray) -> bytes:
    """A blue-green-red image as a PNG file."""
    height, width = image.shape[:2]
    rows = np.zeros((height, 1 + 3 * width), np.uint8)  # each row begins with the number of its filter, 0
    rows[:, 1:] = image[:, :, ::-1].reshape(height, -1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def outlined(image: np.ndarray, boxes: list, thickness: int = 2) -> np.ndarray:
    """``image`` with the outlines of (kind, x1, y1, x2, y2[, caption]), cut off at its edges; boxes without an area draw nothing.

    Captions come after all outlines, above their boxes.
    """
    height, width = image.shape[:2]
    said = []
    for kind, x1, y1, x2, y2, *text in boxes:
        x1, y1, x2, y2 = (int(round(v)) for v in (x1, y1, x2, y2))
        if x2 <= x1 or y2 <= y1:
            continue
        ys, xs = (slice(max(0, a), max(0, min(m, b))) for a, b, m in ((y1, y2, height), (x1, x2, width)))
        colour = COLOURS.get(kind, COLOURS["pred"])
        for a, b in ((y1, y1 + thickness), (y2 - thickness, y2)):
            image[max(0, a) : max(0, min(height, b)), xs] = colour
        for a, b in ((x1, x1 + thickness), (x2 - thickness, x2)):
            image[ys, max(0, a) : max(0, min(width, b))] = colour
        if text and text[0]:
            said.append((x1, y1, text[0], colour))
    for x, y, text, colour in said:
        glyphs.caption(image, x, y, text, colour, max(1, min(height, width) // 300))
    return image


def drawn(data: Column, height: Column, width: Column, channels: Column, boxes: Column) -> Column:
    """PNG files of images with the outlines of ``boxes``, an array of structs (kind, x1, y1, x2, y2[, caption]); null for what cannot be read."""

    def of(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for d, h, w, c, b in batches:
            yield pd.Series([None if pd.isna(wi) else png(outlined(pixels(di, int(hi), int(wi), int(ci)), [(x["kind"], x["x1"], x["y1"], x["x2"], x["y2"], x.get("caption")) for x in (bi if bi is not None else [])])) for di, hi, wi, ci, bi in zip(d, h, w, c, b)], dtype=object)

    return F.pandas_udf(of, "binary")(data, height, width, channels, boxes)


def cropped(data: Column, height: Column, width: Column, channels: Column, box: Column) -> Column:
    """PNG files of the part of each image that ``box``, a struct of whole numbers (x1, y1, x2, y2), covers; null without a part."""

    def of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.DataFrame]]) -> Iterator[pd.Series]:
        for d, h, w, c, b in batches:
            out = []
            for di, hi, wi, ci, (x1, y1, x2, y2) in zip(d, h, w, c, b[["x1", "y1", "x2", "y2"]].itertuples(index=False)):
                part = None if pd.isna(wi) or pd.isna(x1) else pixels(di, int(hi), int(wi), int(ci))[max(0, int(y1)) : max(0, int(y2)), max(0, int(x1)) : max(0, int(x2))]
                out.append(None if part is None or not part.size else png(part))
            yield pd.Series(out, dtype=object)

    return F.pandas_udf(of, "binary")(data, height, width, channels, box)
