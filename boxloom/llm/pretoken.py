"""Splitting texts into the pieces inside which byte pairs merge: on the JVM, as Arrow lists for the workers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The public pattern in Java's dialect, where \s means ASCII only.
JAVA_PATTERN = public_tokenizers.PATTERN.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")
#: Pieces handled at once inside a worker: bounds its memory, whatever the Arrow batch holds.
PIECES_AT_ONCE = 400_000


def pieces(text: Column, special: str | None = None) -> Column:
    """Array of the pieces of ``text``; parts around ``special`` are split each for itself.

    Null and empty texts give an empty array. Texts with code points that the JVM's Unicode version does
    not know give null: a worker splits these itself (see ``split_here``), with the newer tables of its
    own library.
    """
    whole = F.regexp_extract_all(text, F.lit(JAVA_PATTERN), F.lit(0))
    if special is not None:
        quoted = "".join("\\" + c if not c.isalnum() else c for c in special)
        parts = F.transform(F.split(text, quoted, -1), lambda s: F.regexp_extract_all(s, F.lit(JAVA_PATTERN), F.lit(0)))
        whole = F.when(F.contains(text, F.lit(special)), F.flatten(parts)).otherwise(whole)
    text = F.coalesce(text, F.lit(""))
    return F.when(~text.rlike(r"\p{Cn}"), F.coalesce(whole, F.array().cast("array<string>")))


def unsplit(text: Column) -> Column:
    """The texts for which ``pieces`` is null."""
    return F.when(text.rlike(r"\p{Cn}"), text)


def split_here(text: str, special: str | None = None) -> list[str]:
    """``pieces`` for one text, by the ``regex`` library."""
    import regex

    find = regex.compile(public_tokenizers.PATTERN).findall
    return [p for part in (text.split(special) if special else [text]) for p in find(part)]


def chunks(batch: pa.RecordBatch, special: str | None = None) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """(first row, end row, flat pieces, offsets of each row in them) of parts of a batch.

    The batch has columns ``pieces`` and ``odd``; a row that alone has more than PIECES_AT_ONCE pieces
    is a part of its own.
    """
    col, odd = batch.column("pieces"), batch.column("odd")
    if odd.null_count < len(odd):
        lists = col.to_pylist()
        for i, text in enumerate(odd.to_pylist()):
            if text is not None:
                lists[i] = split_here(text, special)
        col = pa.array(lists, pa.list_(pa.string()))
    offsets = col.offsets.to_numpy().astype(np.int64)
    values, row, n = col.values, 0, len(col)
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECES_AT_ONCE, "right")) - 1)
        end = min(end, n)
        yield row, end, values.slice(offsets[row], offsets[end] - offsets[row]), offsets[row : end + 1] - offsets[row]
        row = end


#: Longer pieces are not remembered, so a cache is bounded in bytes as well as in entries.
LONG_PIECE = 128


class TwoAges(dict):
    """A cache of what ``make`` gives for a key: when young entries fill it, they become the old ones."""

    def __init__(self, make: Callable, most: int = 120_000):
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def all(self, keys: list, fresh: Callable[[list], dict]) -> list:
        """The values of distinct ``keys``; ``fresh`` makes those that are not held, all at once."""
        young, old = self.get, self.old.get
        values = list(map(young, keys))
        # all are read before any is kept: what is kept may push out entries that later keys still need
        for i, v in enumerate(values):
            if v is None:
                values[i] = old(keys[i])
        lacks = [i for i, v in enumerate(values) if v is None]
        new = fresh([keys[i] for i in lacks])
        for i in lacks:
            values[i] = new[keys[i]]
        for k, v in zip(keys, values):
            if k not in self:
                self.keep(k, v)
        return values

    def keep(self, key, value) -> None:
        if len(key) > LONG_PIECE:
            return
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
