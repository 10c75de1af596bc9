"""Token counts by rank-synchronous array merging.

The distinct pieces of a batch that were not counted before lie in one ragged numpy array of symbols. Each
round looks up the merge rank of all adjacent pairs at once, takes the lowest rank of each sequence, and
merges all its occurrences from the left (in runs such as a a a, every other pair). Sequences with no
pair left drop out. The symbols that survive are the tokens; ids are never written.

Defined results: null and empty texts have 0 bytes and 0 tokens; the special token's string inside a text
counts as one token, which is the library's default; repeated rows and null doc_ids give a row each; very
long texts and pieces are counted whole; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.llm.common import table
from boxloom.llm.pretoken import TwoAges, chunks, pieces, unsplit

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
NONE = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: itself, or the next unused above 255."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Counter:
    """Counts for one vocabulary file; a worker keeps one for each file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        vocab, merges = found["model"]["vocab"], found["model"]["merges"]
        self.special = next((t["content"] for t in found["added_tokens"] if t["special"]), None)
        self.symbol = np.array([vocab[c] for c in byte_letters()], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        key = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.keys, self.ranks = key[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.cache = TwoAges(lambda p: int(self.merge([p])[0]))

    def merge(self, found: list[str]) -> np.ndarray:
        """The number of tokens of each piece."""
        raw = [p.encode() for p in found]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        count = length.copy()
        symbols = self.symbol[np.frombuffer(b"".join(raw), np.uint8)]
        live = np.arange(len(raw))
        while len(live):
            begin = np.cumsum(length) - length
            key = symbols << 20
            key[:-1] |= symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.ranks[at], NONE)
            rank[begin + length - 1] = NONE  # no pair crosses two sequences
            least = np.minimum.reduceat(rank, begin)
            hit = np.flatnonzero((rank == np.repeat(least, length)) & (rank != NONE))
            fresh = np.diff(hit, prepend=-2) != 1
            run = np.maximum.accumulate(np.where(fresh, hit, 0))
            hit = hit[(hit - run) % 2 == 0]
            symbols[hit] = self.merged[rank[hit]]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            owner = np.repeat(np.arange(len(live)), length)
            length = length - np.bincount(owner[hit], minlength=len(live))
            count[live] = length
            going = (least != NONE) & (length > 1)
            stay &= np.repeat(going, np.bincount(owner, minlength=len(live)))
            symbols, live, length = symbols[stay], live[going], length[going]
        return count

    def count(self, flat: pa.Array, offsets: np.ndarray) -> np.ndarray:
        """The tokens of each row."""
        if not len(flat):
            return np.zeros(len(offsets) - 1, np.int64)
        coded = flat.dictionary_encode()
        each = self.cache.all(coded.dictionary.to_pylist(), lambda new: dict(zip(new, self.merge(new).tolist())))
        sums = np.concatenate([[0], np.cumsum(np.array(each, np.int64)[coded.indices.to_numpy()])])
        return np.diff(sums[offsets])


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def special_of(path: str) -> str | None:
    with open(path, encoding="utf-8") as file:
        return next((t["content"] for t in json.load(file)["added_tokens"] if t["special"]), None)


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``key``, n_bytes, n_tokens, over_limit (n_tokens > limit) of each row of ``docs``."""
    path = path or public_tokenizers.path(VOCABULARY)
    special = special_of(path)
    body = F.coalesce(F.col(text), F.lit(""))
    extra = (F.length(body) - F.length(F.replace(body, F.lit(special), F.lit("")))) / len(special) if special else F.lit(0)
    inner = docs.select(F.col(key).alias("key"), F.octet_length(body).cast("long").alias("n_bytes"), extra.cast("long").alias("extra"), pieces(F.col(text), special).alias("pieces"), unsplit(F.col(text)).alias("odd"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            got = [own.count(flat, offsets) for _, _, flat, offsets in chunks(batch, special)]
            n = np.concatenate(got) if got else np.zeros(0, np.int64)
            n = n + batch.column("extra").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n_bytes"), pa.array(n), pa.array(n > limit)], [key, "n_bytes", "n_tokens", "over_limit"])

    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    )
    return inner.mapInArrow(run, schema)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


QUERIES = {"op6_token_counts": op6_token_counts}
