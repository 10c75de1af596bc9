"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Texts are split into pieces on the JVM. A worker encodes each distinct piece once: the piece is a doubly
linked list of positions, and the new pieces of a batch lie in one such list side by side; every merge
rank that some adjacent pair has owns a bucket of positions; a two-level bitmap over the ranks finds the
lowest non-empty bucket by find-first-set. Entries whose pair has changed meanwhile are skipped. A large
bucket is merged at once in arrays, a small one, or one that brings up a lower rank, entry by entry. A piece
of n bytes takes O(n log n) however long it is, so one endless "word" does not cost n^2.

Defined results: null and empty texts encode to no ids and decode to no bytes; repeated rows and null
doc_ids give a row each; very long texts and pieces are encoded whole; pairs of equal rank merge from the
left; other columns of the input, whatever their names, are ignored by ``digests`` and kept by ``encode``.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.llm.common import table, tidied
from boxloom.llm.pretoken import TwoAges, chunks, pieces, unsplit

VOCABULARY = "byte_bpe_50k.tiktoken"
LEAF_BITS = 8
LEAF_MASK = (1 << LEAF_BITS) - 1
#: Bytes of new pieces that share one queue at most; a longer piece has a queue of its own.
QUEUE_BYTES = 2_000_000
#: Entries from which a bucket is merged in arrays.
AT_ONCE = 24


class RankQueue:
    """A priority queue of positions by merge rank: a bucket for each rank, and a bitmap of two levels over them."""

    def __init__(self, size: int):
        self.buckets: dict[int, list[int]] = {}
        self.leaves = [0] * ((size >> LEAF_BITS) + 1)
        self.top = 0

    def mark(self, rank: int) -> None:
        """Says that the bucket of ``rank`` has come to hold something."""
        high = rank >> LEAF_BITS
        self.leaves[high] |= 1 << (rank & LEAF_MASK)
        self.top |= 1 << high

    def put(self, rank: int, at: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [at]
            self.mark(rank)
        else:
            bucket.append(at)

    def put_all(self, ranks: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, held = ranks[order], places[order].tolist()
        begin = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(held)]
        for rank, a, b in zip(ranks[begin[:-1]].tolist(), begin, begin[1:]):
            bucket = self.buckets.get(rank)
            if bucket is None:
                self.buckets[rank] = held[a:b]
                self.mark(rank)
            else:
                bucket += held[a:b]

    def take(self) -> tuple[int, list[int]]:
        """The lowest rank that is held, by find-first-set on each level, and its whole bucket."""
        high = (self.top & -self.top).bit_length() - 1
        leaf = self.leaves[high]
        bit = leaf & -leaf
        self.leaves[high] = leaf = leaf ^ bit
        if not leaf:
            self.top ^= 1 << high
        rank = high << LEAF_BITS | bit.bit_length() - 1
        return rank, self.buckets.pop(rank)


class Merger:
    """Merges many pieces at once in one queue: pieces do not touch, so rank order over all is rank order in each."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.size = ranks, max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.joined: dict[int, int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    self.joined[a << 20 | b] = rank
        self.first = np.full((256, 256), -1, np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.first[token[0], token[1]] = rank
        keys = np.fromiter(self.joined, np.int64, len(self.joined))
        made = np.fromiter(self.joined.values(), np.int64, len(keys))
        self.rights = self._partners(keys >> 20, keys & 0xFFFFF, made)
        self.lefts = self._partners(keys & 0xFFFFF, keys >> 20, made)
        #: What each token makes with the one whose turn it is; -1 for all between turns.
        self.makes = np.full(self.size, -1, np.int64)

    def _partners(self, own: np.ndarray, other: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begins by ``own``, ``other``, ``made``) in the order of ``own``."""
        order = np.argsort(own, kind="stable")
        return np.searchsorted(own[order], np.arange(self.size + 1)), other[order], made[order]

    def _made(self, partners: tuple[np.ndarray, np.ndarray, np.ndarray], rank: int, tokens: np.ndarray) -> np.ndarray:
        """The ranks of the pairs of ``rank`` with ``tokens``, -1 where there is none."""
        begins, other, made = partners
        some = slice(begins[rank], begins[rank + 1])
        self.makes[other[some]] = made[some]
        out = self.makes[tokens]
        self.makes[other[some]] = -1
        return out

    def _at_once(self, rank: int, bucket: list[int], queue: RankQueue, after: np.ndarray, before: np.ndarray, pair: np.ndarray, token: np.ndarray) -> bool:
        """Merges the whole ``bucket``; False, with nothing changed, if a lower pair would come up on the way."""
        at = np.array(bucket)
        at = np.sort(at[pair[at] == rank])
        if not len(at):
            return True
        if (same := at[1:] == at[:-1]).any():
            at = at[np.concatenate([[True], ~same])]
        # in a run such as a a a, every other pair from the left
        fresh = np.concatenate([[True], at[1:] != after[at[:-1]]])
        if not fresh.all():
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
        gone = after[at]
        following = after[gone]
        ends = following < 0
        # one after the other from the left, a merge would meet what is still unmerged on its right ...
        right = self._made(self.rights, rank, token[following])
        right[ends] = -1
        # ... and what is merged already on its left
        left = before[at]
        near = np.flatnonzero(left[1:] == gone[:-1]) + 1
        left[near] = at[near - 1]
        beside = token[left]
        beside[near] = rank
        made = self._made(self.lefts, rank, beside)
        made[left < 0] = -1
        if ((right >= 0) & (right < rank)).any() or ((made >= 0) & (made < rank)).any():
            return False
        token[at], after[at] = rank, following
        token[gone] = pair[gone] = -1
        before[following[~ends]] = at[~ends]
        pair[at] = right
        inner = left >= 0
        pair[left[inner]] = made[inner]
        right = pair[at]  # what a right neighbour's merge has changed is put as its left pair
        right[near - 1] = -1
        held, back = right >= 0, made >= 0
        if held.any() or back.any():
            queue.put_all(np.concatenate([right[held], made[back]]), np.concatenate([at[held], left[back]]))
        return True

    def merge(self, pieces_: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian bytes: the lowest rank merges next, the leftmost of equal ones."""
        length = np.fromiter(map(len, pieces_), np.int64, len(pieces_))
        end = np.cumsum(length)
        raw = np.frombuffer(b"".join(pieces_), np.uint8)
        n = len(raw)
        places = np.arange(n)
        follow, lead = places + 1, places - 1
        follow[end - 1] = -1
        lead[end - length] = -1
        pairs = np.full(n, -1, np.int64)
        pairs[:-1] = self.first[raw[:-1], raw[1:]]
        pairs[end - 1] = -1
        queue = RankQueue(self.size)
        held = np.flatnonzero(pairs >= 0)
        if len(held):
            queue.put_all(pairs[held], held)
        # the same memory, for one entry at a time and for many
        after, before, pair, token = (array("q", x.tobytes()) for x in (follow, lead, pairs, self.single[raw]))
        views = [np.frombuffer(x, np.int64) for x in (after, before, pair, token)]
        get, put = self.joined.get, queue.put
        while queue.top:
            rank, bucket = queue.take()
            if len(bucket) >= AT_ONCE and self._at_once(rank, bucket, queue, *views):
                continue
            bucket.sort()
            for k, at in enumerate(bucket):
                if pair[at] != rank:
                    continue
                gone = after[at]
                following, left = after[gone], before[at]
                token[at], after[at] = rank, following
                token[gone] = pair[gone] = -1
                low = rank
                if following >= 0:
                    before[following] = at
                    new = pair[at] = get(rank << 20 | token[following], -1)
                    if new >= 0:
                        put(new, at)
                        low = min(low, new)
                else:
                    pair[at] = -1
                if left >= 0:
                    new = pair[left] = get(token[left] << 20 | rank, -1)
                    if new >= 0:
                        put(new, left)
                        low = min(low, new)
                if low < rank:  # a lower pair has come up: it goes before the rest of this bucket
                    if rest := bucket[k + 1 :]:
                        queue.buckets[rank] = rest
                        queue.mark(rank)
                    break
        ids = views[3]
        kept = ids >= 0
        blob = ids[kept].astype("<u4").tobytes()
        stop = np.cumsum(kept)[end - 1] * 4
        return [blob[a:b] for a, b in zip([0, *stop[:-1].tolist()], stop.tolist())]


class Codec:
    """Encoder and decoder for one rank file; a worker keeps one for each file."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            bytes_of[rank] = token
        self.bytes_of = pa.array(bytes_of, pa.large_binary())
        self.merger = Merger(self.ranks)
        self.cache = TwoAges(lambda p: self.fresh([p])[p])

    def fresh(self, found: list[str]) -> dict[str, bytes]:
        """The ids of pieces that the cache does not have."""
        out: dict[str, bytes] = {}
        rest: list[tuple[str, bytes]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if rest:
                out.update(zip([p for p, _ in rest], self.merger.merge([b for _, b in rest])))
                rest.clear()
                held = 0

        for p in found:
            raw = p.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                out[p] = whole.to_bytes(4, "little")
                continue
            if held and held + len(raw) > QUEUE_BYTES:
                flush()
            rest.append((p, raw))
            held += len(raw)
        flush()
        return out

    def encode(self, flat: pa.Array, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in a row, and where each row's ids begin and end."""
        if not len(flat):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        coded = flat.dictionary_encode()
        each = self.cache.all(coded.dictionary.to_pylist(), self.fresh)
        got = pa.array(each, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(got.buffers()[1], np.int64, len(got) + 1) >> 2
        ids = np.frombuffer(got.buffers()[2], "<u4", ends[-1])
        return ids, ends[offsets]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.decode_all(ids, np.array([0, len(ids)]))[0].tobytes()

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> list[memoryview]:
        """The bytes of the ids between each two neighbours of ``bounds``."""
        got = self.bytes_of.take(pa.array(ids, pa.uint32()))
        ends = np.frombuffer(got.buffers()[1], np.int64, len(ids) + 1)[bounds].tolist()
        data = memoryview(got.buffers()[2] or b"")
        return [data[a:b] for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _pieces_of(docs: DataFrame, text: str, keep: list) -> DataFrame:
    return docs.select(*keep, pieces(F.col(text)).alias("pieces"), unsplit(F.col(text)).alias("odd"))


def encode(docs: DataFrame, text: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """``docs`` with the ids of ``text`` as a new column ``out`` (array<int>); a column of that name is replaced."""
    path = path or public_tokenizers.path(VOCABULARY)
    kept = [c for c in docs.columns if c != out]
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), pieces(F.col(text)).alias("pieces"), unsplit(F.col(text)).alias("odd"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for row, end, flat, offsets in chunks(batch):
                ids, bounds = own.encode(flat, offsets)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(row, end - row), lists], ["row", out])

    schema = T.StructType([T.StructField("row", inner.schema["row"].dataType), T.StructField(out, T.ArrayType(T.IntegerType()))])
    return inner.mapInArrow(tidied(run), schema).select("row.*", F.col(out))


def decode(coded: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``coded`` with the bytes of its ids as a new column ``out`` (binary); null ids give empty bytes."""
    path = path or public_tokenizers.path(VOCABULARY)
    kept = [c for c in coded.columns if c != out]
    inner = coded.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(ids).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            got = [own.decode(np.asarray(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(got, pa.binary())], ["row", out])

    schema = T.StructType([T.StructField("row", inner.schema["row"].dataType), T.StructField(out, T.BinaryType())])
    return inner.mapInArrow(tidied(run), schema).select("row.*", F.col(out))


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Encodes, then decodes the ids, in one pass: ``key``, n_tokens, ids_sha256, decoded_sha256; also ids if asked."""
    path = path or public_tokenizers.path(VOCABULARY)
    inner = _pieces_of(docs, text, [F.col(key).alias("key")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        sha = hashlib.sha256
        for batch in batches:
            for row, end, flat, offsets in chunks(batch):
                ids, bounds = own.encode(flat, offsets)
                rows = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
                cols = [
                    batch.column("key").slice(row, end - row),
                    pa.array(np.diff(bounds)),
                    pa.array([sha(x.tobytes()).hexdigest() for x in rows]),
                    pa.array([sha(x).hexdigest() for x in own.decode_all(ids, bounds)]),
                ]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names)

    fields = [(key, docs.schema[key].dataType), ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    fields += [("ids", T.ArrayType(T.IntegerType()))] * with_ids
    names = [name for name, _ in fields]
    return inner.mapInArrow(tidied(run), T.StructType([T.StructField(*f) for f in fields]))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op3_byte_bpe": op3_byte_bpe}
