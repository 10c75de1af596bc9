"""Exact substring dedup by a logarithmic family of suffix arrays.

A byte is removed if a LENGTH-byte string that covers it also starts in a document with a smaller id.

Whole copies of a text of a smaller document (equal in two independent 64-bit hashes) lose every byte and
are left out of what follows; only the least document of each text remains. Every LENGTH-byte window has an
anchor, the place in it with the least hash of GRAM bytes. Equal windows have equal anchors, so only
windows whose anchor gram occurs in two documents can repeat, and windows need to meet only those with the
same anchor gram. Anchor grams (about one byte in sixteen) are aggregated to their least and greatest
document; those in several documents mark a bitmap, sized by their number up to MAX_GRAM_BITS. A second
pass sends the fragments around anchors that pass the bitmap to the tasks that own their gram. A fragment
that the same task has sent before from a smaller document (128-bit digests) is answered on the spot, so a
passage that many documents share sends few rows to its owner. There, fragments are sorted by a slice of
their grams and by document, and feed batch by batch an index family, one for each slice: a batch gets a
suffix array (prefix doubling, limited to LENGTH bytes), is merge-scanned against the sorted suffixes of
all existing levels, and becomes a new level; levels of like size merge, so a suffix is merged O(log n)
times. Fragments that the family has as a whole from a smaller document are answered by digest as well.
What the bitmap lets through by chance costs time only.

Defined results: null and empty texts, and texts of under LENGTH bytes, lose nothing; rows with a null key
neither lose nor remove anything; rows with equal keys do not remove from each other; the key is a whole
number (anything else is cast to one, and counts as null where that fails); very long texts are worked on in
overlapping pieces; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import Shelf, bitmap, let, may_hold, table
from boxloom.llm.shingling import chunks

LENGTH = 50
GRAM = 20
SPAN = LENGTH - GRAM + 1
#: Bytes of text that a worker hashes at once.
CHUNK = 400_000
#: Bits of the map of repeated grams: GRAM_LOAD for each, within these bounds; and of the map of documents that lose something.
MIN_GRAM_BITS, MAX_GRAM_BITS, GRAM_LOAD = 1 << 20, 1 << 28, 16
DOC_BITS = 1 << 22
#: Window starts in one batch of the index family.
BATCH = 100_000
#: Slices of a task's grams that have an index family of their own, one after the other.
SLICES = 16
#: Fragments whose digests a worker remembers.
REMEMBERED = 200_000


def _slide(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (or greatest) of x[i : i + width], for each i at which that lies inside."""
    pick, have = (np.minimum if least else np.maximum), 1
    while have * 2 <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def _grams(raw: np.ndarray) -> np.ndarray:
    """The hash of the GRAM bytes at each place."""
    n = len(raw) - GRAM + 1
    eight = np.ndarray((len(raw) - 7,), "<u8", raw.tobytes(), strides=(1,)).copy()
    h = eight[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += eight[8 : 8 + n]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h += eight[GRAM - 8 : GRAM - 8 + n]
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def anchors(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, gram hashes of all places, least short hash of each window, 0 if it crosses an end of a text).

    ``ends`` are the ends of the texts that lie side by side in ``raw``.
    """
    if len(raw) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    h = _grams(raw)
    short = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    low = _slide(short, SPAN, True)
    begins = np.maximum(np.concatenate([[0], ends[:-1]]), ends - LENGTH + 1)
    change = np.zeros(len(low) + LENGTH + 1, np.int32)
    np.add.at(change, np.minimum(begins, len(change) - 1), 1)
    np.add.at(change, np.minimum(ends, len(change) - 1), -1)
    valid = np.cumsum(change)[: len(low)] == 0
    low = np.where(valid, low, np.uint32(0))
    padded = np.concatenate([np.zeros(SPAN - 1, np.uint32), low, np.zeros(SPAN - 1, np.uint32)])
    places = np.flatnonzero(_slide(padded, SPAN, False)[: len(short)] == short)
    return places, h, low


def _chunks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(rows, bytes, ends, place in the text) of parts of a batch with a column ``raw`` of binaries.

    Texts longer than ``size`` come in pieces that overlap by LENGTH - 1 bytes: each window lies in one of them.
    """
    for a, b, data, ends in chunks(batch.column("raw"), size):
        if b - a > 1 or len(data) <= size:
            yield np.arange(a, b), data, ends, 0
            continue
        for at in range(0, len(data) - LENGTH + 1, size):
            piece = data[at : at + size + LENGTH - 1]
            yield np.array([a]), piece, np.array([len(piece)]), at


def gram_table(docs: DataFrame) -> DataFrame:
    """(h, key) of the anchors of ``docs`` (key, raw)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for rows, raw, ends, _ in _chunks(batch, CHUNK):
                at, h, _ = anchors(raw, ends)
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(keys[rows[np.searchsorted(ends, at, "right")]])], ["h", "key"])

    return docs.select("key", "raw").mapInArrow(run, "h long, key long")


def fragment_table(docs: DataFrame, held) -> DataFrame:
    """(h, key, th, at, stop, bytes): what lies around anchors whose gram the broadcast bitmap ``held`` may hold.

    Rows without bytes are ranges that are known to repeat already; their h only deals them out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        least: dict[bytes, int] = {}  # of fragments that were sent on: their least document
        for batch in batches:
            keys, hashes = batch.column("key").to_numpy(), batch.column("th").to_numpy()
            for rows, raw, ends, shift in _chunks(batch, CHUNK):
                at, h, low = anchors(raw, ends)
                place = bit_of(h[at], len(bits) * 64)
                at = at[(bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
                if not len(at):
                    continue
                short = ((h[at] >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]
                starts = at[:, None] + np.arange(-SPAN + 1, 1)
                inside = (starts >= 0) & (starts < len(low))
                mine = inside & (low[np.clip(starts, 0, len(low) - 1)] == short)
                begin = at - SPAN + 1 + mine.argmax(1)
                stop = at - mine[:, ::-1].argmax(1) + LENGTH
                doc = np.searchsorted(ends, at, "right")
                key = keys[rows[doc]]
                text = raw.tobytes()
                pieces: list[bytes | None] = [text[a:b] for a, b in zip(begin.tolist(), stop.tolist())]
                of = key.tolist()
                for i in np.argsort(key, kind="stable").tolist():
                    name = xxhash.xxh3_128_digest(pieces[i])
                    if least.get(name, of[i]) < of[i]:
                        pieces[i] = None
                    else:
                        least[name] = of[i]
                if len(least) > REMEMBERED:
                    least.clear()
                base = np.concatenate([[0], ends])[doc] - shift
                known = np.array([x is None for x in pieces])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.where(known, key, h[at].view(np.int64))),
                        pa.array(key),
                        pa.array(hashes[rows[doc]]),
                        pa.array(begin - base),
                        pa.array(stop - base),
                        pa.array(pieces, pa.binary()),
                    ],
                    ["h", "key", "th", "at", "stop", "bytes"],
                )

    return docs.select("key", "th", "raw").mapInArrow(run, "h long, key long, th long, at long, stop long, bytes binary")


def bit_of(h: np.ndarray, bits: int) -> np.ndarray:
    """The bit of a gram in a map of ``bits`` (a power of two)."""
    return (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits.bit_length() + 1)


class Level:
    """Sorted distinct suffixes, cut to LENGTH bytes, with the least document of each."""

    def __init__(self, keys: np.ndarray, docs: np.ndarray):
        self.keys, self.docs = keys, docs

    def least(self, keys: np.ndarray, none: int) -> np.ndarray:
        """The least document of each of the sorted ``keys``; ``none`` where the level does not have it."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.docs[at], none)

    def merged(self, other: Level) -> Level:
        keys = np.concatenate([self.keys, other.keys])
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], np.concatenate([self.docs, other.docs])[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return Level(keys[first], np.minimum.reduceat(docs, first))


def suffix_array(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of ``starts`` by their LENGTH bytes, rank of each: equal for equal bytes), by prefix doubling."""
    n = len(raw)
    wide = np.concatenate([raw, np.zeros(8, np.uint8)])
    key = np.ndarray((n,), ">u8", wide.tobytes(), strides=(1,)).astype(np.uint64)
    need = np.zeros(n, bool)
    sixteens = (0, 16, LENGTH - 32, LENGTH - 16)
    for k in sixteens:
        need[starts + k] = need[starts + k + 8] = True
    some = np.flatnonzero(need)
    rank = np.zeros(n, np.int64)
    rank[some] = np.unique(key[some], return_inverse=True)[1]
    for step, offsets in ((8, sixteens), (16, (0, LENGTH - 32))):
        need[:] = False
        for k in offsets:
            need[starts + k] = True
        some = np.flatnonzero(need)
        rank_ = np.zeros(n, np.int64)
        rank_[some] = np.unique(rank[some] << 32 | rank[some + step], return_inverse=True)[1]
        rank = rank_
    last = rank[starts] << 32 | rank[starts + LENGTH - 32]
    order = np.argsort(last, kind="stable")
    return order, last


class Family:
    """Levels of geometrically growing size."""

    def __init__(self):
        self.levels: list[Level] = []

    def add(self, raw: np.ndarray, starts: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The least document, of this batch and all before, that has the LENGTH bytes at each start."""
        order, rank = suffix_array(raw, starts)
        ranked = rank[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        keys = np.ndarray((len(raw) - LENGTH + 1,), f"S{LENGTH}", raw.tobytes(), strides=(1,))[starts[order[first]]]
        least = np.minimum.reduceat(docs[order], first)
        found = least
        for level in self.levels:
            found = np.minimum(found, level.least(keys, np.iinfo(np.int64).max))
        fresh = found == least
        new = Level(keys[fresh], least[fresh])
        if len(new.keys):
            self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2].keys) <= 2 * len(self.levels[-1].keys):
            last = self.levels.pop()
            self.levels[-1] = self.levels[-1].merged(last)
        out = np.empty(len(starts), np.int64)
        out[order] = np.repeat(found, np.diff(np.append(first, len(starts))))
        return out


def repeated_spans(fragments: DataFrame) -> DataFrame:
    """(key, th, start, stop): byte ranges that occur in documents with smaller keys."""
    dealt = fragments.repartition("h").withColumn("slice", F.pmod(F.xxhash64(F.lit(3), "h"), F.lit(SLICES)).cast("int")).sortWithinPartitions("slice", "key", "th", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, slice_ = Family(), -1
        memo: dict[bytes, int] = {}  # whole fragments that the family has, with their least document

        def answer(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch | None:
            """The repeated ranges of new fragments, which join the family."""
            key, th, at = (np.array([r[k] for r in rows], np.int64) for k in range(3))
            size = np.array([len(r[3]) for r in rows])
            count = size - LENGTH + 1
            raw = np.frombuffer(b"".join([r[3] for r in rows]), np.uint8)
            own = np.repeat(np.arange(len(size)), count)
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            gone = family.add(raw, (np.cumsum(size) - size)[own] + step, key[own]) < key[own]
            edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            inner = np.flatnonzero(gone[1:] & gone[:-1] & (own[1:] != own[:-1])) + 1
            first = np.sort(np.concatenate([np.flatnonzero(edge == 1), inner]))
            last = np.sort(np.concatenate([np.flatnonzero(edge == -1), inner])) - 1
            if not len(first):
                return None
            of = own[first]
            return pa.RecordBatch.from_arrays([pa.array(key[of]), pa.array(th[of]), pa.array(at[of] + step[first]), pa.array(at[of] + step[last] + LENGTH)], ["key", "th", "start", "stop"])

        for batch in batches:
            new: list[tuple[int, int, int, bytes]] = []
            windows = 0
            known: list[tuple[int, int, int, int]] = []
            for now, *row, stop, piece in zip(*(batch.column(c).to_pylist() for c in ("slice", "key", "th", "at", "stop", "bytes"))):
                if piece is None:
                    known.append((*row, stop))
                    continue
                if now != slice_ or windows >= BATCH:
                    out = answer(new) if new else None
                    new, windows = [], 0
                    if out is not None:
                        yield out
                    if now != slice_:  # grams of another slice have nothing in common with these
                        family, slice_ = Family(), now
                        memo.clear()
                if memo.setdefault(xxhash.xxh3_128_digest(piece), row[0]) < row[0]:  # all its windows start in that document
                    known.append((*row, stop))
                    continue
                new.append((*row, piece))
                windows += len(piece) - LENGTH + 1
            if new:
                out = answer(new)
                if out is not None:
                    yield out
            if len(memo) > REMEMBERED:
                memo.clear()
            if known:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*known)], ["key", "th", "start", "stop"])

    return dealt.select("slice", "key", "th", "at", "stop", "bytes").mapInArrow(run, "key long, th long, start long, stop long")


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open ranges as maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _hashed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, raw and two independent hashes of the text; rows without a key or with short texts are left out."""
    rows = docs.select(F.col(key).try_cast("long").alias("key"), F.col(text).cast("binary").alias("raw")).where(f"key IS NOT NULL AND octet_length(raw) >= {LENGTH}")
    return rows.select("key", F.xxhash64("raw").alias("th"), F.xxhash64(F.lit(7), "raw").alias("th2"), "raw")


def copies_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(th, th2, low) of the texts of LENGTH bytes or more that several keys have, with the least of these."""
    return _hashed(docs, key, text).groupBy("th", "th2").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("th", "th2", "low")


def dedup(docs: DataFrame, copies: DataFrame, shelf: Shelf, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, th, spans (array of start, stop), kept (binary) of each distinct (key, text) that loses bytes.

    Whole copies of a text of a smaller document, see ``copies`` (from ``copies_of``), are not listed: they lose
    every byte.
    """
    # texts that occur once stay where they are; of the others only the copies in the least document count
    marked = _hashed(docs, key, text).withColumn("map", bitmap(copies, "th", DOC_BITS).scalar())
    flagged = marked.select("key", "th", "th2", "raw", let(F.col("map"), lambda m: may_hold(m, F.col("th"))).alias("held"))
    some = shelf.put(flagged.where("held").select("key", "th", "th2", "raw").join(copies, ["th", "th2"], "left").where("low IS NULL OR key = low").select("key", "th", "raw"))
    first = flagged.where("NOT held").select("key", "th", "raw").unionByName(some)
    grams = shelf.put(gram_table(first).groupBy("h").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("h"))
    spans = repeated_spans(fragment_table(first, docs.sparkSession.sparkContext.broadcast(_gram_map(grams))))
    per_doc = shelf.put(spans.groupBy("key", "th").agg(F.collect_set(F.struct("start", "stop")).alias("spans")))
    may = first.withColumn("map", bitmap(per_doc, "th", DOC_BITS).scalar())
    near = may.where(let(F.col("map"), lambda m: may_hold(m, F.col("th")))).select("key", "th", "raw")
    hit = near.join(per_doc, ["key", "th"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, kept = [], []
            for raw_, spans_ in zip(batch.column("raw").to_pylist(), batch.column("spans").to_pylist()):
                merged = merge_spans([(x["start"], x["stop"]) for x in spans_])
                at, parts = 0, []
                for a, b in merged:
                    parts.append(raw_[at:a])
                    at = b
                runs.append([{"start": a, "stop": b} for a, b in merged])
                kept.append(b"".join([*parts, raw_[at:]]))
            span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("th"), pa.array(runs, pa.list_(span)), pa.array(kept, pa.binary())], ["key", "th", "spans", "kept"])

    return hit.select("key", "th", "raw", "spans").mapInArrow(run, "key long, th long, spans array<struct<start:long,stop:long>>, kept binary")


#: Bits of one block of the bitmap of grams.
BLOCK_BITS = 1 << 18


def _gram_map(grams: DataFrame) -> np.ndarray:
    """The bitmap of the grams, GRAM_LOAD bits for each but MAX_GRAM_BITS at most; the driver gets its blocks."""
    bits = 1 << max(MIN_GRAM_BITS, min(MAX_GRAM_BITS, GRAM_LOAD * grams.count())).bit_length() - 1

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = bit_of(batch.column("h").to_numpy().view(np.uint64), bits).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place // BLOCK_BITS), pa.array(place % BLOCK_BITS)], ["block", "place"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            of, at = batch.column("block").to_numpy(), batch.column("place").to_numpy()
            for k in np.unique(of).tolist():
                held.setdefault(k, np.zeros(BLOCK_BITS, bool))[at[of == k]] = True
        for k, marks in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())], ["block", "bits"])

    dealt = grams.select("h").mapInArrow(places, "block long, place long").repartition("block")
    out = np.zeros(bits // 64, np.uint64)
    for row in dealt.mapInArrow(blocks, "block long, bits binary").toLocalIterator():
        out[row["block"] * (BLOCK_BITS // 64) : (row["block"] + 1) * (BLOCK_BITS // 64)] |= np.frombuffer(row["bits"], "<u8")
    return out


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_bytes, n_removed, n_spans, kept_sha256 of each row of ``docs``."""
    shelf = Shelf(docs.sparkSession)
    copies = shelf.put(copies_of(docs, key, text))
    lost = dedup(docs, copies, shelf, key, text)
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    cut_ = shelf.put(lost.select("key", "th", size.alias("removed"), F.size("spans").cast("long").alias("runs"), F.sha2("kept", 256).alias("sha")).dropDuplicates(["key", "th"]))
    shelf.clear(cut_, copies)
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    # the hashes are those of _hashed
    rows = docs.select(F.col(key).alias("given"), F.col(key).try_cast("long").alias("key"), F.xxhash64(raw).alias("th"), F.xxhash64(F.lit(7), raw).alias("th2"), F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("whole"))
    zero = F.lit(0).cast("long")
    joined = rows.join(cut_, ["key", "th"], "left").join(copies, ["th", "th2"], "left")
    copy = F.coalesce((F.col("low") < F.col("key")) & (F.col("n_bytes") >= LENGTH), F.lit(False))
    return joined.select(
        F.col("given").alias(key),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("removed", zero)).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("runs", zero)).alias("n_spans"),
        F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"),
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op7_suffix_dedup": op7_suffix_dedup}
