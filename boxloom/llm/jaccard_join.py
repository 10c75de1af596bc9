"""N-gram Jaccard join by PartEnum signatures.

Sets of five-word shingles fall into levels of sizes, each up to twice its start. Two sets that link
(similarity at least 3/4, sizes a <= b) differ in at most d = (a + b) / 7 <= a / 3 shingles. The scheme of a
level cuts the hash domain into first-level groups and each group into three sub-partitions. By counting,
if a set has more than d / 2 groups with two filled sub-partitions, a linked set differs from it in at most
one shingle of one of them, so two of that group's three sub-partitions agree: each of the three subsets of
two is a signature. A set gives signatures of its groups in the order of the hash domain until more than
n / 3 differences are covered, plus a SLACK; where two sets stop at different places, the one that stops
first has enough groups by itself. A set gives signatures for its own level and, as the smaller set, for the
next one if a partner may lie there. Sets of at most SMALL shingles, and those that fill too few groups
of a scheme, also enumerate single shingles in the same order; one partner with enough groups suffices, so
these are needed only among themselves. No link is lost, whatever the data.

Because of the SLACK, linked sets share not one but ``least_shared`` signatures, which rules out nearly all
pairs and sets that meet through common passages. Sets that are equal collapse to one class before.
Signatures travel as packed blocks; a bucket (one signature) of at most ``bucket`` classes gives its pairs,
counted over all signatures, and pairs with enough of them are verified, first the best one of each class,
then those that still join two components, a quarter of the hash domain first.

Larger buckets are settled by their members: what has enough signatures in buckets of mixed components
stays, unless so few of its shingles occur in sets of other components that it cannot link to one. Stars
around the members with the most such shingles join most of them. What is left goes by its rarest shingles:
of two sets that must have k in common, the first n - k + 1 in any common order meet, and in the order of
frequency among these sets they are hardly ever those that make the buckets large. Pairs of different
components that meet there are verified. A signature that is hot within one task sends on
``bucket`` + 1 members, which show that it is large, and the others as members only, dealt out evenly.

Defined results: null, empty and blank texts have an empty set, link with nothing and are their own
component; texts of under five words have one shingle; repeated rows are members of one class; rows with a
null key take part, and their component is the least key that is not null; very long texts are sets like
others; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxloom.llm.common import Shelf, shuffle_partitions, table, tidied
from boxloom.llm.components import SMALL_GRAPH, components, merged
from boxloom.llm.shingling import GOLD, chunks, mix, shingle_sets

PERCENT = 75
SMALL = 40
SLACK = 60
BUCKET = 12
#: Rounds of stars in large buckets before their remaining pairs are formed, and the share of buckets that each uses.
STARS, STAR_SHARE = 2, 8
#: Sets whose remaining pairs are formed without more stars.
FEW_SETS = 4_000
#: Pairs, and shingles of their sets, that are verified in one pass; the pairs go to all tasks.
FEW_PAIRS, FEW_SHINGLES = 50_000, 16_000_000
#: Signatures that a worker gathers before it sends them on, and members of one signature in these that count as many.
FLUSH = 500_000
HOT = 64
#: Sets whose names a worker remembers, to skip copies.
REMEMBERED = 100_000
MAP_BITS = 1 << 24


# ---- signatures ---------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def levels() -> tuple[np.ndarray, np.ndarray]:
    """(least size, groups) of each level; level 0 has single shingles only."""
    lows, groups, low = [1], [0], SMALL + 1
    while low < 2**31:
        top = 2 * (low - 1)
        load = 3.0 if top <= 80 else 3.5 if top <= 160 else 4.0 if top <= 320 else 4.6 if top <= 640 else 4.9
        lows.append(low)
        groups.append(int(np.ceil(top / load)))
        low = top + 1
    return np.array(lows), np.array(groups)


def groups_needed(n):
    """Filled groups that a set of ``n`` shingles gives signatures of: twice as many cover n / 3 differences and more."""
    return n // 6 + 1 + n // SLACK


def singles_needed(n):
    """Single shingles that a set gives, where groups do not suffice."""
    return n // 3 + 1 + n // (SLACK // 2)


def least_shared(n, m):
    """How many signatures linked sets of ``n`` and ``m`` shingles share at least."""
    k = np.minimum(n, m)
    return np.minimum(2 * groups_needed(k), singles_needed(k)) - (n + m) * (100 - PERCENT) // (100 + PERCENT)


def level_signatures(s: np.ndarray, size: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) of sets (sorted, one behind the other, none empty), each under the scheme of its ``level``."""
    of = np.repeat(np.arange(len(size)), size)
    lacks = level == 0
    sigs, owner = [], []
    if not lacks.all():
        needed = groups_needed(size)
        in_groups = ~lacks[of]
        x, xo = s[in_groups], of[in_groups]
        cell = ((x >> np.uint64(32)) * (3 * levels()[1][level[xo]]).astype(np.uint64)) >> np.uint64(32)
        run = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (xo[1:] != xo[:-1])]))
        content = np.add.reduceat(mix(x), run)
        cell, xo = cell[run].astype(np.int64), xo[run]
        group = cell // 3
        begins = np.concatenate([[True], (group[1:] != group[:-1]) | (xo[1:] != xo[:-1])])
        row = np.cumsum(begins) - 1
        group, set_ = group[begins], xo[begins]
        parts = np.zeros((len(group), 3), np.uint64)
        parts[row, cell - 3 * (cell // 3)] = content
        filled = np.bincount(row) >= 2
        done = np.cumsum(filled)
        first = np.flatnonzero(np.concatenate([[True], set_[1:] != set_[:-1]]))
        before = np.zeros(len(size), np.int64)
        before[set_[first]] = done[first] - filled[first]
        give = done - before[set_] - filled < needed[set_]
        for a, b in ((0, 1), (0, 2), (1, 2)):
            some = give & ((parts[:, a] != 0) | (parts[:, b] != 0))
            tag = mix((group[some] * 4 + a + b).astype(np.uint64) + level[set_[some]].astype(np.uint64) * GOLD)
            sigs.append(mix((parts[some, a] + parts[some, b]) ^ tag))
            owner.append(set_[some])
        lacks = lacks | (np.bincount(set_, filled, len(size)) < needed)
    place = np.arange(len(s)) - np.repeat(np.cumsum(size) - size, size)
    single = lacks[of] & (place < singles_needed(size)[of])
    sigs.append(mix(s[single] ^ GOLD) + level[of[single]].astype(np.uint64))
    owner.append(of[single])
    return np.concatenate(sigs), np.concatenate(owner)


def signatures(s: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) under all schemes that concern the sets."""
    lows = levels()[0]
    level = np.searchsorted(lows, size, "right") - 1
    up = size * 100 >= lows[level + 1] * PERCENT
    own = level_signatures(s, size, level)
    if not up.any():
        return own
    sig, of = level_signatures(s[np.repeat(up, size)], size[up], level[up] + 1)
    return np.concatenate([own[0], sig]), np.concatenate([own[1], np.flatnonzero(up)[of]])


def set_ids(s: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; its last byte tells the size to within a twelfth."""
    if not len(size):
        return np.zeros(0, np.int64)
    h = mix(np.add.reduceat(mix(s + GOLD), np.cumsum(size) - size) ^ size.astype(np.uint64))
    return ((h & ~np.uint64(255)) | (np.log(size) / 0.0843).astype(np.uint64)).view(np.int64)


#: ln(4 / 3) / 0.0843, rounded up.
FAR = 4


def may_fit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """False if the sizes of the sets named ``a`` and ``b`` are certainly too different to link."""
    return np.abs((a & 255) - (b & 255)) <= FAR


# ---- over the documents -------------------------------------------------------------------------------


def _raw(docs: DataFrame, text: str, *more: Column) -> DataFrame:
    return docs.select(*more, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, shingles, set sizes, names of the sets that are not empty) of parts of a batch."""
    for a, b, data, ends in chunks(batch.column("raw")):
        s, size = shingle_sets(data, ends)
        yield a, b, s, size, set_ids(s, size[size > 0])


def set_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, sid) of each row; sid is null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, size, sids in _sets(batch):
                sid = np.zeros(len(size), np.int64)
                sid[size > 0] = sids
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(a, b - a), pa.array(size), pa.array(sid, mask=size == 0)], ["key", "n", "sid"])

    kind = docs.schema[key].dataType.simpleString()
    return _raw(docs, text, F.col(key).alias("key")).mapInArrow(tidied(run), f"key {kind}, n long, sid long")


def by_part(sig: np.ndarray, parts: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(order, [(part, from, to)]): numbers dealt out over ``parts`` by their lowest bits."""
    part = (((sig & np.uint64(0xFFFFFF)) * np.uint64(parts)) >> np.uint64(24)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
    return order, [(p, a, b) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]


def packed(sig: np.ndarray, sid: np.ndarray) -> bytes:
    """Rows (48 bits of a signature, set) as bytes; a run of one set has its name once, and the number of its rows."""
    begin = np.flatnonzero(np.concatenate([[True], sid[1:] != sid[:-1]])) if len(sid) else np.zeros(0, np.int64)
    count = np.diff(np.append(begin, len(sid)))
    wide = int(count.max(initial=0)) > 255
    head = np.array([len(sig), len(begin), wide], "<u4")
    return b"".join([head.tobytes(), sid[begin].tobytes(), (sig >> np.uint64(32)).astype(np.uint32).tobytes(), (sig >> np.uint64(16)).astype(np.uint16).tobytes(), count.astype(np.uint32 if wide else np.uint8).tobytes()])


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m, wide = np.frombuffer(block, "<u4", 3).tolist()
    names = np.frombuffer(block, np.int64, m, 12)
    at = 12 + 8 * m
    high, low = np.frombuffer(block, np.uint32, n, at), np.frombuffer(block, np.uint16, n, at + 4 * n)
    count = np.frombuffer(block, np.uint32 if wide else np.uint8, m, at + 6 * n)
    return high.astype(np.uint64) << np.uint64(16) | low, np.repeat(names, count)


def signature_blocks(docs: DataFrame, text: str, bucket: int, parts: int) -> DataFrame:
    """(part, open, block): packed signatures of all sets by the ``part`` that owns them.

    Rows with open are members of signatures that are large already; any part may have them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size_held = turn = 0

        def emit() -> pa.RecordBatch:
            sig, sid = (np.concatenate([x[k] for x in held]) for k in range(2))
            held.clear()
            order = np.argsort(sig)
            ranked = sig[order]
            begin = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
            count = np.diff(np.append(begin, len(ranked)))
            rest = np.zeros(len(sig), bool)  # rows stay set by set, which packs them best
            rest[order] = (np.arange(len(sig)) - np.repeat(begin, count) > bucket) & np.repeat(count > HOT, count)
            rows = []
            if rest.any():
                owner = (((sig[rest] & np.uint64(0xFFFFFF)) * np.uint64(parts)) >> np.uint64(24)).astype(np.int32)
                rows.append((int(sid[0] + turn) % parts, True, packed(sig[rest], sid[rest]), owner.tobytes()))
            sig, sid = sig[~rest], sid[~rest]
            order, cuts = by_part(sig, parts)
            sig, sid = sig[order], sid[order]
            rows += [(p, False, packed(sig[a:b], sid[a:b]), None) for p, a, b in cuts]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary())],
                ["part", "open", "block", "owners"],
            )

        for batch in batches:
            for _, _, s, size, sids in _sets(batch):
                size = size[size > 0]
                new = np.zeros(len(sids), bool)
                for i, sid in enumerate(sids.tolist()):
                    if sid not in seen:
                        seen.add(sid)
                        new[i] = True
                if new.any():
                    sig, of = signatures(s[np.repeat(new, size)], size[new])
                    order = np.argsort(of, kind="stable")
                    held.append((sig[order], sids[new][of[order]]))
                    size_held += len(sig)
                if size_held >= FLUSH or len(seen) > REMEMBERED:
                    if held:
                        yield emit()
                    size_held, turn = 0, turn + 1
                    if len(seen) > REMEMBERED:  # only here: no set is twice in what is sent on together
                        seen.clear()
        if held:
            yield emit()

    return _raw(docs, text).mapInArrow(tidied(run), "part int, open boolean, block binary, owners binary")


def bucket_rows(blocks: DataFrame, bucket: int, parts: int) -> DataFrame:
    """Kind 0 rows are pairs (a, b, n signatures shared in small buckets), kind 1 rows (a set, b signature) of large buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def rows(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(a), pa.array(b.view(np.int64)), pa.array(n.astype(np.int32))], ["kind", "a", "b", "n"])

        def named(sig: np.ndarray, part: np.ndarray) -> np.ndarray:
            return mix(sig + part.astype(np.uint64) * GOLD)

        def open_rows(sig: np.ndarray, sid: np.ndarray, part: np.ndarray) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(sig), 100_000):
                yield rows(1, sid[k : k + 100_000], named(sig[k : k + 100_000], part[k : k + 100_000]), np.ones(len(sig[k : k + 100_000])))

        def work(part: int, blocks_: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            sig, sid = (np.concatenate([x[k] for x in blocks_]) for k in range(2))
            blocks_.clear()
            order = np.argsort(sig)
            ranked = sig[order]
            same = ranked[1:] == ranked[:-1]
            shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            sig, sid = ranked[shared], sid[order[shared]]
            order = np.lexsort((sid, sig))
            sig, sid = sig[order], sid[order]
            fresh = np.ones(len(sig), bool)
            fresh[1:] = (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])
            sig, sid = sig[fresh], sid[fresh]
            if not len(sig):
                return
            begin = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            count = np.diff(np.append(begin, len(sig)))
            large = np.repeat(count > bucket, count)
            yield from open_rows(sig[large], sid[large], np.full(int(large.sum()), part))
            sig, sid = sig[~large], sid[~large]
            pairs: list[tuple[np.ndarray, np.ndarray]] = []
            for step in range(1, bucket):
                near = np.flatnonzero(sig[step:] == sig[:-step])
                if not len(near):
                    break
                a, b = sid[near], sid[near + step]  # a < b, as the sets of a bucket are in order
                fits = may_fit(a, b)
                pairs.append((a[fits], b[fits]))
            if pairs:
                a, b = (np.concatenate([x[k] for x in pairs]) for k in range(2))
                order = np.lexsort((b, a))
                a, b = a[order], b[order]
                first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
                n = np.diff(np.append(first, len(a)))
                for k in range(0, len(first), 100_000):
                    at = first[k : k + 100_000]
                    yield rows(0, a[at], b[at], n[k : k + 100_000])

        for batch in batches:
            for part, open_, block, owners in zip(*(batch.column(c).to_pylist() for c in ("part", "open", "block", "owners"))):
                if open_:
                    yield from open_rows(*unpacked(block), np.frombuffer(owners, np.int32).astype(np.int64))
                else:
                    held.setdefault(part, []).append(unpacked(block))
        for part in sorted(held):
            yield from work(part, held.pop(part))

    return blocks.repartitionById(parts, "part").mapInArrow(tidied(run), "kind byte, a long, b long, n int")


# ---- verification -------------------------------------------------------------------------------------


def sid_map(sids: DataFrame) -> np.ndarray:
    """A bitmap of MAP_BITS over the sets named in ``sids`` (sid); its size does not depend on their number."""
    place = F.shiftrightunsigned("sid", 20).bitwiseAND(F.lit(MAP_BITS - 1))
    words = sids.select(F.shiftright(place, 6).cast("int").alias("i"), F.pmod(place, F.lit(64)).cast("int").alias("b")).groupBy("i").agg(F.expr("bit_or(shiftleft(1L, b))").alias("w"))
    found = words.toPandas()
    out = np.zeros(MAP_BITS // 64, np.int64)
    out[found["i"].to_numpy(np.int64)] = found["w"].to_numpy(np.int64)
    return out.view(np.uint64)


def set_arrays(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(sid, n, low, high): the shingles of the sets named in ``wanted`` (sid), those in the lowest quarter of the domain apart.

    Only sets that pass a bitmap of fixed size leave the scan; the join is exact.
    """
    held = docs.sparkSession.sparkContext.broadcast(sid_map(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = held.value, set()
        for batch in batches:
            for _, _, s, size, sids in _sets(batch):
                size = size[size > 0]
                out = []
                place = (sids.view(np.uint64) >> np.uint64(20)) & np.uint64(MAP_BITS - 1)
                may = (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
                begin = np.cumsum(size) - size
                for i in np.flatnonzero(may).tolist():
                    if (sid := int(sids[i])) in seen:
                        continue
                    seen.add(sid)
                    x = s[begin[i] : begin[i] + size[i]]
                    k = int(np.searchsorted(x, np.uint64(1 << 62)))
                    out.append((sid, len(x), x[:k].tobytes(), x[k:].tobytes()))
                if out:
                    cols = list(zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())], ["sid", "n", "low", "high"])
                if len(seen) > REMEMBERED:
                    seen.clear()

    found = _raw(docs, text).mapInArrow(tidied(run), "sid long, n long, low binary, high binary")
    return found.join(wanted, "sid", "left_semi").dropDuplicates(["sid"])


def in_common(x: pa.Array, y: pa.Array) -> np.ndarray:
    """How many numbers the sorted binary arrays share, row by row."""
    out = np.zeros(len(x), np.int64)
    for i, (a, b) in enumerate(zip(x.to_pylist(), y.to_pylist())):
        v = np.frombuffer(a + b, np.uint64)
        v = np.sort(v)
        out[i] = np.count_nonzero(v[1:] == v[:-1])
    return out


def links(pairs: DataFrame, arrays: DataFrame, shelf: Shelf) -> DataFrame:
    """Those of ``pairs`` (a, b), a stored table, whose sets link; a quarter of the domain rules out most others.

    A few small ones are verified at once: passes over next to nothing cost more than the work.
    """
    if pairs.count() <= FEW_PAIRS:
        each = [arrays.join(F.broadcast(pairs.select("a", "b")), F.col("sid") == F.col(x)) for x in "ab"]
        if (each[0].select("n").unionByName(each[1].select("n")).agg(F.sum("n")).first()[0] or 0) <= FEW_SHINGLES:
            return shelf.put(_few_links(*each))

    def both(rows: DataFrame, part: str) -> DataFrame:
        for x in "ab":
            rows = rows.join(arrays.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col(part).alias(f"s_{x}")), x)
        return rows

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("s_a"), batch.column("s_b")
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            low = in_common(a, b)
            left = np.minimum(n_a - np.array([len(v) // 8 for v in a.to_pylist()], np.int64), n_b - np.array([len(v) // 8 for v in b.to_pylist()], np.int64))
            ok = (low + left) * (100 + PERCENT) >= PERCENT * (n_a + n_b)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok)), pa.array(low[ok])], ["a", "b", "shared"])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = batch.column("shared").to_numpy() + in_common(batch.column("s_a"), batch.column("s_b"))
            ok = pa.array(shared * (100 + PERCENT) >= PERCENT * (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], ["a", "b"])

    likely = shelf.put(both(pairs.select("a", "b"), "low").select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(tidied(first), "a long, b long, shared long"))
    return shelf.put(both(likely, "high").select("a", "b", "shared", "n_a", "n_b", "s_a", "s_b").mapInArrow(tidied(second), "a long, b long"))


def _few_links(of_a: DataFrame, of_b: DataFrame) -> DataFrame:
    """Those (a, b) whose sets, on either side, link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = pa.array(in_common(batch.column("s_a"), batch.column("s_b")) * (100 + PERCENT) >= PERCENT * (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], ["a", "b"])

    sides = [side.select("a", "b", F.col("n").alias(f"n_{x}"), F.concat("low", "high").alias(f"s_{x}")) for x, side in (("a", of_a), ("b", of_b))]
    return sides[0].join(sides[1], ["a", "b"]).mapInArrow(tidied(run), "a long, b long")


# ---- the join -----------------------------------------------------------------------------------------


def _least_shared(n: Column, m: Column) -> Column:
    """``least_shared`` of columns."""
    k = F.least(n, m)
    groups = 2 * (F.floor(k / 6) + 1 + F.floor(k / SLACK))
    singles = F.floor(k / 3) + 1 + F.floor(k / (SLACK // 2))
    return F.least(groups, singles) - F.floor((n + m) * (100 - PERCENT) / (100 + PERCENT))


def _fewest(n: Column) -> Column:
    """The least of ``least_shared`` over all sizes that may link with ``n``: it falls towards either end of them."""
    ends = [F.ceil(n * PERCENT / 100), F.floor(n * 100 / PERCENT)]
    # floors move the value by less than 5 between the ends
    return F.greatest(F.lit(1), F.least(*[_least_shared(n, m) for m in ends]) - 5)


@dataclass(frozen=True)
class Candidates:
    """Tables on ``shelf`` that the join goes on from."""

    sets: DataFrame  # (key, n, sid) of each row
    classes: DataFrame  # (sid, rep, n) of each set that is not empty; rep is the least key
    pairs: DataFrame  # (a, b, shared) of sets that share enough signatures of small buckets, or may do so in all
    members: DataFrame  # (sid, sig) of large buckets
    open_: DataFrame  # (sid, n) of sets with enough members there
    arrays: DataFrame  # (sid, n, low, high): the shingles of all these sets
    shelf: Shelf


def candidates(docs: DataFrame, key: str, text: str, bucket: int) -> Candidates:
    """What may link, by signatures alone."""
    spark = docs.sparkSession
    shelf, parts = Shelf(spark), shuffle_partitions(spark)
    sets = shelf.put(set_table(docs, key, text))
    classes = shelf.put(sets.where("sid IS NOT NULL").groupBy("sid").agg(F.min("key").alias("rep"), F.first("n").alias("n")))
    found = shelf.put(bucket_rows(signature_blocks(docs, text, bucket, parts), bucket, parts))
    sizes = classes.select("sid", "n")
    members = found.where("kind = 1").select(F.col("a").alias("sid"), F.col("b").alias("sig"))
    large = members.groupBy("sid").agg(F.count("*").alias("large")).join(sizes, "sid")
    open_ = shelf.put(large.where(F.col("large") >= _fewest(F.col("n"))).select("sid", "n"))
    known = sizes.join(large.select("sid", "large"), "sid", "left").fillna(0, ["large"])
    rows = found.where("kind = 0").groupBy("a", "b").agg(F.sum("n").alias("shared"))
    for x in "ab":
        rows = rows.join(known.select(*[F.col(c).alias(x if c == "sid" else f"{c}_{x}") for c in known.columns]), x)
    fits = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    pairs = shelf.put(rows.where(fits & (F.col("shared") + F.least("large_a", "large_b") >= _least_shared(F.col("n_a"), F.col("n_b")))).select("a", "b", "shared"))
    wanted = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).unionByName(open_.select("sid")).distinct()
    arrays = shelf.put_by(set_arrays(docs, text, shelf.put(wanted)), "sid")  # wide rows, shuffled once for all joins
    return Candidates(sets, classes, pairs, members, open_, arrays, shelf)


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``key``, n_shingles, component_id of each row of ``docs``."""
    c = candidates(docs, key, text, bucket)
    # the best pair of each class first, then what still joins two components
    best = c.pairs.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b")
    best = c.shelf.put(best)
    labels = c.shelf.put(components(links(best, c.arrays, c.shelf)))
    labels = more_links(c.pairs.join(best, ["a", "b"], "left_anti"), labels, c.arrays, c.shelf)
    labels = settle(c.members, c.open_, labels, c.arrays, c.shelf)

    named = c.classes.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_set = c.shelf.put(named.join(least, "label").select("sid", "component_id"))
    c.shelf.clear(c.sets, of_set)
    return c.sets.join(of_set, "sid", "left").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id"))


def jaccard_links(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(all links between different sets, members): (a, b) with a < b, and (``key``, n_shingles, sid, n_links) of each row.

    a, b and sid name classes of equal sets; n_links is how many other classes a row's class links with, null for
    empty sets. Unlike ``jaccard_join`` this forms the links inside components too, whose number may grow with
    the square of a group of near copies: it is for those who need the links themselves.
    """
    c = candidates(docs, key, text, bucket)
    parts = shuffle_partitions(docs.sparkSession)
    found = links(c.pairs, c.arrays, c.shelf)
    # each set is a component of its own here: what two sets share, different components share
    each = c.open_.select("sid", F.col("sid").alias("label"), "n")
    shared = c.shelf.put(shared_shingles(each.select("sid", "label"), c.arrays, parts))
    least = F.ceil(F.col("n") * PERCENT / 100)
    able = c.shelf.put(each.join(shared, "sid").withColumn("least", least).where((100 + PERCENT) * F.col("shared") >= PERCENT * (F.col("n") + F.col("least"))))
    more = links(c.shelf.put(rare_pairs(able, c.arrays, c.shelf, parts)), c.arrays, c.shelf)
    every = c.shelf.put(found.unionByName(more).distinct())
    degree = c.shelf.put(every.select(F.explode(F.array("a", "b")).alias("sid")).groupBy("sid").agg(F.count("*").alias("n_links")))
    c.shelf.clear(c.sets, every, degree)
    zero = F.when(F.col("sid").isNotNull(), F.lit(0).cast("long"))
    members = c.sets.join(degree, "sid", "left").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "sid", F.coalesce("n_links", zero).alias("n_links"))
    return every, members


def more_links(pairs: DataFrame, labels: DataFrame, arrays: DataFrame, shelf: Shelf) -> DataFrame:
    """``labels`` after those ``pairs`` (a, b) that link and join two components."""
    apart, n = pairs.select("a", "b"), labels.count()
    for x in "ab":
        of = labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}"))
        apart = apart.join(F.broadcast(of) if n <= SMALL_GRAPH else of, x, "left")
    apart = shelf.put(apart.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b"))
    if apart.isEmpty():
        return labels
    found = links(apart, arrays, shelf)
    if n + found.count() <= SMALL_GRAPH:  # one task folds all of it
        return shelf.put(components(found.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))))
    return shelf.put(merged(labels, found))


def dealt_shingles(sets: DataFrame, arrays: DataFrame, parts: int) -> DataFrame:
    """(block, labels): the shingles of ``sets`` (sid, label) as packed blocks in the part that owns them.

    They are told apart by 48 bits and their part, which may make two look equal, but never makes equal ones differ.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        label: dict[int, int] = {}  # of the sets that are held
        size = 0

        def emit() -> pa.RecordBatch:
            s, of = (np.concatenate([x[k] for x in held]) for k in range(2))
            held.clear()
            order, cuts = by_part(s, parts)
            s, of = s[order], of[order]
            rows = []
            for p, a, b in cuts:
                rows.append((p, packed(s[a:b], of[a:b]), np.array([label[k] for k in np.unique(of[a:b]).tolist()], np.int64).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["part", "block", "labels"])

        for batch in batches:
            for sid, lab, low, high in zip(*(batch.column(c).to_pylist() for c in ("sid", "label", "low", "high"))):
                s = np.frombuffer(low + high, np.uint64)
                held.append((s, np.full(len(s), sid)))
                label[sid] = lab
                size += len(s)
                if size >= FLUSH:
                    yield emit()
                    size = 0
                    label.clear()
        if held:
            yield emit()

    each = arrays.join(sets, "sid").select("sid", "label", "low", "high")
    return each.mapInArrow(tidied(deal), "part int, block binary, labels binary").repartitionById(parts, "part")


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(shingle, set, begin of the run of each shingle, whether a run has several labels) of a part; None if it is empty."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    part = 0
    for batch in batches:
        for part, block, labels in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "labels"))):
            s, sid = unpacked(block)
            held.append((mix(s + np.uint64(part * int(GOLD) % 2**64)), sid, np.frombuffer(labels, np.int64)[np.searchsorted(np.unique(sid), sid)]))
    if not held:
        return None
    s, sid, label = (np.concatenate([x[k] for x in held]) for k in range(3))
    held.clear()
    order = np.argsort(s)
    s, sid, label = s[order], sid[order], label[order]
    begin = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s, sid, begin, np.minimum.reduceat(label, begin) != np.maximum.reduceat(label, begin)


def shared_shingles(sets: DataFrame, arrays: DataFrame, parts: int) -> DataFrame:
    """(sid, shared): how many shingles of each of ``sets`` (sid, label) one of them with another label has too, at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (found := _gathered(batches)) is None:
            return
        s, sid, begin, across = found
        names, n = np.unique(sid[np.repeat(across, np.diff(np.append(begin, len(s))))], return_counts=True)
        order, cuts = by_part(mix(names.view(np.uint64)), parts)
        names, n = names[order], n[order]
        if cuts:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in cuts], pa.int32()), pa.array([names[a:b].tobytes() for _, a, b in cuts], pa.binary()), pa.array([n[a:b].astype(np.int64).tobytes() for _, a, b in cuts], pa.binary())], ["part", "sids", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)) for batch in batches for a, b in zip(batch.column("sids").to_pylist(), batch.column("counts").to_pylist())]
        if held:
            sid, n = (np.concatenate([x[k] for x in held]) for k in range(2))
            names, at = np.unique(sid, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.bincount(at, n).astype(np.int64))], ["sid", "shared"])

    # counts of a part travel as blocks too: a row for each set and part would be many more than sets
    counts = dealt_shingles(sets, arrays, parts).mapInArrow(tidied(count), "part int, sids binary, counts binary")
    return counts.repartitionById(parts, "part").mapInArrow(tidied(total), "sid long, shared long")


def rarest_shingles(sets: DataFrame, arrays: DataFrame, parts: int) -> DataFrame:
    """(sid, s, place, across): the shingles of each of ``sets`` (sid, label) from the rarest among them on, place from 1."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (found := _gathered(batches)) is not None:
            s, sid, begin, across = found
            count = np.diff(np.append(begin, len(s)))
            for k in range(0, len(s), 100_000):
                at = slice(k, k + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(sid[at]), pa.array(s.view(np.int64)[at]), pa.array(np.repeat(count, count)[at]), pa.array(np.repeat(across, count)[at])], ["sid", "s", "n", "across"])

    rows = dealt_shingles(sets, arrays, parts).mapInArrow(tidied(each), "sid long, s long, n long, across boolean")
    return rows.select("sid", "s", "across", F.row_number().over(Window.partitionBy("sid").orderBy("n", "s")).alias("place"))


def settle(members: DataFrame, open_: DataFrame, labels: DataFrame, arrays: DataFrame, shelf: Shelf) -> DataFrame:
    """``labels`` after the links between ``members`` (sid, sig) of large buckets that small buckets did not show.

    Such a link joins two components, and its sets share ``least_shared`` signatures of large buckets; sets of
    ``open_`` (sid, n) have that many. What the two have in common lies in shingles that open sets of other
    components have.
    """
    parts = shuffle_partitions(shelf.spark)

    def possible(shared: Column, n: Column, m: Column) -> Column:
        """Whether sets of ``n`` and ``m`` that have at most ``shared`` in common may link."""
        return (100 + PERCENT) * shared >= PERCENT * (n + m)

    def narrowed(rows: DataFrame) -> DataFrame:
        """Rows of buckets with two components and a partner of fitting size, of sets that still have enough of them."""
        here = rows.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
        each = here.groupBy("sig").agg(F.min("label").alias("first"), F.max("label").alias("last"), F.min("n").alias("least"))
        partner = F.greatest("least", F.ceil(F.col("n") * PERCENT / 100))
        here = here.join(each.where("first <> last").select("sig", "least"), "sig").where(possible(F.col("shared"), F.col("n"), partner))
        enough = here.groupBy("sid").agg(F.count("*").alias("c"), F.first("n").alias("n")).where(F.col("c") >= _fewest(F.col("n"))).select("sid", "c")
        return shelf.put(here.join(enough, "sid"))

    rows = members.join(open_, "sid").withColumn("shared", F.col("n"))
    for turn in range(STARS + 1):
        rows = narrowed(rows)
        if rows.isEmpty():
            return labels
        shared = shelf.put(shared_shingles(rows.select("sid", "label").distinct(), arrays, parts))
        rows = narrowed(rows.select("sid", "sig", "n").join(shared, "sid"))
        if rows.isEmpty():
            return labels
        if turn == STARS or shared.count() <= FEW_SETS:
            break
        # stars only save work, so some buckets suffice
        some = rows.where(F.pmod(F.xxhash64(F.lit(turn), "sig"), F.lit(STAR_SHARE)) == 0)
        hub = some.groupBy("sig").agg(F.min(F.struct((F.col("n") - F.col("shared")).alias("own"), F.xxhash64("sid"), "sid", "n", "label", "shared")).alias("hub"))
        near = some.join(hub, "sig").where(F.col("label") != F.col("hub.label")).where(possible(F.least("shared", "hub.shared"), F.col("n"), F.col("hub.n")))
        labels = more_links(near.select(F.least("sid", "hub.sid").alias("a"), F.greatest("sid", "hub.sid").alias("b")).distinct(), labels, arrays, shelf)
        rows = rows.select("sid", "sig", "n", "shared")
    sets = rows.groupBy("sid", "label", "n", "shared").agg(F.min("least").alias("least"))
    sets = shelf.put(sets.withColumn("least", F.greatest("least", F.ceil(F.col("n") * PERCENT / 100))))
    return more_links(rare_pairs(sets, arrays, shelf, parts), labels, arrays, shelf)


def rare_pairs(sets: DataFrame, arrays: DataFrame, shelf: Shelf, parts: int) -> DataFrame:
    """(a, b) of ``sets`` (sid, label, n, shared, least) with different labels that meet in their rarest shingles.

    ``shared`` bounds what a set has in common with others, ``least`` is the least size of a partner. Of a pair,
    x has the larger set and must share 3/7 of the sizes with the least partner, y 6/7 of its own shingles.
    """
    must = lambda n, m: F.ceil((n + m) * PERCENT / (100 + PERCENT))
    first = rarest_shingles(sets.select("sid", "label"), arrays, parts).where("across").join(sets, "sid")
    first = shelf.put(first.where(F.col("place") <= F.col("n") - must(F.col("n"), F.col("least")) + 1).select("sid", "s", "place", "label", "n", "shared"))
    x, y = (first.select("s", *[F.col(c).alias(f"{c}_{z}") for c in ("sid", "n", "shared", "label", "place")]) for z in "xy")
    y = y.where(F.col("place_y") <= F.col("n_y") - must(F.col("n_y"), F.col("n_y")) + 1)
    need = must(F.col("n_x"), F.col("n_y"))
    larger = (F.col("n_x") > F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("sid_x") > F.col("sid_y")))
    can = (F.least("shared_x", "shared_y") >= need) & (F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y")) + 1 >= need)
    meet = x.join(y, "s").where((F.col("label_x") != F.col("label_y")) & larger & (100 * F.col("n_y") >= PERCENT * F.col("n_x")) & can)
    return meet.select(F.least("sid_x", "sid_y").alias("a"), F.greatest("sid_x", "sid_y").alias("b")).distinct()


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


_SETS = r"""
RECURSIVE w AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 75 * (p.n + q.n - i)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
"""
QUERIES = {"op5_jaccard_join": op5_jaccard_join}
ORACLE_SQL = {
    "op5_jaccard_join": f"WITH {_SETS} SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id"
}
