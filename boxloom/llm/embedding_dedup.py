"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosines, components.

Vectors that are equal in every component collapse to one class first, so copies cost a row each and no
pairs. A table of the index gives a class a code: the signs of its products with the table's hyperplanes.
Hyperplanes and scaled vectors are whole numbers, so a product is exact and equal wherever it is computed.
The number of bits follows the number of vectors (a bucket holds few by chance), and the number of tables
follows from the bits: a pair at the threshold meets in some table with a probability of at least 1 - MISS.

Classes whose bucket holds another one travel there. A bucket of more than ``block`` classes is dealt into
blocks, and each pair of blocks is a task's work of its own: products of matrices, a piece at a time. A pair
counts in the first table in which it meets only. Pairs are never rows: a cell sends on the number of linked
rows of each class and a star for each of its components; the stars' components are the result's. A hot group
of vectors that are near but not equal costs the products of its pairs, as exact link counts ask for.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing
and are their own component; vectors of different lengths never link; repeated rows are linked copies; rows
without an id take part, and a component without any id is null; a row is kept if its id is its component's,
so repeated ids are kept or go together; other columns are ignored, whatever their names; an empty table
gives no rows. At exactly the threshold vectors link; there are no ties to break.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import Shelf, shuffle_partitions, table, tidied
from boxloom.llm.components import components

THRESHOLD = 0.95
#: Probability that no table brings two vectors at the threshold together, at most.
MISS = 0.002
#: Bits of a code beyond the logarithm of the number of vectors.
SPARE_BITS = 4
#: Classes that one side of a cell holds (in the mean).
BLOCK = 4096
#: Rows of a cell up to which cells are worked on together.
SMALL = 16
#: Cosines that are held at once.
PIECE = 1 << 20
#: Scaled components and hyperplanes are whole numbers of this size at most: 65,536 products of them add up exactly.
SCALE, NORMAL = 1 << 20, 1 << 9


def tables_for(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits, tables) of an index of ``n`` vectors."""
    bits = min(48, max(8, math.ceil(math.log2(max(n, 2))) + SPARE_BITS))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-meet)))


@lru_cache(maxsize=4)
def hyperplanes(dims: int, bits: int, tables: int) -> np.ndarray:
    """dims x (bits * tables) normals, rounded to whole numbers; the same on every worker."""
    drawn = np.random.Generator(np.random.PCG64(dims)).standard_normal((bits * tables, dims))
    return np.clip(np.rint(drawn * (NORMAL / 8)), -NORMAL, NORMAL).T.copy()


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that their largest component is below 1 and at least a half: no square overflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def codes(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The code of each row of ``x`` in each table, with the table's number above the bits."""
    signs = np.rint(scaled(x) * SCALE) @ hyperplanes(x.shape[1], bits, tables) >= 0
    weights = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))
    found = signs.reshape(len(x), tables, bits) @ weights
    return found + (np.arange(tables, dtype=np.int64) << np.int64(bits))


def _sized(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, rows) of vectors in a binary column, by their length."""
    size = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1])
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        yield at, np.frombuffer(b"".join(column.take(pa.array(at)).to_pylist()), np.float64).reshape(len(at), n // 8)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, key, vec): digest and bytes of each vector; both null where it links with nothing."""
    for batch in batches:
        lists = batch.column("vector")
        keys, vecs = [], []
        for v in lists.to_numpy(zero_copy_only=False):
            # null components become NaN in what numpy gets
            x = np.array([], np.float64) if v is None else np.asarray(v, np.float64) + 0.0
            good = len(x) > 0 and bool(np.isfinite(x).all()) and bool(x.any())
            data = x.tobytes() if good else None
            vecs.append(data)
            keys.append(xxhash.xxh3_128_digest(data) if good else None)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], ["id", "key", "vec"])


def _coded(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1024):
                batch = whole.slice(k, 1024)
                out = np.empty((batch.num_rows, tables), np.int64)
                for at, x in _sized(batch.column("vec")):
                    out[at] = codes(x, bits, tables)
                ends = pa.array(np.arange(0, out.size + 1, tables, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.ListArray.from_arrays(ends, pa.array(out.ravel()))], ["cid", "codes"])

    return run


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of whole cells (b, i, j), which arrive sorted by these, and where each cell begins."""
    open_: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(c).to_numpy() for c in ("b", "i", "j")])
        last = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
        begins = [*([0] if name is not None and (at[:, 0] != name).any() else []), *last.tolist()]
        name = at[:, -1]
        if begins:
            yield _begun([*open_, batch.slice(0, begins[-1])])
            open_ = []
        open_.append(batch.slice(begins[-1] if begins else 0))
    if open_:
        yield _begun(open_)


def _begun(batches: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
    whole = pa.Table.from_batches([x for x in batches if x.num_rows]).combine_chunks()
    at = np.stack([whole.column(c).to_numpy() for c in ("b", "i", "j")])
    return whole, np.concatenate([[0], np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1])


def _labels(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Lowers ``label`` until the ends of all pairs agree."""
    while len(p):
        a, b = label[p], label[q]
        differ = a != b
        if not differ.any():
            return
        p, q, a, b = p[differ], q[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def _linked(threshold: float, bits: int, tables: int):
    def sized(t: int, left: np.ndarray, right: np.ndarray | None, cid: np.ndarray, count: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(linked rows, label) of the rows of ``x`` in a cell; ``right`` is None where all pairs of ``left`` count."""
        links, label = np.zeros(len(x), np.int64), np.arange(len(x))
        seen: dict[int, np.ndarray] = {}
        x = scaled(x)
        norm = np.sqrt((x * x).sum(axis=1))
        other = left if right is None else right
        step = max(1, PIECE // max(1, len(other)))
        for k in range(0, len(left), step):
            some = left[k : k + step]
            hit = x[some] @ x[other].T / np.outer(norm[some], norm[other]) >= threshold
            p, q = np.nonzero(hit)
            if right is None:
                keep = p + k < q
                p, q = p[keep], q[keep]
            p, q = some[p], other[q]
            if t and len(p):
                fresh = np.unique(np.concatenate([p, q]))
                fresh = fresh[[v not in seen for v in fresh.tolist()]]
                for piece in range(0, len(fresh), 1024):
                    at = fresh[piece : piece + 1024]
                    seen.update(zip(at.tolist(), codes(x[at], bits, tables)[:, :t]))
                own = np.full(len(x), -1)
                own[list(seen)] = np.arange(len(seen))
                every = np.array(list(seen.values()))
                for u in range(t):  # pairs that met in an earlier table have counted there
                    apart = every[own[p], u] != every[own[q], u]
                    p, q = p[apart], q[apart]
            links += np.bincount(p, count[q], len(x)).astype(np.int64) + np.bincount(q, count[p], len(x)).astype(np.int64)
            _labels(label, p, q)
        return links, label

    def small(cell: np.ndarray, t: np.ndarray, count: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(linked rows, label) of the rows ``x`` of many small cells, in the order of ``cell``."""
        links, label = np.zeros(len(x), np.int64), np.arange(len(x))
        x = scaled(x)
        norm = np.sqrt((x * x).sum(axis=1))
        ps, qs = [], []
        for k in range(1, SMALL):
            p = np.flatnonzero(cell[k:] == cell[:-k])
            if not len(p):
                break
            near = np.einsum("ij,ij->i", x[p], x[p + k]) / (norm[p] * norm[p + k]) >= threshold
            ps.append(p[near])
            qs.append(p[near] + k)
        p, q = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (ps, qs))
        for k in range(0, len(p), 1024):
            a, b = p[k : k + 1024], q[k : k + 1024]
            met = codes(x[a], bits, tables) == codes(x[b], bits, tables)
            fresh = ~(met & (np.arange(tables) < t[a][:, None])).any(axis=1)
            a, b = a[fresh], b[fresh]
            links += np.bincount(a, count[b], len(x)).astype(np.int64) + np.bincount(b, count[a], len(x)).astype(np.int64)
            _labels(label, a, b)
        return links, label

    def told(cid: np.ndarray, links: np.ndarray, label: np.ndarray) -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(links)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(cid[some]), pa.array(cid[label[some]]), pa.array(links[some])], ["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, begins in _whole_cells(batches):
            cid, count, side, b, i, j = (whole.column(c).to_numpy() for c in ("cid", "count", "side", "b", "i", "j"))
            column = whole.column("vec").chunk(0)
            ends = np.append(begins[1:], len(cid))
            of = np.repeat(np.arange(len(begins)), ends - begins)
            few = (ends - begins <= SMALL) & (i == j)[begins]
            at_once = np.flatnonzero(few[of])
            for at, x in _sized(column.take(pa.array(at_once))) if len(at_once) else ():
                at_ = at_once[at]
                yield from told(cid[at_], *small(of[at_], b[at_] >> bits, count[at_], x))
            for k in np.flatnonzero(~few).tolist():
                rows = slice(begins[k], ends[k])
                for at, x in _sized(column.slice(begins[k], ends[k] - begins[k])):
                    here = side[rows][at]
                    left, right = (np.arange(len(at)), None) if i[begins[k]] == j[begins[k]] else (np.flatnonzero(here == 0), np.flatnonzero(here == 1))
                    if len(at) < 2 or right is not None and not (len(left) and len(right)):
                        continue
                    yield from told(cid[rows][at], *sized(int(b[begins[k]]) >> bits, left, right, cid[rows][at], count[rows][at], x))

    return run


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, miss: float = MISS, block: int = BLOCK, tables: int | None = None) -> DataFrame:
    """(key, n_links, component_id, kept) for each row: see above. ``tables`` replaces the number that ``miss`` gives."""
    if not 0 < threshold < 1:
        raise ValueError("the threshold lies between 0 and 1")
    spark = rows.sparkSession
    shelf, parts = Shelf(spark), shuffle_partitions(spark)
    kind = rows.schema[key].dataType.simpleString()
    given = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    read = shelf.put(given.mapInArrow(tidied(_read), f"id {kind}, key binary, vec binary"))
    good = read.where("key IS NOT NULL")
    bits, least = tables_for(good.count(), threshold, miss)
    tables = tables or least
    classes = shelf.put(good.groupBy("key").agg(F.min("vec").alias("vec"), F.count("*").alias("count"), F.min("id").alias("least")).withColumn("cid", F.monotonically_increasing_id()))

    coded = classes.select("cid", "vec").mapInArrow(tidied(_coded(bits, tables)), "cid long, codes array<long>")
    met = coded.select("cid", F.explode("codes").alias("b"))
    # buckets of one class are most: only the others are looked at again
    shared = met.groupBy("b").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    placed = met.join(shared, "b").select("b", "cid", blocks.alias("k"), F.pmod(F.xxhash64("b", "cid"), blocks).cast("int").alias("own"))
    # a class of block o meets block x in the cell (least of o and x, greatest); with its own block in (o, o)
    others = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    cells = placed.select("b", "cid", "own", others.alias("x")).select("b", F.least("own", "x").alias("i"), F.greatest("own", "x").alias("j"), (F.col("own") > F.col("x")).cast("int").alias("side"), "cid")
    full = cells.join(classes.select("cid", "count", "vec"), "cid")
    dealt = full.repartition(parts, "b", "i", "j").sortWithinPartitions("b", "i", "j")
    found = shelf.put(dealt.select("b", "i", "j", "side", "cid", "count", "vec").mapInArrow(tidied(_linked(threshold, bits, tables)), "a long, b long, links long"))

    links = found.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    labels = components(found.select("a", "b")).withColumnRenamed("node", "cid")
    grown = classes.select("cid", "least").join(labels, "cid").groupBy("label").agg(F.min("least").alias("component"))
    near = labels.join(links, "cid").join(grown, "label").select("cid", "links", "component")
    told = classes.select("key", "cid", "count", "least").join(near, "cid", "left")
    told = shelf.put(told.select("key", (F.coalesce("links", F.lit(0)) + F.col("count") - 1).alias("links"), F.when(F.col("links").isNull(), F.col("least")).otherwise(F.col("component")).alias("component")))
    shelf.clear(read, told)
    every = read.select("id", "key").join(told, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component"))
    return every.select(F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``embeddings``."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: All pairs, for small tables: what the index finds of them is measured by the tests.
_SQL = f"""WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, p.b FROM r JOIN p ON p.a = r.b),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a), n AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a)
SELECT c.vec_id, coalesce(n_links, 0) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n ON n.vec_id = c.vec_id"""

QUERIES = {"op11_embedding_dedup": op11_embedding_dedup}
ORACLE_SQL = {"op11_embedding_dedup": _SQL}
