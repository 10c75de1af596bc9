"""Clustering of whole-number vectors around centroids, with Elkan's bounds between the rounds.

Components become floor(scale * x), so that distances, sums and ties are exact. Each vector keeps, in a table
in the shared folder, its centroid, an upper bound of its distance to it and a lower bound of its distance to
each centroid. A round moves the bounds by what the centroids moved, leaves a vector alone whose upper bound is
below half the distance to the nearest other centroid, and measures the others only against centroids that no
bound excludes. Bounds are kept as single floats, rounded away from the truth: upper ones up, lower ones and
distances between centroids down. Only strictly worse centroids are excluded, so those at equal distances are
measured, in whole numbers, and the smaller number wins. Sums change by the vectors that changed their
centroid, which alone are read for it. What reaches the driver is sums of centroids: k rows of ``dims`` numbers.

Defined results: rows whose vector is null, has another number of components, or null, non-finite or outsized
components (their squared distances must fit a long, so scale * x stays within +-2^27) are left out; repeated
rows are vectors of their own; rows without an id are assigned like others but never a first centroid; vectors
that tie for a first centroid, having the same id, go in the order of their components; with fewer candidates
than centroids there are as many centroids as candidates, and none at all gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import Shelf, table, tidied

DIMS, SCALE, K, ROUNDS, SEED = 64, 64, 16, 3, 1
LIMIT = 1 << 27
#: Rows that a worker holds at once.
ROWS = 4096
_UP, _DOWN = np.float32(np.inf), np.float32(-np.inf)
#: What a distance is widened by before it is rounded: squares of up to 2^63 have passed a double.
_WIDE = 2.0**-50


def whole(vector: Column, dims: int, scale: int) -> Column:
    """floor(scale * x) of each component; null where the vector is left out."""
    good = (F.size(vector) == dims) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) <= LIMIT))
    return F.when(good, F.transform(vector, lambda x: F.floor(x * scale).cast("int")))


def above(square: np.ndarray) -> np.ndarray:
    """Roots of whole numbers as single floats, never below the truth."""
    return np.nextafter((np.sqrt(square.astype(np.float64)) * (1 + _WIDE)).astype(np.float32), _UP)


def below(square: np.ndarray) -> np.ndarray:
    """Roots of whole numbers as single floats, never above the truth, never negative."""
    return np.maximum(np.nextafter((np.sqrt(square.astype(np.float64)) * (1 - _WIDE)).astype(np.float32), _DOWN), np.float32(0))


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to the rows of ``c`` (or to its only one)."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def assign(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray, half: np.ndarray) -> int:
    """Elkan's step on one block, in place; returns how many distances were measured. Bounds hold before and after."""
    k = len(centroids)
    apart = half + np.where(np.eye(k, dtype=bool), _UP, np.float32(0))
    rows = np.flatnonzero(upper >= apart.min(axis=1)[cluster])
    if not len(rows):
        return 0
    best = squares(x[rows], centroids[cluster[rows]])
    upper[rows] = above(best)
    lower[rows, cluster[rows]] = below(best)
    measured = len(rows)
    for c in range(k):
        own, u = cluster[rows], upper[rows]
        look = np.flatnonzero((own != c) & (lower[rows, c] <= u) & (half[own, c] <= u))
        if not len(look):
            continue
        at = rows[look]
        d = squares(x[at], centroids[c])
        measured += len(at)
        lower[at, c] = below(d)
        wins = (d < best[look]) | ((d == best[look]) & (c < cluster[at]))
        won = look[wins]
        best[won] = d[wins]
        cluster[rows[won]] = c
        upper[rows[won]] = above(d[wins])
    return measured


def halves(centroids: np.ndarray) -> np.ndarray:
    """Half the distances between centroids, never above the truth."""
    d = centroids[:, None, :] - centroids[None, :, :]
    return below(np.einsum("ijk,ijk->ij", d, d)) * np.float32(0.5)  # a product with a half is exact


def _ints(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dims).astype(np.int64)


def _round(centroids: np.ndarray, before: np.ndarray | None):
    """mapInArrow: one assignment; ``before`` are the centroids that the bounds speak of, None before the first."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = halves(centroids)
        moved = None if before is None else squares(centroids, before)
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, ROWS):
                batch = whole_batch.slice(at, ROWS)
                x = _ints(batch.column("x"), dims)
                if before is None:
                    was = np.full(len(x), -1, np.int32)
                    cluster, lower = np.zeros(len(x), np.int32), np.zeros((len(x), k), np.float32)
                    upper = np.full(len(x), _UP)
                else:
                    was = batch.column("cluster").to_numpy()
                    cluster = was.copy()
                    lower = batch.column("lower").flatten().to_numpy().reshape(len(x), k)
                    lower = np.maximum(np.nextafter(lower - above(moved), _DOWN), np.float32(0))
                    upper = np.nextafter(batch.column("upper").to_numpy() + above(moved)[cluster], _UP)
                    # what did not move has no bounds to widen
                    still = moved == 0
                    lower[:, still] = batch.column("lower").flatten().to_numpy().reshape(len(x), k)[:, still]
                    upper = np.where(still[cluster], batch.column("upper").to_numpy(), upper)
                measured = assign(x, cluster, upper, lower, centroids, half)
                ends = pa.array(np.arange(0, lower.size + 1, k, dtype=np.int32))
                counts = np.zeros(len(x), np.int64)
                counts[0] = measured
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), pa.array(was), pa.array(cluster), pa.array(upper), pa.ListArray.from_arrays(ends, pa.array(lower.ravel())), pa.array(counts)], ["id", "x", "was", "cluster", "upper", "lower", "measured"])

    return run


def _changes(k: int, dims: int):
    """mapInArrow: (cluster, count, sums) by which the rows of a task change their old and new centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            x = _ints(batch.column("x"), dims)
            for column, sign in (("was", -1), ("cluster", 1)):
                c = batch.column(column).to_numpy()
                some = c >= 0
                np.add.at(sums, c[some], sign * x[some])
                count += sign * np.bincount(c[some], minlength=k)
        at = np.flatnonzero(count.astype(bool) | sums.any(axis=1))
        ends = pa.array(np.arange(0, len(at) * dims + 1, dims, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(count[at]), pa.ListArray.from_arrays(ends, pa.array(sums[at].ravel()))], ["cluster", "count", "sums"])

    return run


def _exact(centroids: np.ndarray):
    """mapInArrow: (id, cluster, distance), the squared distance to the assigned centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch.column("cluster").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("cluster"), pa.array(squares(_ints(batch.column("x"), centroids.shape[1]), centroids[c]))], ["id", "cluster", "distance"])

    return run


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


class Clusters:
    """``rows`` (key, cluster int, distance long), ``centroids`` (k x dims) and ``measured``, the distances of each assignment."""

    def __init__(self, rows: DataFrame | None, centroids: np.ndarray, measured: list[int]):
        self.rows, self.centroids, self.measured = rows, centroids, measured


def fit(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> Clusters:
    """Clusters after ``rounds`` rounds of assignment and update, and one more assignment."""
    spark = rows.sparkSession
    shelf = Shelf(spark)
    kind = rows.schema[key].dataType.simpleString()
    x = whole(F.col(vector).cast("array<double>"), dims, scale)
    now = shelf.put(rows.select(F.col(key).alias("id"), x.alias("x")).where("x IS NOT NULL"))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = now.where("id IS NOT NULL").select(drawn.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    centroids = np.array([r["x"] for r in first], np.int64).reshape(len(first), dims)
    if not len(first):  # nothing to be near to
        return Clusters(None, centroids, [])
    before, measured = None, []
    sums, count = np.zeros((len(first), dims), object), np.zeros(len(first), object)
    for turn in range(rounds + 1):
        state = f"id {kind}, x array<int>, was int, cluster int, upper float, lower array<float>, measured long"
        now = shelf.put(now.mapInArrow(tidied(_round(centroids, before)), state))
        shelf.clear(now)
        measured.append(now.agg(F.sum("measured")).first()[0])
        if turn < rounds:
            changes = now.where("was <> cluster").select("x", "was", "cluster").mapInArrow(_changes(len(first), dims), "cluster int, count long, sums array<long>")
            total = changes.groupBy("cluster").agg(F.sum("count").alias("count"), F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(dims)]).alias("sums"))
            for r in total.collect():  # at most k rows
                count[r["cluster"]] += r["count"]
                sums[r["cluster"]] += np.array([int(v) for v in r["sums"]], object)
            before, centroids = centroids, centroids.copy()
            for c in range(len(first)):
                if count[c]:
                    centroids[c] = [v // count[c] for v in sums[c]]
    out = now.select("id", "x", "cluster").mapInArrow(tidied(_exact(centroids)), f"id {kind}, cluster int, distance long")
    return Clusters(out.withColumnRenamed("id", key), centroids, measured)


def cluster(rows: DataFrame, key: str = "vec_id", **how) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that is not left out; ``how`` as in ``fit``."""
    found = fit(rows, key, **how)
    kind = rows.schema[key].dataType.simpleString()
    if found.rows is None:
        return rows.sparkSession.createDataFrame([], f"`{key}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    out = Shelf(rows.sparkSession).put(found.rows)
    inertia = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # at most k rows
    numbers = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(found.centroids))])
    names = F.array(*[F.lit(digest(c)) for c in found.centroids])
    return out.select(key, "cluster", "distance", F.get(numbers, F.col("cluster")).alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), F.get(names, F.col("cluster")).alias("centroid_sha256"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``embeddings``."""
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """DuckDB SQL that measures every vector against every centroid."""
    floor = "CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END"
    parts = [f"""WITH x AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs({SCALE} * CAST(x AS DOUBLE)) > {LIMIT})) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INT) AS c, x AS m FROM (SELECT sha256('{SEED}:' || vec_id) AS h, x FROM x ORDER BY h LIMIT {K}))"""]
    for k in range(ROUNDS + 1):
        parts.append(f"""a{k} AS MATERIALIZED (SELECT vec_id, x, c AS cluster, d FROM (SELECT vec_id, x, c, list_sum(list_transform(list_zip(x, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM x CROSS JOIN c{k})
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if k < ROUNDS:
            parts.append(f"""c{k + 1} AS MATERIALIZED (SELECT c{k}.c, coalesce(u.m, c{k}.m) AS m FROM c{k} LEFT JOIN (SELECT cluster, list(CAST({floor} AS BIGINT) ORDER BY i) AS m FROM
  (SELECT cluster, i, sum(v) AS s, count(*) AS n FROM (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY cluster, i) GROUP BY cluster) u ON u.cluster = c{k}.c)""")
    return ", ".join(parts) + f""" SELECT vec_id, cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(list_aggregate(m, 'string_agg', ',')) AS centroid_sha256 FROM a{ROUNDS} JOIN c{ROUNDS} ON c = cluster"""


QUERIES = {"op13_centroids": op13_centroids}
ORACLE_SQL = {"op13_centroids": _sql()}
