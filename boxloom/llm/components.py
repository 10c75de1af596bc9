"""Connected components by alternating star contraction, for edge tables of any size.

A table that was counted and has at most SMALL_GRAPH edges is folded by one task instead: rounds of shuffles
over next to nothing cost more than the work. The labels are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.common import cut

#: Edges that one task holds at most.
SMALL_GRAPH = 200_000


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the least of u and all partners of u. The join can be split where a u is hot."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("u", "m"))


def folded(edges: DataFrame) -> DataFrame:
    """(node, label) of a small table of edges (u, v) between whole numbers, by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := above.setdefault(top, top)) != top:
                top = up
            while above[x] != top:
                above[x], x = top, above[x]
            return top

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                a, b = root(u), root(v)
                above[max(a, b)] = min(a, b)
        nodes = list(above)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["node", "label"])

    return edges.coalesce(1).mapInArrow(run, "node long, label long")


def components(edges: DataFrame, rounds: int | None = None, small: int = SMALL_GRAPH) -> DataFrame:
    """(node, label) of all nodes of ``edges`` (a, b): label is the least node of the component.

    An empty edge table gives no rows; edges from a node to itself are ignored.
    Raises if ``rounds`` are given and do not suffice; labels are never returned before they are settled.
    Tables of at most ``small`` edges go to one task, unless ``rounds`` are given.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    if rounds is None and now.count() <= small:
        return folded(now)
    before, turn = None, 0
    while True:
        if turn == rounds:
            raise RuntimeError(f"labels are not settled after {rounds} rounds")
        turn += 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _least(large)
        ties = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = cut(ties.where("u <> v").distinct())
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == before:
            break
        before = seen
    return now.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label").unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct().join(now.select(F.col("u").alias("node")), "node", "left_anti"))


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, label) of all components after more ``edges`` (a, b) between nodes, known or new.

    Only the components that the edges join are worked on, not all edges anew.
    """
    ends = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    every = cut(labels.unionByName(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))))
    for x in "ab":
        edges = edges.join(every.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")), x)
    joined = components(edges.select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))).select(F.col("node").alias("label"), F.col("label").alias("to"))
    return every.join(joined, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
