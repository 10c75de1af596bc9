"""Exact and perceptual duplicates against what is kept, without comparing all pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom.functions.geometry import hamming
from boxloom.functions.session import cut
from boxloom.operators.near import all_near, decided, near, probes, wide


def exact_duplicates(rows: DataFrame, key: str, content: str) -> DataFrame:
    """(key, first, kept): the least key with the same content, in two aggregations; hot contents combine before the shuffle.

    Rows without content are copies of nothing: each is its own first.
    """
    hashed = rows.select(F.col(key), F.sha2(F.col(content), 256).alias("sha"))
    first = hashed.where("sha IS NOT NULL").groupBy("sha").agg(F.min(key).alias("first"))
    return hashed.join(first, "sha", "left").select(key, F.coalesce("first", key).alias("first"), (F.col(key) == F.coalesce("first", key)).alias("kept"))


def near_pairs(hashes: DataFrame, key: str, h: str, within: int = 6) -> DataFrame:
    """(a, b, distance) of all pairs a < b at most ``within`` bits apart; nothing is lost.

    64 bits in within + 3 bands: three bands at least are equal in such a pair. Equal hashes collapse first,
    pairs of distinct hashes meet by equi-joins on band triples (84 probes of 21 bits at a distance of 6), and
    keys come back at the end. Beyond a distance of 6 distinct hashes are compared in blocks, each with each, which
    is bounded in memory but grows with the square of their number. Rows of equal hashes are pairs too here: for
    decisions on large tables see ``curated``, which has members instead.
    """
    keyed = hashes.where(F.col(h).isNotNull()).select(F.col(key).alias("key"), F.col(h).alias("hash"))
    if wide(within):
        keyed = cut(keyed)
        unlike = all_near(keyed.select("hash").distinct(), within)
        a, b = keyed.withColumnRenamed("key", "a"), keyed.select(F.col("key").alias("b"), F.col("hash").alias("other"))
        # merged: what Spark expects of the pairs' size is far too little to send them to all
        met = unlike.hint("merge").join(a.hint("merge"), "hash").join(b.hint("merge"), "other").where("a <> b")
        met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), hamming(F.col("hash"), F.col("other")).alias("distance"))
        equal = a.hint("merge").join(b.withColumnRenamed("other", "hash").hint("merge"), "hash").where("a < b")
        return met.unionByName(equal.select("a", "b", F.lit(0).alias("distance")))
    probed = probes(keyed.select("hash").distinct(), within)
    both = near(probed, probed, within)
    a, b = keyed.withColumnRenamed("key", "a"), keyed.select(F.col("key").alias("b"), F.col("hash").alias("other"))
    return a.join(both, "hash").join(b, "other").where("a < b").select("a", "b", hamming(F.col("hash"), F.col("other")).alias("distance"))


#: Pairs that one task holds at most.
FEW_PAIRS = 200_000


def _dropped(pairs: DataFrame) -> DataFrame:
    """(node) of those that an earlier kept partner drops, by one task over few ``pairs`` (a, b) in the order of b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone: set[int] = set()
        for batch in batches:
            out = []
            for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                if b not in gone and a not in gone:  # all that could drop a have been read, as it is before b
                    gone.add(b)
                    out.append(i)
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(out, pa.int64()))], ["node"])

    kind = pairs.schema["b"].dataType.simpleString()
    rows = pairs.coalesce(1).sortWithinPartitions("b", "a")
    return rows.select(F.col("b").alias("node"), F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b")).mapInArrow(run, f"node {kind}")


def keep_greedily(nodes: DataFrame, pairs: DataFrame, key: str, max_rounds: int | None = None, few: int = FEW_PAIRS) -> DataFrame:
    """(key, kept): in key order, a node is kept unless an earlier kept one is its partner; ``pairs`` have a < b.

    At most ``few`` pairs (counted) are decided by one task in one pass, unless ``max_rounds`` are given. More
    go by a fixpoint: a node is kept once all earlier partners are dropped, and dropped once one is kept; the
    number of rounds is the longest chain of decisions, not the number of nodes. Never a partial result:
    raises if ``max_rounds`` do not settle all nodes, or if a partner that is no node blocks one for ever.
    """
    if max_rounds is None:
        known = cut(pairs.select("a", "b"))
        if known.count() <= few:
            every = cut(nodes.select(F.col(key).alias("node")))
            ends = known.select(F.col("a").alias("node")).union(known.select(F.col("b").alias("node")))
            if not ends.join(every, "node", "left_anti").isEmpty():
                raise ValueError("a pair names a node that is not there")
            gone = _dropped(known).withColumn("gone", F.lit(True))
            return every.join(gone, "node", "left").select(F.col("node").alias(key), F.col("gone").isNull().alias("kept"))
    open_ = cut(nodes.select(F.col(key).alias("node")))
    edges = cut(pairs.select("a", "b"))
    done, turn = None, 0
    while done is None or not open_.isEmpty():
        if turn == max_rounds:
            raise RuntimeError(f"nodes are still open after {max_rounds} rounds")
        turn += 1
        blocked = edges.select(F.col("b").alias("node")).distinct()
        kept = open_.join(blocked, "node", "left_anti").withColumn("kept", F.lit(True))
        dropped = edges.join(kept.select(F.col("node").alias("a")), "a").select(F.col("b").alias("node")).distinct().withColumn("kept", F.lit(False))
        now = cut(kept.unionByName(dropped))
        if done is not None and now.isEmpty():
            raise ValueError("a pair names a node that is not there")
        done = now if done is None else done.unionByName(now)
        open_ = cut(open_.join(now, "node", "left_anti"))
        edges = cut(edges.join(now.select(F.col("node").alias("a")), "a", "left_anti").join(now.select(F.col("node").alias("b")), "b", "left_anti"))
    return done.select(F.col("node").alias(key), "kept")


def kept_greedily(hashes: DataFrame, key: str, h: str, within: int = 6) -> DataFrame:
    """(key, kept): in key order, a row is kept unless the hash of an earlier kept one is at most ``within`` bits away.

    Rows of equal hashes stand or fall with the first of them; rows without a hash are near to none. At wide
    distances no pairs are formed (see ``near.decided``), at others those of distinct hashes only.
    """
    rows = cut(hashes.select(F.col(key).alias("key"), F.col(h).alias("hash")))
    reps = cut(rows.where("hash IS NOT NULL").groupBy("hash").agg(F.min("key").alias("node")))
    if wide(within):
        dropped = decided(reps, within).where("by IS NOT NULL").select("hash")
        first = reps.join(dropped.hint("merge"), "hash", "left_anti")
    else:
        pairs = near_pairs(reps, "node", "hash", within)
        first = reps.join(keep_greedily(reps, pairs, "node").where("kept"), "node")
    first = first.select("hash", F.col("node").alias("key"), F.lit(True).alias("kept"))
    judged = rows.join(first.hint("merge"), ["hash", "key"], "left")
    return judged.select(F.col("key").alias(key), (F.col("hash").isNull() | F.col("kept").isNotNull()).alias("kept"))


def dedup_reasons(rows: DataFrame, key: str, content: str, kept: DataFrame) -> DataFrame:
    """(key, reason): ok, exact_duplicate of a kept row, near_duplicate of one, or corrupt_image without a hash.

    A byte copy of a row that was itself dropped as near is near too: only kept rows make exact duplicates.
    """
    marked = rows.select(F.col(key), F.sha2(F.col(content), 256).alias("sha")).join(kept, key, "left")
    first = marked.where("kept").groupBy("sha").agg(F.min(key).alias("first"))
    reason = F.when(F.col("kept").isNull(), "corrupt_image").when(F.col("kept"), "ok").when(F.col("first") < F.col(key), "exact_duplicate").otherwise("near_duplicate")
    return marked.join(first, "sha", "left").select(key, reason.alias("reason"))


def decide(rows: DataFrame, within: int, met: DataFrame | None = None, held: DataFrame | None = None) -> DataFrame:
    """(key, sha, hash, reason, kept_by, own) of ``rows`` (key, sha, hash).

    ``met`` (hash, other, name): kept hashes of earlier runs near those of the rows, and the least name that has
    each. ``held`` (sha, hash, name): kept images of earlier runs with the hashes of the rows. A row is
    corrupt_image without a hash; ok if it is kept already (``own``: its name and bytes), or if no kept hash is
    near and it has the least key of its hash; exact_duplicate if what is kept has its bytes, near_duplicate
    otherwise. ``kept_by`` is the least name that is kept and near, its own for what is kept.
    """
    good = rows.where("hash IS NOT NULL")
    reps = good.groupBy("hash").agg(F.min(F.struct("key", "sha")).alias("first"))
    known = None
    if met is not None:
        known = cut(met.groupBy("hash").agg(F.min("name").alias("by")))
        reps = reps.join(known.select("hash"), "hash", "left_anti")
    reps = cut(reps)
    node = F.struct(F.col("first.key").alias("key"), "hash")
    named = reps.select("hash", node.alias("node"))
    if wide(within):
        fates = decided(named, within).withColumnRenamed("by", "other").hint("merge")
        keys = reps.select(F.col("hash").alias("other"), F.col("first.key").alias("by"))
        judged = reps.join(fates, "hash").withColumn("kept", F.col("other").isNull()).join(keys.hint("merge"), "other", "left")
    else:
        open_ = probes(reps.select("hash"), within)
        pairs = near(open_, open_, within)
        ends = pairs.where("hash <> other").join(named, "hash").join(named.select(F.col("hash").alias("other"), F.col("node").alias("to")), "other")
        ends = cut(ends.where("node < to").select(F.col("node").alias("a"), F.col("to").alias("b")))
        kept = cut(keep_greedily(named, ends, "node"))
        by = ends.join(kept.where("kept").select(F.col("node").alias("a")), "a").groupBy(F.col("b").alias("node")).agg(F.min("a.key").alias("by"))
        judged = reps.join(kept.withColumn("hash", F.col("node.hash")), "hash").join(by, "node", "left")
    judged = judged.select("hash", "kept", F.col("first.key").alias("least"), F.col("first.sha").alias("first_sha"), F.when(F.col("kept"), F.col("first.key")).otherwise(F.col("by")).cast("string").alias("by"))
    if known is not None:
        none = [F.lit(v).cast(judged.schema[c].dataType).alias(c) for c, v in (("kept", False), ("least", None), ("first_sha", None))]
        judged = judged.unionByName(known.select("hash", *none, "by"))
    seen = good.join(judged, "hash")
    own, same = F.lit(False), F.lit(False)
    if held is not None:
        names = held.groupBy("sha", "hash").agg(F.collect_set("name").alias("names"))
        seen = seen.join(names, ["sha", "hash"], "left")
        same = F.col("names").isNotNull()
        own = F.coalesce(F.array_contains("names", F.col("key").cast("string")), F.lit(False))
    ok = own | (F.col("kept") & (F.col("key") == F.col("least")))
    reason = F.when(ok, "ok").when(same | (F.col("kept") & F.col("sha").eqNullSafe(F.col("first_sha"))), "exact_duplicate").otherwise("near_duplicate")
    judged_ = seen.select("key", "sha", "hash", reason.alias("reason"), F.when(own, F.col("key").cast("string")).otherwise(F.col("by")).alias("kept_by"), own.alias("own"))
    corrupt = rows.where("hash IS NULL").select("key", "sha", "hash", F.lit("corrupt_image").alias("reason"), F.lit(None).cast("string").alias("kept_by"), F.lit(False).alias("own"))
    return judged_.unionByName(corrupt)


def curated(rows: DataFrame, key: str, content: str, h: str, within: int = 6, known: DataFrame | None = None) -> DataFrame:
    """(key, reason, sha, hash): exact and near duplicates in one pass over the keys in order, against what is kept.

    A row is corrupt_image without a hash, exact_duplicate if a kept row with a smaller key has its bytes,
    near_duplicate if one is at most ``within`` bits away, else ok (kept). ``known`` (sha, hash) are kept rows of
    earlier runs, which come before all rows. What is dropped drops nothing else. Equal bytes have equal hashes.
    """
    hashed = cut(rows.select(F.col(key).alias("key"), F.sha2(F.col(content), 256).alias("sha"), F.col(h).alias("hash")))
    met = held = None
    if known is not None:
        before = known.where("hash IS NOT NULL").select("sha", "hash", F.lit(None).cast("string").alias("name"))
        own = hashed.where("hash IS NOT NULL").select("hash").distinct()
        met = near(probes(own, within), probes(before.select("hash").distinct(), within), within).withColumn("name", F.lit(None).cast("string"))
        held = before.join(own, "hash", "left_semi")
    return decide(hashed, within, met, held).select(F.col("key").alias(key), "reason", "sha", "hash")


def _placed(rows: DataFrame, group: str, order: str) -> DataFrame:
    """``rows`` with _place, from 0 in ``order`` inside ``group``: ranks inside ranges of rows, and counts of the ranges before.

    A group with any share of all rows is ranked by many tasks; rows of one group and order must not be many.
    """
    dealt = cut(rows.repartitionByRange(group, order).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy(group, "_range").agg(F.count("*").alias("_count"))
    # a row for each range that a group reaches into
    before = F.coalesce(F.sum("_count").over(Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col(group).alias("_group"), F.col("_range").alias("_of"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(group, "_range").orderBy(order)) - 1
    ranked = dealt.withColumn("_inside", inside).join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    return ranked.withColumn("_place", F.col("_before") + F.col("_inside")).drop("_range", "_inside", "_group", "_of", "_before")


def numbered_targets(moves: DataFrame, key: str, target: str, taken: DataFrame | None = None) -> DataFrame:
    """``moves`` with a free name for each row: the first row of a target keeps it, the next ones get ``stem__1.ext`` and so on.

    Numbers go on until the name is no target of another row and not in ``taken`` (one column). Rows are ranked
    inside their target only; where numbers meet names that are there already, the next ones are taken.
    """
    name = F.col(target)
    suffix = F.regexp_extract(name, r"(\.[^.]+)$", 1)
    base = F.regexp_replace(name, r"\.[^.]+$", "")
    moves_ = _placed(moves, target, key)
    n = F.col("_place")
    there = moves.select(name.alias("name"))
    if taken is not None:
        there = there.unionByName(taken.select(F.col(taken.columns[0]).alias("name")))
        blocked = taken.select(F.col(taken.columns[0]).alias(target)).distinct().withColumn("_at_hand", F.lit(1))
        ranked = moves_.join(blocked, target, "left").withColumn("_n", n + F.coalesce("_at_hand", F.lit(0))).drop("_at_hand")
    else:
        ranked = moves_.withColumn("_n", n)
    # numbers that a name of the form stem__k.ext occupies: skipped when counting
    form = r"^(.*)__([0-9]{1,9})(\.[^.]+)?$"
    used = there.distinct().select((F.regexp_extract("name", form, 1)).alias("_base"), F.regexp_extract("name", form, 3).alias("_suffix"), F.regexp_extract("name", form, 2).alias("_k")).where("_k <> '' AND _k = CAST(CAST(_k AS INT) AS STRING)")
    holes = used.groupBy("_base", "_suffix").agg(F.sort_array(F.collect_set(F.col("_k").cast("int"))).alias("_holes"))
    placed = ranked.withColumn("_base", base).withColumn("_suffix", suffix).join(holes, ["_base", "_suffix"], "left")
    free = F.aggregate(F.coalesce("_holes", F.expr("array()").cast("array<int>")), F.col("_n").cast("int"), lambda k, hole: F.when((hole >= 1) & (hole <= k), k + 1).otherwise(k))
    return placed.withColumn("free_name", F.when(F.col("_n") == 0, name).otherwise(F.concat("_base", F.lit("__"), free.cast("string"), "_suffix"))).select(*moves.columns, "free_name")
