"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts form a group that must not be torn. Groups above a share of a shard are packed one
by one; smaller ones first gather in a fixed number of bundles by the hash of their text. So the driver
packs at most ``bundles`` + shards * ``fine`` items, whatever the number of rows. Items go in falling size
into the open shard with the tightest room left, found in a balanced tree; the smallest capacity at which
all items fit the shards is found by bisection, which makes the shards near equal (law ``bytes``).

Slots come from per-part counts and a rank inside each part: parts hold about ``part_rows`` rows of one
item, dealt out by key and place in the input, so an item with a third of all rows is ranked by many tasks,
also if all have one key. Slots of an item that needs several parts depend on the order of the input.

Defined results: a null text has 0 bytes and shares the group of the empty text; repeated rows and null
doc_ids get a slot each; an empty table gives no rows; a group larger than a shard's fair share has a
shard to itself; groups of equal size go in the order of the hashes of their texts; very long texts count
like others. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxloom.llm.common import cut, table

SHARDS = 40
ROW_BYTES = 16
BUNDLES = 8192
FINE = 64
PART_ROWS = 100_000


class Rooms:
    """A treap of (room left, bin): ordered by key, kept balanced by a heap order on a mixed key."""

    def __init__(self):
        self.root: list | None = None  # [key, priority, left, right]

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        x = (key[0] * 0x9E3779B97F4A7C15 + key[1] * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF
        return (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF

    def _cut(self, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """Trees of the keys below ``key`` and of the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._cut(node[3], key)
            return node, high
        low, node[2] = self._cut(node[2], key)
        return low, node

    def _join(self, low: list | None, high: list | None) -> list | None:
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._join(low[3], high)
            return low
        high[2] = self._join(low, high[2])
        return high

    def put(self, key: tuple[int, int]) -> None:
        low, high = self._cut(self.root, key)
        self.root = self._join(self._join(low, [key, self._priority(key), None, None]), high)

    def take_tightest(self, room: int) -> tuple[int, int] | None:
        """Takes out the least key with at least ``room``; None if there is none."""
        low, high = self._cut(self.root, (room, -1))
        found = high
        while found and found[2]:
            found = found[2]
        if found is None:
            self.root = low
            return None
        _, rest = self._cut(high, (found[0][0], found[0][1] + 1))
        self.root = self._join(low, rest)
        return found[0]


def pack(sizes: list[int], shards: int, capacity: int) -> list[int] | None:
    """The shard of each item (sizes in falling order) under ``capacity``; None if one does not fit.

    An item above the capacity counts as one that fills a shard by itself.
    """
    rooms = Rooms()
    for k in range(shards):
        rooms.put((capacity, k))
    where = []
    for size in sizes:
        got = rooms.take_tightest(min(size, capacity))
        if got is None:
            return None
        where.append(got[1])
        rooms.put((got[0] - min(size, capacity), got[1]))
    return where


def pack_evenly(sizes: list[int], shards: int) -> list[int]:
    """Best fit decreasing under the least capacity, by bisection, that holds all items."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    falling = [sizes[i] for i in order]
    low, high = -(-sum(sizes) // shards), max([1, *falling]) + -(-sum(sizes) // shards)
    best = pack(falling, shards, high)
    while low < high:
        middle = (low + high) // 2
        found = pack(falling, shards, middle)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    out = [0] * len(sizes)
    for i, k in zip(order, best):
        out[i] = k
    return out


def pack_into(sizes: list[int], capacity: int) -> list[int]:
    """The shard of each item under ``capacity``: best fit decreasing, which opens a shard where no open one has room.

    An item above the capacity has a shard to itself.
    """
    if capacity <= 0:
        raise ValueError("a capacity above 0 is needed")
    rooms, opened, out = Rooms(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        got = rooms.take_tightest(sizes[i]) if sizes[i] <= capacity else None
        if got is None:
            got, opened = (max(capacity, sizes[i]), opened), opened + 1
        out[i] = got[1]
        rooms.put((got[0] - sizes[i], got[1]))
    return out


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, bundles: int = BUNDLES, fine: int = FINE, part_rows: int = PART_ROWS, capacity: int | None = None) -> DataFrame:
    """``key``, size, text_crc32, law, shard, slot, grown_shard of each row of ``docs``.

    With a ``capacity`` in bytes, as many shards are opened as best fit decreasing needs; ``shards`` then only
    says how large a group must be to be packed by itself.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = cut(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(F.col(text)) + ROW_BYTES).cast("long").alias("had"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(F.md5(body)).alias("a"),
            F.xxhash64(F.lit(1), F.md5(body)).alias("b"),
            F.xxhash64(F.monotonically_increasing_id()).alias("salt"),  # settled here: rows are kept
        ).select("key", F.coalesce("had", F.lit(ROW_BYTES).cast("long")).alias("size"), "text_crc32", "a", "b", "salt")
    )
    groups = cut(rows.groupBy("a", "b").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    # large groups are items of their own: at most shards * fine of them
    large = groups.where(F.col("bytes") > max(1, total // (shards * fine)))
    small = groups.where(F.col("bytes") <= max(1, total // (shards * fine)))
    bundle = F.pmod(F.xxhash64(F.lit(7), "a", "b"), F.lit(bundles))
    alone = large.select("a", "b", "bytes", "n").toPandas().sort_values(["bytes", "a", "b"], ascending=False)
    rest = small.groupBy(bundle.alias("item")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).toPandas().sort_values("item")
    alone["item"] = np.arange(bundles, bundles + len(alone))
    sizes = [*alone["bytes"].tolist(), *rest["bytes"].tolist()]
    items = [*alone["item"].tolist(), *rest["item"].tolist()]
    counts = [*alone["n"].tolist(), *rest["n"].tolist()]
    if capacity is None:
        where = pack_evenly(sizes, shards)
    else:
        where = pack_into(sizes, capacity)
        shards = max(where, default=-1) + 1
    begin, next_slot = [], [0] * shards
    for k, n in zip(where, counts):
        begin.append(next_slot[k])
        next_slot[k] += n
    places = spark.createDataFrame(list(zip(items, where, begin, [max(1, -(-n // part_rows)) for n in counts])), "item long, shard int, begin long, parts long")
    own = spark.createDataFrame([(int(r.a), int(r.b), int(r.item)) for r in alone.itertuples()], "a long, b long, own long")
    # both tables are bounded by bundles + shards * fine rows
    placed = (
        rows.join(F.broadcast(own), ["a", "b"], "left")
        .withColumn("item", F.coalesce("own", bundle))
        .join(F.broadcast(places), "item")
        .withColumn("part", F.pmod(F.xxhash64(F.lit(3), "key", "salt"), F.col("parts")))
    )
    per_part = placed.groupBy("item", "part").agg(F.count("*").alias("in_part"))
    before = per_part.withColumn("earlier", F.sum("in_part").over(Window.partitionBy("item").orderBy("part")) - F.col("in_part")).drop("in_part")
    split = placed.where("parts > 1").join(before, ["item", "part"])
    plain = placed.where("parts = 1").withColumn("earlier", F.lit(0).cast("long"))
    rank = F.row_number().over(Window.partitionBy("item", "part").orderBy("key", "a"))
    return plain.unionByName(split.select(*plain.columns)).select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("begin") + F.col("earlier") + rank - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


QUERIES = {"op9_sharding": op9_sharding}
