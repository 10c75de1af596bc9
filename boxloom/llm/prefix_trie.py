"""Prefix trie of conversations, merged family by family.

A family is the conversations of one base id (conv_id - conv_id % 100). Each conversation is rebuilt: the
first h turns of the base, then its own turns after its first h (h = crc32 of its decimal id, modulo 6). The
first turns of the base and the turns of all its family meet in one place, sorted (a cogroup by base id, as a
stream), and one pass rebuilds the conversations in the order of their ids and folds them into the family's
small trie. A node is the digest of all turns up to it; a turn travels as a digest and a length, not as text.

Only combined nodes are shuffled on. What a family alone holds is final there: members, children, leaves and
saved tokens below. Nodes in several families add up; these form the top of the trie, and their sums below
come by pointer doubling, in as many rounds as the logarithm of the depth down to which families agree, each a
join and a sum over nodes that have an ancestor that far up. A family's trie that grows beyond ``nodes`` is
sent on in pieces; what may go on in another piece counts as held by several, so results are the same.

Defined results: rows without a conv_id are left out; null roles and texts are empty; a null turn comes first;
rows of equal turns go in the order of the digests of role and text, so repeated rows are turns of their own
and the order of the input does not matter; negative ids belong to the base that truncated division gives; a
conversation that ends before its first own turn is a member of its last node, be it the root; very long texts
count like others; other columns are ignored, whatever their names; an empty table gives no rows, not even a
root. A conversation is folded as a stream by one task, and so is the list of ids that end in one node.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxloom.llm.common import Shelf, cut, shuffle_partitions, table, tidied

FAMILY, HEADS = 100, 6
#: Nodes of one family that a worker holds at once.
NODES = 200_000
ROOT = b""
_NODE = "node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, chars long, ends string, first_end long, pieces long"
_NAMES = [x.split()[0] for x in _NODE.split(", ")]


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that name a turn."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))


def _below(parent: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(parent + turn, digest_size=16).digest()


class _Family:
    """The trie of one family, or a piece of it."""

    def __init__(self):
        # node -> [parent, depth, least conv, convs, chars, ends, pieces]; parents come before children
        self.nodes: dict[bytes, list] = {}

    def visit(self, node: bytes, parent: bytes | None, depth: int, conv: int, chars: int) -> None:
        found = self.nodes.get(node)
        if found is None:
            self.nodes[node] = [parent, depth, conv, 1, chars, [], 1]
        else:
            found[3] += 1

    def rows(self) -> Iterator[pa.RecordBatch]:
        kids: dict[bytes, list[int]] = {}
        done = []
        for node, (parent, depth, conv, n, chars, ends, pieces) in reversed(self.nodes.items()):
            children, leaves, saved = kids.pop(node, (0, 0, 0))
            leaves, saved = leaves or 1, saved + (n - 1) * chars
            if parent is not None:
                up = kids.setdefault(parent, [0, 0, 0])
                up[0] += 1
                up[1] += leaves
                up[2] += saved
            # the parent's least member is known here unless an earlier piece or another family has it too
            above = self.nodes.get(parent) if parent is not None else None
            done.append((node, parent, depth, conv, above[2] if above else None, n, children, leaves, saved, chars, ",".join(map(str, ends)), ends[0] if ends else None, pieces))
        schema = pa.schema([(c, pa.binary() if c in ("node", "parent") else pa.string() if c == "ends" else pa.int64()) for c in _NAMES])
        for k in range(0, len(done), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*done[k : k + 10_000]), schema)], schema=schema)
        self.nodes = {}


def _families(most: int):
    """mapInArrow over rows sorted by (base, conv_id with the base's first turns before all, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _Family()
        family = conv = None
        head: list[tuple[bytes, int]] = []
        node, depth, own, skip = ROOT, 0, 0, 0
        for batch in batches:
            for base, own_id, digest, chars in zip(*(batch.column(c).to_pylist() for c in ("base", "conv_id", "digest", "chars"))):
                if base != family:
                    if conv is not None:
                        trie.nodes[node][5].append(conv)
                    yield from trie.rows()
                    family, conv, head = base, None, []
                if own_id is None:
                    head.append((digest, chars))
                    continue
                if own_id != conv:
                    if conv is not None:
                        trie.nodes[node][5].append(conv)
                        if len(trie.nodes) >= most:
                            yield from trie.rows()
                    conv, own, skip = own_id, 0, zlib.crc32(str(own_id).encode()) % HEADS
                    node, depth = ROOT, 0
                    trie.visit(ROOT, None, 0, conv, 0)
                    for d, n in head[:skip]:
                        parent, node, depth = node, _below(node, d), depth + 1
                        trie.visit(node, parent, depth, conv, n)
                own += 1
                if own > skip:
                    if len(trie.nodes) >= most:
                        # the nodes on this conversation's path go on in the next piece
                        at = node
                        while at in trie.nodes:
                            trie.nodes[at][6] = 2
                            at = trie.nodes[at][0]
                        yield from trie.rows()
                    parent, node, depth = node, _below(node, digest), depth + 1
                    trie.visit(node, parent, depth, conv, chars)
        if conv is not None:
            trie.nodes[node][5].append(conv)
        yield from trie.rows()

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sha) over rows sorted by (node, first_end): the digest of all ends of a node, a piece at a time."""
    name, sha = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for node, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if sha is not None and node == name:
                sha.update(b"," + ends.encode())
                continue
            if sha is not None:
                done.append((name, sha.hexdigest()))
            name, sha = node, hashlib.sha256(ends.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done])], ["node", "sha"])
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([sha.hexdigest()])], ["node", "sha"])


def _doubled(top: DataFrame) -> DataFrame:
    """(node, leaves, saved) with those of all nodes below added; ``top`` (node, parent, leaves, saved) is closed upwards."""
    state = cut(top.select("node", F.col("parent").alias("up"), "leaves", "saved"))
    while not state.where("up IS NOT NULL").isEmpty():
        # up is 2^k levels above: it gets what lies less than 2^k levels below node, and looks twice as far up next
        add = state.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        grown = state.join(add, "node", "left").select("node", "up", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))
        far = state.where("up IS NOT NULL").select(F.col("node").alias("up"), F.col("up").alias("next"))
        state = cut(grown.join(far, "up", "left").select("node", F.col("next").alias("up"), "leaves", "saved"))
    return state.select("node", "leaves", "saved")


def prefix_trie(rows: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text", nodes: int = NODES) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = rows.sparkSession
    shelf, parts = Shelf(spark), shuffle_partitions(spark)
    conv = F.col(key).cast("long")
    turns = rows.where(F.col(key).isNotNull()).select((conv - conv % FAMILY).alias("base"), conv.alias("conv_id"), F.col(order).alias("turn"), turn_digest(F.col(role), F.col(text)).alias("digest"), F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("chars"))
    turns = shelf.put(turns)
    place = F.row_number().over(Window.partitionBy("base").orderBy(F.col("turn").asc_nulls_first(), "digest"))
    heads = turns.where("conv_id = base").withColumn("place", place).where(F.col("place") < HEADS).drop("place").withColumn("conv_id", F.lit(None).cast("long"))
    sorted_ = heads.unionByName(turns).repartition(parts, "base").sortWithinPartitions("base", F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "digest")
    found = shelf.put(sorted_.select("base", "conv_id", "digest", "chars").mapInArrow(tidied(_families(nodes)), _NODE))

    least = ("conv_id", "parent_conv_id")
    same = ("parent", "depth", "n_children", "n_leaves", "saved_tokens", "chars", "ends")
    every = shelf.put(found.groupBy("node").agg(*[F.min(c).alias(c) for c in least], *[F.max(c).alias(c) for c in same], *[F.sum(c).alias(c) for c in ("n_convs", "pieces")]))
    # nodes that several families hold, with their members' least id for the nodes right below
    shared = shelf.put(every.where("pieces > 1").select("node", "parent", "depth", "conv_id", "n_convs", "chars"))
    known = shared.where("depth > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    root = every.where("depth = 0").agg(F.min("conv_id").alias("above"))
    # the root is parent of a node for each first turn there is: no key to shuffle by
    deep = every.where("depth > 1").join(known, "parent", "left")
    shallow = every.where("depth = 1").withColumn("above", root.scalar())
    linked = shelf.put(deep.unionByName(shallow.select(*deep.columns)).withColumn("shared", F.col("pieces") > 1))

    own = F.expr("NOT shared")
    kids = linked.where("above IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("children"), F.sum(F.when(own, F.col("n_leaves"))).alias("leaves"), F.sum(F.when(own, F.col("saved_tokens"))).alias("saved"))
    top = shared.join(kids, "node", "left")
    top = shelf.put(top.select("node", "parent", "depth", "conv_id", "n_convs", F.coalesce("children", F.lit(0)).alias("n_children"), F.when(F.col("children").isNull(), F.lit(1)).otherwise(F.coalesce("leaves", F.lit(0))).alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars") + F.coalesce("saved", F.lit(0))).alias("saved")))
    sums = _doubled(top).withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"})
    pieces = found.where("first_end IS NOT NULL").select("node", "first_end", "ends").join(shared.select("node"), "node", "left_semi")
    ends = pieces.repartition(parts, "node").sortWithinPartitions("node", "first_end").select("node", "ends").mapInArrow(_ends, "node binary, sha string")
    above = linked.where("shared").select("node", "above")
    top = top.select("node", "depth", "conv_id", "n_convs", "n_children").join(sums, "node").join(ends, "node", "left").join(above, "node", "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    top = top.select("conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    alone = linked.where("NOT shared").select("conv_id", "depth", F.coalesce("above", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.sha2("ends", 256).alias("ends_sha256"))
    # a root that one family alone holds
    single = every.where("depth = 0 AND pieces = 1").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.sha2("ends", 256).alias("ends_sha256"))
    out = alone.unionByName(single).unionByName(top.select(*columns))
    return out.select(*[F.col(c).cast("string" if c == "ends_sha256" else "long").alias(c) for c in columns])


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``conversations``."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda z, i: CASE WHEN z & 1 = 1 THEN xor(z >> 1, 3988292384) ELSE z >> 1 END)), 4294967295)"
_SQL = f"""WITH t AS (SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS g, length(coalesce(text, '')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, t.p, 0 AS part, g, chars FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.p <= h
  UNION ALL SELECT c.conv_id, t.p, 1, g, chars FROM c JOIN t ON t.conv_id = c.conv_id AND t.p > h),
s AS (SELECT conv_id, row_number() OVER w AS depth, chars, md5(string_agg(g, '') OVER w) AS node FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, p ROWS UNBOUNDED PRECEDING)),
m AS (SELECT conv_id, 0 AS depth, 0 AS chars, '' AS node FROM c UNION ALL SELECT conv_id, depth, chars, node FROM s),
n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM m GROUP BY node, depth),
up AS (SELECT DISTINCT x.node, x.depth, y.node AS parent FROM m x JOIN m y ON x.conv_id = y.conv_id AND x.depth = y.depth + 1),
k AS (SELECT n.*, (SELECT count(*) FROM up WHERE up.parent = n.node AND up.depth = n.depth + 1) AS n_children FROM n),
b AS (SELECT DISTINCT y.node AS top, x.node FROM m x JOIN m y ON x.conv_id = y.conv_id AND x.depth >= y.depth),
a AS (SELECT b.top, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens FROM b JOIN k ON k.node = b.node GROUP BY b.top),
e AS (SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ends FROM (SELECT conv_id, arg_max(node, depth) AS node FROM m GROUP BY conv_id) GROUP BY node)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, k.n_convs, k.n_children, a.n_leaves, CAST(a.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM k JOIN a ON a.top = k.node LEFT JOIN up ON up.node = k.node AND up.depth = k.depth LEFT JOIN n q ON q.node = up.parent LEFT JOIN e ON e.node = k.node"""

QUERIES = {"op12_prefix_trie": op12_prefix_trie}
ORACLE_SQL = {"op12_prefix_trie": _SQL}
