"""Embedding near-dedup, prefix trie and centroids against plain Python, with odd rows."""

import collections
import functools
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.llm import centroids, components, embedding_dedup, prefix_trie

VECTORS = "vec_id long, embedding array<double>, key string, label int, cid int"


# ---- near duplicates of embeddings --------------------------------------------------------------------


def usable(x):
    return bool(x) and all(v is not None and math.isfinite(v) for v in x) and any(x)


def cosine(a, b):
    a, b = ([v / max(map(abs, x)) for v in x] for x in (a, b))  # squares of very large and small numbers
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))


def brute_links(rows, threshold=0.95):
    """(id, links, component) of each row, by all pairs."""
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    links = [0] * len(rows)
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if usable(a) and usable(b) and len(a) == len(b):
                if cosine(a, b) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    top[root(max(root(i), root(j)))] = min(root(i), root(j))
    least = {}
    for i, (k, _) in enumerate(rows):
        least.setdefault(root(i), []).append(k)
    out = []
    for i, (k, a) in enumerate(rows):
        ids = [x for x in least[root(i)] if x is not None]
        out.append((k, links[i], min(ids) if ids else None))
    return out


def some_vectors(seed):
    rnd = np.random.default_rng(seed)
    rows = []
    for c in range(6):
        middle = rnd.standard_normal(24)
        for _ in range(int(rnd.integers(1, 30))):
            rows.append((middle + rnd.standard_normal(24) * 0.22 * rnd.random()).tolist())
    rows += [rnd.standard_normal(24).tolist() for _ in range(40)]
    rows += [rows[0], rows[0], [2 * v for v in rows[0]], [-v for v in rows[0]], None, [], [0.0] * 24, [None] + rows[1][1:], [math.nan] + rows[1][1:], [math.inf] + rows[1][1:]]
    rows += [rows[0][:12], rows[0][:12], [1e200] * 24, [1e-200] * 24, [-0.0, 1.0], [0.0, 1.0], [1.0]]
    order = rnd.permutation(len(rows)).tolist()
    keys = [None if k % 17 == 5 else 1000 - k for k in range(len(rows))]
    return [(keys[k], rows[i]) for k, i in enumerate(order)]


@pytest.mark.parametrize("seed,block,small", [(1, 4096, None), (2, 4, 0)])
def test_near_embeddings_equal_all_pairs(spark, monkeypatch, seed, block, small):
    if small is not None:  # the components of large tables
        monkeypatch.setattr(embedding_dedup, "components", functools.partial(components.components, small=small))
    rows = some_vectors(seed)
    df = spark.createDataFrame([(k, x, "clash", 1, 2) for k, x in rows], VECTORS)
    got = embedding_dedup.near_duplicates(df, miss=1e-6, block=block).collect()
    want = brute_links(rows)
    assert collections.Counter((r.vec_id, r.n_links, r.component_id) for r in got) == collections.Counter(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_near_embeddings_of_hot_copies_and_none(spark):
    df = spark.range(3000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 > 0, F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))).otherwise(F.array(F.cos("id"), F.sin("id"), F.col("id") * 0.0)).alias("embedding"))
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).where("vec_id % 3 > 0").collect()}
    assert len(got) == 2000 and all(r.n_links == 1999 and r.component_id == 1 for r in got.values())
    none = spark.createDataFrame([], VECTORS)
    assert embedding_dedup.near_duplicates(none).collect() == []
    with pytest.raises(ValueError):
        embedding_dedup.near_duplicates(none, threshold=1.0)


def test_codes_do_not_depend_on_the_batch():
    x = np.random.default_rng(5).standard_normal((300, 64))
    every = embedding_dedup.codes(x, 20, 30)
    assert all((embedding_dedup.codes(x[k : k + 1], 20, 30) == every[k]).all() for k in range(0, 300, 7))
    assert (embedding_dedup.codes(x * 3.7, 20, 30) == every).mean() > 0.999


def test_the_index_grows_with_the_vectors():
    for n in (10, 10**4, 10**7, 10**10):
        bits, tables = embedding_dedup.tables_for(n, 0.95, 0.002)
        meet = (1 - math.acos(0.95) / math.pi) ** bits
        assert 2**bits >= 8 * n and (1 - meet) ** tables <= 0.002


# ---- prefix trie --------------------------------------------------------------------------------------


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[c].append(((turn is not None, turn or 0), name, (role, text)))
    built = {}
    for c in own:
        own[c].sort()
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        built[c] = tuple(x[2] for x in own.get(base, [])[:h]) + tuple(x[2] for x in own[c][h:])
    members = collections.defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = collections.Counter(n[:-1] for n in members if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, cs in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not kids[n]
            saved[n[:d]] += (len(cs) - 1) * len(n[-1][1]) if n else 0
    out = []
    for n, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(n))
        out.append((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), kids[n], leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return collections.Counter(out)


def some_conversations(seed):
    rnd = random.Random(seed)
    rows = []
    ids = [*range(-205, -190), *range(-8, 9), 100, 101, 105, 150, 199, *range(200, 210), 301, 302, 400, 401, 402, 10**12, 10**12 + 1]
    for c in ids:
        for t in range(rnd.choice([1, 2, 3, 6, 7, 9])):
            rows.append((c, rnd.choice([t, t, t, 0, None]), rnd.choice(["user", "assistant", None, ""]), rnd.choice(["a", "bb", "ccc \U0001f600", None, "a"])))
    rows += rows[:5] + [(None, 0, "user", "lost")]
    return rows


@pytest.mark.parametrize("seed,nodes", [(1, 200_000), (2, 3), (3, 1)])
def test_trie_equals_plain_python(spark, seed, nodes):
    rows = some_conversations(seed)
    df = spark.createDataFrame([(*r, "clash", 1, b"x") for r in rows], "conv_id long, turn long, role string, text string, base string, depth int, node binary")
    got = prefix_trie.prefix_trie(df.repartition(3), nodes=nodes)
    assert collections.Counter(tuple(r) for r in got.collect()) == brute_trie(rows)


def test_trie_of_one_long_conversation_in_pieces(spark):
    rows = [(7, t, "user", f"turn {t}") for t in range(300)] + [(700 + k, t, "user", f"turn {t}") for k in (0, 1) for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for nodes in (16, 200_000):
        assert collections.Counter(tuple(r) for r in prefix_trie.prefix_trie(df, nodes=nodes).collect()) == brute_trie(rows)
    assert prefix_trie.prefix_trie(df.where("false")).collect() == []


# ---- centroids ----------------------------------------------------------------------------------------


def brute_clusters(rows, k, dims, scale, rounds=3):
    kept = [(i, [math.floor(scale * v) for v in x]) for i, x in rows if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) and abs(v * scale) <= centroids.LIMIT for v in x)]
    seeds = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:k]
    c = [x for _, x in seeds]
    if not c:
        return collections.Counter()
    for turn in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(x, m)), j) for j, m in enumerate(c)) for _, x in kept]
        if turn < rounds:
            for j in range(len(c)):
                own = [x for (_, x), (_, n) in zip(kept, near) if n == j]
                if own:
                    c[j] = [sum(v) // len(own) for v in zip(*own)]
    per = collections.Counter()
    for d, j in near:
        per[j] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return collections.Counter((i, j, d, per[j], sum(per.values()), sha[j]) for (i, _), (d, j) in zip(kept, near))


@pytest.mark.parametrize("seed,scale,spread,k", [(1, 64, 1.0, 16), (2, 1, 2.0, 5), (3, 3, 1.0, 40), (4, 1000, 1000.0, 7)])
def test_centroids_equal_plain_python(spark, seed, scale, spread, k):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice([-1, 0, 1, rnd.uniform(-1, 1)]) * spread for _ in range(4)]) for i in range(300)]  # many ties
    rows += [(400, None), (401, []), (402, [1.0] * 3), (403, [1.0, None, 0.0, 0.0]), (404, [math.nan] * 4), (405, [math.inf] * 4), (406, [1e300] * 4)]
    rows += [(None, [0.5] * 4), (None, None)] + rows[:7] + [(0, [9.0 * spread] * 4)] * 2
    df = spark.createDataFrame([(i, x, "clash", 1, 2) for i, x in rows], VECTORS.replace("key", "x").replace("cid", "cluster"))
    got = centroids.cluster(df.repartition(5), k=k, dims=4, scale=scale)
    assert collections.Counter(tuple(r) for r in got.collect()) == brute_clusters(rows, k, 4, scale)


def test_centroids_of_little(spark):
    none = spark.createDataFrame([], VECTORS)
    assert centroids.cluster(none).collect() == []
    assert [f.simpleString() for f in centroids.cluster(none).schema][:3] == ["vec_id:bigint", "cluster:int", "distance:bigint"]
    few = [(3, [1.0, 2.0]), (3, [1.0, 2.0]), (5, [0.0, 0.0])]
    df = spark.createDataFrame([(i, x, "", 0, 0) for i, x in few], VECTORS)
    assert collections.Counter(tuple(r) for r in centroids.cluster(df, dims=2).collect()) == brute_clusters(few, 16, 2, 64)


def test_bounds_hold_and_spare_distances(spark):
    rnd = np.random.default_rng(3)
    middles = rnd.integers(-500, 500, (8, 16))
    x = (middles[rnd.integers(0, 8, 2000)] + rnd.integers(-20, 20, (2000, 16))).astype(np.int64)
    c = x[:8].copy()
    cluster, upper, lower = np.zeros(2000, np.int32), np.full(2000, np.float32(np.inf)), np.zeros((2000, 8), np.float32)
    first = centroids.assign(x, cluster, upper, lower, c, centroids.halves(c))
    every = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all()
    assert (upper.astype(float) ** 2 >= every[np.arange(2000), cluster]).all() and (lower.astype(float) ** 2 <= every).all()
    assert first < 2000 * 8 and centroids.assign(x, cluster, upper, lower, c, centroids.halves(c)) < first / 2
