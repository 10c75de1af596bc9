"""Edge cases of label lines, geometry, matching and duplicates, by hand or against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from boxloom.functions import geometry as G
from boxloom.functions import labels as L
from boxloom.functions import text as X
from boxloom.operators import curation as C
from boxloom.operators import decisions as D
from boxloom.operators import dedup as U
from boxloom.operators import matching as M


def test_label_lines(spark):
    cases = {"": "", " ": "", "0 .5 .5 .1": "l", "1.9 .5 .5 .1 .1": "lcs", "-0.5 .5 .5 .1 .1 9": "lcs", "x .5 .5 .1 .1": "", "nan .5 .5 .1 .1": "", "inf .5 .5 .1 .1": "", "1 .5 oops .1 .1": "lc", "2\t.5\t.5\t.1\t.1\r": "lcs", "1.5d .5 .5 .1 .1": "", "1_0 .5 .5 .1 .1": "lcs"}
    rows = L.parse(spark.createDataFrame([(k,) for k in cases], "line string"))
    got = rows.select("line", "cls", L.loose().alias("l"), L.class_only().alias("c"), L.strict().alias("s")).collect()
    assert {r.line: "".join(k for k in "lcs" if r[k]) for r in got} == cases
    assert {r.line: r.cls for r in got if r.s} == {"1.9 .5 .5 .1 .1": 1, "-0.5 .5 .5 .1 .1 9": 0, "2\t.5\t.5\t.1\t.1\r": 2, "1_0 .5 .5 .1 .1": 10}


def test_class_map():
    assert L.parse_class_map("0:4, 1:2,,0:5") == {0: 5, 1: 2}
    for bad in ("1", "a:b"):
        with pytest.raises(ValueError):
            L.parse_class_map(bad)


def test_iou_and_rounding(spark):
    row = spark.sql("SELECT struct(0D AS x1, 0D AS y1, 2D AS x2, 2D AS y2) a, struct(1D AS x1, 1D AS y1, 3D AS x2, 3D AS y2) b, struct(2D AS x1, 0D AS y1, 4D AS x2, 2D AS y2) c, struct(1D AS x1, 1D AS y1, 1D AS x2, 1D AS y2) d")
    got = row.select(G.iou(F.col("a"), F.col("b")), G.iou(F.col("a"), F.col("c")), G.iou(F.col("d"), F.col("d")), G.iou(F.col("a"), F.col("a"))).first()
    assert list(got) == [1 / 7, 0.0, 0.0, 1.0]
    half = spark.sql("SELECT 0.5D cx, 0.5D cy, 0.5D w, 0.3D h")
    assert list(half.select(*G.to_pixels(*map(F.col, ("cx", "cy", "w", "h")), 10, 5)).first()) == [2, 2, 8, 3]


def test_names_and_bands(spark):
    df = spark.createDataFrame([("http://h/a/b.jpg?x", "a.b.JPG", 9.99), ("http://h/dir/", ".hidden", 40.0), ("x", "n", 300.0)], "u string, n string, v double")
    got = [tuple(r) for r in df.select(X.url_file_name(F.col("u")), X.stem(F.col("n")), X.extension(F.col("n")), X.band_label(F.col("v"))).collect()]
    assert got == [("b.jpg", "a.b", "jpg", "000-010"), ("", ".hidden", "", "040-050"), ("x", "n", "", "100-plus")]


def test_payloads(spark):
    cases = ["[1]", '{"plates":null}', '{"plates":"no"}', '{"plates":[{"confidence":"0.7","ocr_confidence":0.9,"plate":"AB 12","bbox":[1,2,3]}]}', '{"plates":[{"confidence":"x","ocr_confidence":0.9}]}', None]
    got = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, p string").select("i", D.parse_payload(F.col("p")).alias("x")).orderBy("i").collect()
    assert [len(r.x) for r in got] == [0, 0, 0, 1, 1, 0]
    assert tuple(got[3].x[0]) == (0.7, 0.9, "AB 12", [1.0, 2.0, 3.0]) and tuple(got[4].x[0])[:2] == (0.0, 0.0)


def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    inter = max(0.0, w) * max(0.0, h)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return inter / union if union > 0 else 0.0


def test_matching_against_plain_python(spark):
    rnd = random.Random(5)
    box = lambda: (lambda x, y: (float(x), float(y), float(x + rnd.randint(1, 4)), float(y + rnd.randint(1, 4))))(rnd.randint(0, 5), rnd.randint(0, 5))
    gt = {i: [(rnd.randint(0, 4), box()) for _ in range(rnd.randint(0, 5))] for i in range(60)}
    pr = {i: sorted([(rnd.randint(0, 9) / 10, rnd.randint(0, 4), box()) for _ in range(rnd.randint(0, 6))], key=lambda p: -p[0]) for i in range(60)}
    g = spark.createDataFrame([(i, k, c, *b) for i, bs in gt.items() for k, (c, b) in enumerate(bs)], "image_id long, box_idx int, cls int, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(i, k, s, c, *b) for i, bs in pr.items() for k, (s, c, b) in enumerate(bs)], "image_id long, det_idx int, conf double, cls int, x1 double, y1 double, x2 double, y2 double")
    tp = {(r.image_id, r.det_idx): r.tp for r in M.true_positives(g, p, [0.3]).collect()}
    rev = {r.image_id: (r.missed, r.spurious, r.wrong_class, r.loose_box) for r in M.review(g, p).collect()}
    for i in range(60):
        used = set()
        for k, (_, _, b) in enumerate(pr[i]):
            best, at = 0.0, -1
            for j, (_, q) in enumerate(gt[i]):
                if j not in used and overlap(b, q) > best:
                    best, at = overlap(b, q), j
            assert tp[i, k] == (best >= 0.3)
            if best >= 0.3:
                used.add(at)
        used, missed, wrong, loose = set(), 0, 0, 0
        for c, q in gt[i]:
            best, at = 0.0, -1
            for k, (_, _, b) in enumerate(pr[i]):
                if k not in used and overlap(q, b) > best:
                    best, at = overlap(q, b), k
            if best < 0.3:
                missed += 1
                continue
            used.add(at)
            wrong += pr[i][at][1] != c
            loose += pr[i][at][1] == c and best < 0.5
        if gt[i] or pr[i]:
            assert rev[i] == (missed, len(pr[i]) - len(used), wrong, loose)


def test_near_duplicates_lose_nothing(spark):
    rnd = random.Random(2)
    hs = [rnd.getrandbits(64) for _ in range(60)]
    hs += [h ^ sum(1 << b for b in rnd.sample(range(64), rnd.choice([0, 3, 6, 7]))) for h in hs for _ in range(3)]
    signed = [h - (1 << 64) if h >> 63 else h for h in hs]
    df = spark.createDataFrame(list(enumerate(signed)), "id int, h long")
    pairs = U.near_pairs(df, "id", "h", 6)
    want = {(a, b) for a in range(len(hs)) for b in range(a + 1, len(hs)) if (hs[a] ^ hs[b]).bit_count() <= 6}
    assert {(r.a, r.b) for r in pairs.collect()} == want
    kept = []
    for i in range(len(hs)):
        if not any((k, i) in want for k in kept):
            kept.append(i)
    assert sorted(r.id for r in U.keep_greedily(df, pairs, "id").where("kept").collect()) == kept


def test_greedy_keeping_is_never_partial(spark):
    nodes = spark.range(8)
    pairs = spark.createDataFrame([(i, i + 1) for i in range(7)], "a long, b long")
    assert {r.id: r.kept for r in U.keep_greedily(nodes, pairs, "id").collect()} == {i: i % 2 == 0 for i in range(8)}
    with pytest.raises(RuntimeError):
        U.keep_greedily(nodes, pairs, "id", max_rounds=2)


def test_upsert_is_idempotent(spark):
    lines = spark.createDataFrame([(1, 0), (1, 4), (2, 4)], "image_id int, cls int")
    plates = spark.createDataFrame([(1,), (1,)], "image_id int")
    once = D.upsert_plates(lines, plates)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, D.upsert_plates(once, plates).collect())) == [(1, 0), (1, 4), (1, 4), (2, 4)]


def test_splits(spark):
    names = spark.createDataFrame([(f"n{i:03d}",) for i in range(11)], "name string")
    got = {r.name: r.split for r in C.split_seeded(names, "name").collect()}
    order = [f"n{i:03d}" for i in range(11)]
    random.Random(42).shuffle(order)
    assert [got[n] for n in order] == ["train"] * 7 + ["val"] * 2 + ["test"] * 2
    sample = [r.name for r in C.sample_seeded(names, "name", 4).orderBy("sample_pos").collect()]
    assert sample == random.Random(42).sample([f"n{i:03d}" for i in range(11)], 4)
    assert C.split_by_hash(spark.createDataFrame([], "name string"), "name").count() == 0
