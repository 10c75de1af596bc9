"""Duplicates, names, splits, samples, averages and writers against plain Python, with nulls and ties."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.functions import session
from boxloom.operators import curation as C
from boxloom.operators import decisions as D
from boxloom.operators import dedup as U
from boxloom.operators import matching as M
from boxloom.operators import metrics as K
from boxloom.operators import near as N
from boxloom.plans import fixtures
from boxloom.sources import files, sinks
from boxloom.streaming import incremental

BOX = "image_id int, box_idx int, cls int, x1 double, y1 double, x2 double, y2 double"
DET = "image_id int, det_idx int, cls int, conf double, x1 double, y1 double, x2 double, y2 double"


def test_rows_without_content_are_copies_of_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "a")], "k long, c string")
    assert sorted(map(tuple, U.exact_duplicates(rows, "k", "c").collect())) == [(1, 1, True), (2, 2, True), (3, 3, True), (4, 2, False)]


def test_numbered_names_are_free(spark):
    rows = spark.createDataFrame([(1, "a.txt"), (2, "a.txt"), (3, "a__1.txt"), (4, "a.txt"), (5, "b"), (6, "b"), (7, "a__1.txt"), (8, "c.x"), (9, "a__02.txt")], "k long, t string")
    got = {r.k: r.free_name for r in U.numbered_targets(rows, "k", "t", spark.createDataFrame([("c.x",), ("c__1.x",)], "name string")).collect()}
    assert got == {1: "a.txt", 2: "a__2.txt", 3: "a__1.txt", 4: "a__3.txt", 5: "b", 6: "b__1", 7: "a__1__1.txt", 8: "c__2.x", 9: "a__02.txt"}


def greedy(rows, within, known=()):
    """(key, reason) as one pass over the rows in order decides."""
    kept, shas, out = [h for _, h in known], {s for s, _ in known}, []
    for k, c, h in rows:
        if h is None:
            out.append((k, "corrupt_image"))
        elif c in shas:
            out.append((k, "exact_duplicate"))
        elif any(((h ^ x) & (2**64 - 1)).bit_count() <= within for x in kept):
            out.append((k, "near_duplicate"))
        else:
            out.append((k, "ok"))
            kept.append(h)
            shas.add(c)
    return out


def hashed(n, seed):
    rnd = random.Random(seed)
    base = [rnd.getrandbits(63) for _ in range(8)]
    rows = []
    for k in range(n):
        h = rnd.choice(base)
        for _ in range(rnd.choice([0, 1, 3, 6])):
            h ^= 1 << rnd.randrange(63)
        rows.append((k, f"c{h}", None if rnd.random() < 0.1 else h))
    return rows


def test_curated_in_one_pass_and_in_batches(spark, tmp_path):
    rows = hashed(120, 3)
    schema = "k long, c string, h long"
    assert sorted(map(tuple, U.curated(spark.createDataFrame(rows, schema), "k", "c", "h").select("k", "reason").collect())) == greedy(rows, 6)
    got, at = [], f"{tmp_path}/state"
    for part in (rows[:50], rows[50:]):
        batch = spark.createDataFrame(part, schema)
        once = sorted(map(tuple, incremental.curate_batch(batch, at, "k", "c", "h").collect()))
        assert sorted(map(tuple, incremental.curate_batch(batch, at, "k", "c", "h").collect())) == once  # run again
        got += once
    assert got == greedy(rows, 6)


@pytest.mark.parametrize("few", [0, U.FEW_PAIRS])
def test_keeping_few_or_many_pairs(spark, few):
    rnd = random.Random(7)
    want = sorted({tuple(sorted(rnd.sample(range(40), 2))) for _ in range(60)} | {(k, k + 1) for k in range(100, 130)})
    kept = []
    for k in [*range(40), *range(100, 131)]:
        if not any((j, k) in want for j in kept):
            kept.append(k)
    nodes = spark.createDataFrame([(k,) for k in [*range(40), *range(100, 131)]], "id long")
    pairs = spark.createDataFrame(want, "a long, b long")
    got = U.keep_greedily(nodes, pairs, "id", few=few).collect()
    assert sorted(r.id for r in got if r.kept) == kept and len(got) == 71
    with pytest.raises(ValueError):
        U.keep_greedily(nodes, pairs.union(spark.createDataFrame([(-5, 3)], "a long, b long")), "id", few=few)


def test_near_pairs_at_any_distance(spark):
    rnd = random.Random(5)
    base = rnd.getrandbits(64)
    hs = [base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(9))) for _ in range(60)]
    signed = [h - (1 << 64) if h >> 63 else h for h in hs]
    df = spark.createDataFrame(list(enumerate(signed)), "k int, h long")
    for within in (0, 3, 6, 9):
        want = {(i, j) for j in range(60) for i in range(j) if (hs[i] ^ hs[j]).bit_count() <= within}
        assert {(r.a, r.b) for r in U.near_pairs(df, "k", "h", within).collect()} == want


def _scattered(n, seed=11):
    """``n`` hashes with both signs: copies, near copies and others; as Spark and as Python see them."""
    rnd = random.Random(seed)
    bases = [rnd.getrandbits(64) for _ in range(12)]
    hs = [rnd.choice(bases) ^ sum(1 << b for b in rnd.sample(range(64), rnd.choice([0, 0, 3, 9, 15, 21]))) for _ in range(n)]
    return hs, [h - (1 << 64) if h >> 63 else h for h in hs]


def test_wide_pairs_are_compared_in_blocks(spark):
    hs, signed = _scattered(300)
    df = spark.createDataFrame([*enumerate(signed), (300, None)], "k int, h long")
    want = {(i, j, (hs[i] ^ hs[j]).bit_count()) for j in range(300) for i in range(j) if (hs[i] ^ hs[j]).bit_count() <= 18}
    pairs = U.near_pairs(df, "k", "h", 18)
    plan = pairs._jdf.queryExecution().toString()
    # 190 rows for each hash were taken for a small table and sent to all through the driver
    assert "FlatMapGroupsInArrow" in plan and "BroadcastHashJoin" not in plan
    assert sorted(tuple(r) for r in pairs.collect()) == sorted(want)
    distinct = df.select(F.col("h").alias("hash")).where("hash IS NOT NULL").distinct()
    links = sorted(tuple(sorted(r)) for r in N.all_near(distinct, 18, block=40).collect())
    each = sorted(set(signed))
    assert links == [(a, b) for i, a in enumerate(each) for b in each[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 18]
    assert U.near_pairs(df.where("false"), "k", "h", 18).count() == 0


@pytest.mark.parametrize("within", [6, 20])
def test_greedy_keeping_forms_no_pairs_at_wide_distances(spark, monkeypatch, within):
    hs, signed = _scattered(200, 12)
    df = spark.createDataFrame([*enumerate(signed), (200, None)], "k int, h long")
    kept, by = [], {}
    for k, h in enumerate(hs):
        met = [j for j in kept if (hs[j] ^ h).bit_count() <= within]
        by[k] = met[0] if met else None
        kept += [] if met else [k]
    if within == 20:  # pairs were 190 or 231 rows for each hash, and rows of a table of pairs
        monkeypatch.setattr(U, "near_pairs", None)
        monkeypatch.setattr(U, "near", None)
    assert sorted(r.k for r in U.kept_greedily(df, "k", "h", within).where("kept").collect()) == [*kept, 200]
    first = {h: k for k, h in reversed(list(enumerate(signed)))}
    reps = spark.createDataFrame([(k, h) for h, k in first.items()], "node int, hash long")
    for size in (30, 1000):
        got = {first[r.hash]: r.by if r.by is None else first[r.by] for r in N.decided(reps, within, size).collect()}
        assert got == {k: by[k] for k in first.values()}
    rows = df.select("k", F.col("h").cast("string").alias("content"), "h")
    reasons = {r.k: r.reason for r in U.curated(rows, "k", "content", "h", within).collect()}
    same = lambda k: any(signed[j] == signed[k] for j in kept if j < k)
    assert reasons == {k: "ok" if k in kept else "exact_duplicate" if same(k) else "near_duplicate" for k in by} | {200: "corrupt_image"}


def test_a_batch_that_runs_again_gives_its_rows_again(spark, tmp_path):
    at = f"{tmp_path}/state"
    one, two = (spark.createDataFrame(rows, "id long, c string") for rows in ([(1, "x"), (2, "x"), (3, None)], [(4, "x"), (5, "y")]))
    for _ in range(2):
        assert sorted(r.id for r in incremental.dedup_batch(one, at, "id", "c").collect()) == [1, 3]
    for _ in range(2):
        assert [r.id for r in incremental.dedup_batch(two, at, "id", "c").collect()] == [5]


def test_failures_of_the_sink_lose_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (2,)], "id long")
    work = lambda df: df.withColumn("status", F.lit("plated"))
    stored = []

    def broken(_):
        raise OSError("full")

    with pytest.raises(OSError):
        incremental.retry_failures(f"{tmp_path}/done", rows, "id", work, sink=broken)
    incremental.retry_failures(f"{tmp_path}/done", rows, "id", work, sink=lambda out: stored.extend(r.id for r in out.collect()))
    assert sorted(stored) == [1, 2]
    assert incremental.retry_failures(f"{tmp_path}/done", rows, "id", work).count() == 0


def test_average_precision_has_a_row_for_each_detection_not_for_each_threshold(spark, monkeypatch):
    rnd = random.Random(3)
    box = lambda: (x := rnd.randrange(30), y := rnd.randrange(30), x + rnd.randrange(5, 30), y + rnd.randrange(5, 30))
    gt = [(i, k, 0, *map(float, box())) for i in range(8) for k in range(i)]
    pred = []
    for i in range(9):
        near = [[v + rnd.randrange(-2, 3) for v in g[3:]] for g in gt if g[0] == i for _ in range(2)] + [box()]
        pred += [(i, k, 0, c, *map(float, b)) for k, (c, b) in enumerate(zip(sorted((rnd.randrange(6) / 6 for _ in near), reverse=True), near))]
    g, p = spark.createDataFrame(gt, BOX).repartition(3), spark.createDataFrame(pred, DET).repartition(3)
    flags = M.true_positives(g, p, K.IOU_STEPS).collect()
    got = M.hits(g, p, K.IOU_STEPS).collect()
    assert len(got) == len(pred)
    assert {(t, r.image_id, r.det_idx, r.conf, bool(r.hits >> k & 1)) for r in got for k, t in enumerate(K.IOU_STEPS)} == set(map(tuple, flags))
    want = {}
    for t in K.IOU_STEPS:
        tp = [r.tp for r in sorted((r for r in flags if r.threshold == t), key=lambda r: (-r.conf, r.image_id, r.det_idx))]
        precision = [sum(tp[: n + 1]) / (n + 1) for n in range(len(tp))]
        want[t] = (round(sum(max(precision[n:]) for n, x in enumerate(tp) if x) / len(gt), 9), sum(tp))
    monkeypatch.setattr(K, "true_positives", None)  # ten rows for each detection, kept three times
    many = [*K.IOU_STEPS, *[0.5 + k / 1000 for k in range(1, 60)]]
    for thresholds in (K.IOU_STEPS, many):
        ap = {r.threshold: (round(r.ap, 9), r.n_tp) for r in K.average_precision(g, p, thresholds).collect()}
        assert len(ap) == len(set(thresholds)) and {t: ap[t] for t in want} == want


def test_mean_average_precision_leaves_no_tables_of_detections(spark, monkeypatch):
    gt = spark.createDataFrame([(i, 0, 0, 0.0, 0.0, 10.0, 10.0) for i in range(40)], BOX)
    pred = spark.createDataFrame([(i, 0, 0, 1 - i / 99, 0.0, 0.0, 10.0, 5.0 + i % 6) for i in range(40)], DET)
    monkeypatch.setattr(K, "true_positives", None)
    there = set(os.listdir(session.shared_dir(spark)))
    got = K.mean_average_precision(gt, pred, [0.5, 0.75]).first()
    assert got.ap50 == 1.0 and 0.5 < got.ap < 1.0
    # tables of detections are deleted; what stays is a row for each range or threshold
    assert not [f for f in set(os.listdir(session.shared_dir(spark))) - there if f.startswith("boxloom-")]


def test_mean_average_precision_shuffles_lines_once(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, *range(60)]), rnd.randrange(1, 8), rnd.choice([None, *range(400)]), rnd.choice([None, *range(200)])) for _ in range(500)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    both = fixtures.by_image(spark, str(tmp_path))
    for got, view in zip(both, ("v_gt_px", "v_pred")):
        want = fixtures.table(spark, str(tmp_path), view)
        assert got.schema == want.schema and got.count() == want.count()
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # one table read by both sides, shuffled by the image; nothing is shuffled after that (three more before)
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    plan = M.hits(*both, K.IOU_STEPS)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert plan.count("Exchange") == plan.count("Exchange hashpartitioning(l_orderkey") == 2
    assert plan.count("Union") == 0


def test_average_precision_goes_from_block_to_block(spark, monkeypatch):
    rnd = random.Random(7)
    gt = [(i, 0, 0, 0.0, 0.0, 10.0, 10.0) for i in range(90)]
    pred = [(i, 0, 0, rnd.randrange(5) / 5, 0.0, 0.0, 10.0, rnd.uniform(3, 10)) for i in range(100)]
    g, p = spark.createDataFrame(gt, BOX), spark.createDataFrame(pred, DET)
    n, rows = len(gt), sorted(pred, key=lambda r: (-r[3], r[0]))
    for thresholds in ([0.5, 0.75, 0.99], [0.4 + k / 100 for k in range(59)]):
        want = {}
        for t in thresholds:
            tp = [r[0] < n and r[7] / 10 >= t for r in rows]
            precision = [sum(tp[: k + 1]) / (k + 1) for k in range(len(tp))]
            want[t] = (round(sum(max(precision[k:]) for k, x in enumerate(tp) if x) / n, 9), sum(tp))
        for block in (1, 7, 1 << 16):
            monkeypatch.setattr(K, "BLOCK", block)
            assert {r.threshold: (round(r.ap, 9), r.n_tp) for r in K.average_precision(g, p, thresholds, n).collect()} == want
    # what is kept of a detection is its bits: no confidence, image or index
    assert K._blocks(M.hits(g, p, [0.5]), 1).columns == ["range", "block", "n", "t0", "hits"]


def test_thresholds_without_hits_count(spark):
    gt = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 10.0, 10.0), (1, 1, 1, 50.0, 50.0, 60.0, 60.0)], BOX)
    pred = spark.createDataFrame([(1, 0, 0, 0.9, 0.0, 0.0, 10.0, 6.0), (1, 1, 0, 0.8, 50.0, 50.0, 60.0, 60.0)], DET)
    got = {r.threshold: (r.ap, r.n_tp) for r in K.average_precision(gt, pred, [0.5, 0.75, 0.99]).collect()}
    assert got == {0.5: (1.0, 2), 0.75: (0.25, 1), 0.99: (0.25, 1)}
    assert tuple(K.mean_average_precision(gt, pred, [0.5, 0.75]).first()) == (1.0, 0.625)
    assert {r.cls: (r.n_gt, r.ap) for r in K.class_average_precision(gt, pred).collect()} == {0: (1, 1.0), 1: (1, 0.0)}
    none = pred.where("false")
    assert [tuple(r) for r in K.average_precision(gt, none, [0.5]).collect()] == [(0.5, 0.0, 0)]


def test_percentiles_are_exact(spark):
    rnd = random.Random(2)
    for values in ([], [3.0], [rnd.choice([1.0, 2.5, 7.0]) for _ in range(200)], [rnd.random() * 255 for _ in range(1001)]):
        df = spark.createDataFrame([(v,) for v in [*values, -1.0]], "v double").repartition(3)
        got = {r.pct: r.v for r in C.percentiles(df, "v").collect()}
        for p, v in got.items():
            assert v is None if not values else abs(v - np.percentile(values, p)) < 1e-9


def test_pairs_of_images_and_labels(spark):
    images = spark.createDataFrame([("a",), ("b",), ("c",)], "stem string")
    labels = spark.createDataFrame([("a", True), ("b", False), ("z", True)], "stem string, nonempty boolean")
    assert {r.stem: r.outcome for r in C.gather_pairs(images, labels).collect()} == {"a": "valid", "b": "empty_label", "c": "missing_label"}
    there = C.labels_with_images(labels, images.withColumn("image", F.concat("stem", F.lit(".jpg"))))
    assert {r.stem: r.image for r in there.collect()} == {"a": "a.jpg", "b": "b.jpg", "z": None}
    assert tuple(C.classes_seen(spark.createDataFrame([], BOX)).first()) == ([], 1)


def test_samples(spark):
    rows = spark.createDataFrame([(k, k % 3) for k in range(100)], "image_id int, badness int")
    from boxloom.operators.matching import ranked_review

    got = sorted(ranked_review(rows, 20).collect(), key=lambda r: r.place)
    assert len(got) == 20 and [r.place for r in got] == list(range(20)) and sorted(r.sample_pos for r in got) == list(range(20))
    assert [(-r.badness, r.sample_pos) for r in got] == sorted((-r.badness, r.sample_pos) for r in got)
    crops = C.crops_to_review(rows.withColumn("bucket", F.col("badness")), "bucket", "image_id", 5).collect()
    assert len(crops) == 15


def test_detections_are_suppressed(spark):
    pred = spark.createDataFrame([(1, 0, 0, 0.9, 0.0, 0.0, 10.0, 10.0), (1, 1, 0, 0.8, 0.0, 0.0, 10.0, 9.0), (1, 2, 1, 0.7, 0.0, 0.0, 10.0, 10.0), (1, 3, 0, 0.1, 90.0, 90.0, 99.0, 99.0)], DET)
    assert [(r.det_idx, r.cls, r.conf) for r in D.suppress(pred).orderBy("det_idx").collect()] == [(0, 0, 0.9), (1, 1, 0.7)]
    assert D.suppress(pred, classes=False).count() == 1
    with pytest.raises(ValueError):
        D.batch_class(F.lit(1), "side")


def test_plate_recovery(spark):
    from boxloom.functions import labels as L

    images = spark.createDataFrame([(1, 100, 100), (2, 100, 100), (3, None, None)], "image_id int, width int, height int")
    lines = L.parse(spark.createDataFrame([(1, 0, " 0 .5 .5 .2 .2 "), (1, 1, "4 .1 .1 .1 .1"), (2, 0, "1 .5 .5 .2 .2"), (1, 2, "bad")], "image_id int, line_no int, line string"))
    pred = spark.createDataFrame([(1, 0, 0, 0.9, 10.0, 10.0, 20.0, 30.0), (2, 0, 0, 0.9, 10.0, 10.0, 10.0, 30.0), (2, 1, 1, 0.9, 10.0, 10.0, 20.0, 30.0)], DET)
    got = {r.image_id: (r.status, r.lines) for r in D.recover_plates(images, lines, pred).collect()}
    assert got == {1: ("recovered", ["0 .5 .5 .2 .2", "4 0.150000 0.200000 0.100000 0.200000"]), 2: ("rejected", []), 3: ("read_failed", [])}


def test_writers(spark, tmp_path):
    root = f"{tmp_path}/set"
    rows = spark.createDataFrame([("train", "a", "/i/a.jpg", "0 1"), ("val", "b", "/i/b.jpg", ""), ("train", "c", "/i/c.jpg", None)], "split string, stem string, image string, text string")
    assert {r.split: r.images for r in sinks.materialise_splits(rows, root).collect()} == {"train": 2, "val": 1}
    assert open(f"{root}/labels/train/a.txt").read() == "0 1" and os.path.getsize(f"{root}/labels/val/b.txt") == 0
    assert [r.value for r in spark.read.text(f"{root}/train.list").collect()] == ["/i/a.jpg", "/i/c.jpg"]
    assert not [n for _, _, names in os.walk(f"{root}/labels") for n in names if n.startswith(".")]
    merged = rows.select("stem", "image", "text", F.col("image").alias("name"), F.when(F.col("stem") == "b", "collision").otherwise("added").alias("outcome"))
    assert {r.outcome: r.n for r in sinks.merge_into(merged, f"{root}/m").collect()} == {"added": 2, "collision": 1}
    assert sorted(os.listdir(f"{root}/m/labels")) == ["a.txt", "c.txt"] and spark.read.parquet(f"{root}/m/images").count() == 2
    sinks.write_url_list(spark.createDataFrame([("b",), ("a",), ("b",)], "url string"), f"{root}/urls")
    assert [r.value for r in spark.read.text(f"{root}/urls").collect()] == ["a", "b"]
    sinks.append_record(rows.limit(1), f"{root}/rec")
    assert spark.read.json(f"{root}/rec").count() == 1
    sinks.write_splits(rows, f"{root}/t")
    assert spark.read.parquet(f"{root}/t").where("split = 'val'").count() == 1


def test_configuration_texts():
    assert sinks.data_yaml({}, "/d", {}) == "path: /d\nnc: 1\nnames: ['class_0']\n"
    assert sinks.data_yaml({1: "b"}, "/d", {"val": "v"}, as_list=False) == "path: /d\nval: v\nnc: 2\nnames:\n  0: class_0\n  1: b\n"
    assert sinks.classes_text(sinks.class_names([2], {0: "a"})) == "a\nclass_1\nclass_2\n"


def test_more_scans(spark, tmp_path):
    for name in ("x/images/a.jpg", "x/images_no_ocr/b.jpg", "y/c.png"):
        os.makedirs(os.path.dirname(f"{tmp_path}/{name}"), exist_ok=True)
        open(f"{tmp_path}/{name}", "wb").write(b"1")
    assert [r.name for r in files.source_images(spark, f"{tmp_path}/x").select("name").collect()] == ["a.jpg"]
    assert [r.name for r in files.source_images(spark, f"{tmp_path}/y").select("name").collect()] == ["c.png"]
    names = spark.createDataFrame([("a.png", "a"), ("a.jpg", "a"), ("b.gif", "b")], "name string, stem string")
    found = files.find_images(names, spark.createDataFrame([("a",), ("b",)], "stem string"))
    assert {r.stem: r.image for r in found.collect()} == {"a": "a.jpg", "b": None}
    open(f"{tmp_path}/n.txt", "w").write(" a \n\nb\na\n")
    assert sorted(r.name for r in files.name_records(spark, f"{tmp_path}/n.txt").collect()) == ["a", "b"]
    listed = files.sorted_images(spark, f"{tmp_path}/x", recursive=True)
    assert [r.name for r in listed.collect()] == ["a.jpg", "b.jpg"] and files.sorted_images(spark, f"{tmp_path}/x", 1, True).count() == 1
    assert files.count_images(spark, f"{tmp_path}/x", True) == 2
    open(f"{tmp_path}/u.txt", "w").write("http://b\nx\nhttp://a\nhttp://b\n")
    assert [r.url for r in files.urls(spark, f"{tmp_path}/u.txt").orderBy("line_no").collect()] == ["http://b", "http://a", "http://b"]


def test_size_of_images_from_their_headers(spark):
    import struct
    import zlib

    ihdr = b"IHDR" + struct.pack(">IIBBBBB", 7, 5, 8, 2, 0, 0, 0)
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + ihdr + struct.pack(">I", zlib.crc32(ihdr))
    jpg = b"\xff\xd8\xff\xe0\x00\x10" + b"0" * 14 + b"\xff\xc0\x00\x11\x08" + struct.pack(">HH", 9, 11) + b"\x03" + b"0" * 9
    bmp = b"BM" + b"\0" * 12 + struct.pack("<Iii", 40, 13, -6)
    gif = b"GIF89a" + struct.pack("<HH", 3, 4)
    webp = b"RIFF\0\0\0\0WEBPVP8X\x0a\0\0\0\0\0\0\0" + struct.pack("<I", 20 - 1)[:3] + struct.pack("<I", 30 - 1)[:3]
    tif = b"II*\0\x08\0\0\0" + struct.pack("<H", 2) + struct.pack("<HHII", 256, 4, 1, 40) + struct.pack("<HHII", 257, 3, 1, 50)
    rows = [(k, v) for k, v in enumerate([png, jpg, bmp, gif, webp, tif, b"", b"nothing", None, jpg[:20]])]
    got = files.image_sizes(spark.createDataFrame([(k, None if v is None else bytearray(v)) for k, v in rows], "image int, content binary"))
    assert [(r.width, r.height) for r in got.orderBy("image").collect()] == [(7, 5), (11, 9), (13, 6), (3, 4), (20, 30), (40, 50), (None, None), (None, None), (None, None), (None, None)]


def test_a_shared_folder_is_asked_for_on_a_cluster():
    from boxloom.functions import session

    class Conf:
        def get(self, *_):
            return None

    class Fake:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        session.shared_dir(Fake())


def test_numbers_are_written_as_python_writes_them(spark):
    from boxloom.functions.text import fixed

    rnd = random.Random(1)
    xs = [0.125, 0.375, 0.0, 1.0, 2.5, 1e-7, 5e-7, 1234567.5, 0.12345, 999.9999995] + [rnd.random() for _ in range(3000)] + [k / 64 for k in range(200)] + [k / 1e5 + 5e-6 for k in range(300)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", fixed(F.col("x"), 2).alias("two"), fixed(F.col("x"), 4).alias("four"), fixed(F.col("x"), 6).alias("six")).collect()
    assert [(r.two, r.four, r.six) for r in got] == [(f"{r.x:.2f}", f"{r.x:.4f}", f"{r.x:.6f}") for r in got]
