"""Spatial candidates, exact duplicates in a state store, functions in SQL, sub-totals."""

import collections
import os
import random

import pytest
from pyspark.sql import functions as F

from boxloom import sql
from boxloom.functions import geometry as G
from boxloom.functions import labels as L
from boxloom.functions import text as X
from boxloom.operators import decisions as D
from boxloom.operators import matching as M
from boxloom.operators import metrics as K
from boxloom.operators import spatial as S
from boxloom.streaming import exact

GT = "image_id int, box_idx int, cls int, x1 double, y1 double, x2 double, y2 double"
PRED = "image_id int, det_idx int, cls int, conf double, x1 double, y1 double, x2 double, y2 double"


def some_boxes(seed):
    rnd = random.Random(seed)

    def box():
        size = 2.0 ** rnd.uniform(-3, 8)
        x, y = rnd.choice([rnd.uniform(-50, 300), float(rnd.randrange(0, 257, 16))]), rnd.uniform(-50, 300)
        w, h = rnd.choice([(size, size), (size, size / 9), (16.0, 16.0), (0.0, size), (-3.0, 5.0)])
        return (x, y, x + w, y + h)

    gt = [(i, k, rnd.randrange(3), *box()) for i in range(4) for k in range((0, 3, 40, 90)[i])]
    pred = [(i, k, rnd.randrange(3), 1.0 - k / 200, *(box() if rnd.random() < 0.5 or not gt else [v + rnd.uniform(-2, 2) for v in rnd.choice(gt)[3:]])) for i in range(4) for k in range((2, 5, 40, 90)[i])]
    return gt, pred


@pytest.mark.parametrize("seed", [1, 2])
def test_cells_bring_all_overlapping_boxes_together_once(spark, seed):
    gt, pred = some_boxes(seed)
    got = S.overlapping(spark.createDataFrame(gt, GT), spark.createDataFrame(pred, PRED))
    want = [(g[0], g[1], p[1]) for g in gt for p in pred if g[0] == p[0] and min(g[5], p[6]) > max(g[3], p[4]) and min(g[6], p[7]) > max(g[4], p[5]) and g[5] > g[3] and g[6] > g[4] and p[6] > p[4] and p[7] > p[5]]
    assert sorted((r.image_id, r.a.box_idx, r.b.det_idx) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("few", [-1, 2000, S.FEW])
def test_boxes_of_calm_images_are_not_dealt_to_cells(spark, few):
    g, p = (spark.createDataFrame(rows, of) for rows, of in zip(some_boxes(5), (GT, PRED)))
    met = S.meeting(g, p, few=few)
    pairs = lambda df: sorted((r.image_id, r.a.box_idx, r.a.x1, r.b.det_idx, r.b.y2) for r in df.collect())
    assert pairs(met) == pairs(S.overlapping(g, p))
    assert ("Generate" in met._jdf.queryExecution().toString()) == (few < S.FEW)


@pytest.mark.parametrize("seed", [3, 4])
def test_crowded_images_are_matched_as_others_are(spark, seed):
    gt, pred = some_boxes(seed)
    g, p = spark.createDataFrame(gt, GT), spark.createDataFrame(pred, PRED)
    for match in (M.best_class, M.image_errors):
        calm, every, some = (sorted(map(tuple, match(g, p, 0.2, few=few).collect()), key=repr) for few in (10**9, -1, 2000))
        assert calm == every == some


def test_an_image_with_very_many_boxes_ends(spark):
    n = 20_000
    place = lambda c, by: (F.pmod(F.col(c), F.lit(200)) * 10.0 + by, F.floor(F.col(c) / 200) * 10.0 + by)

    def rows(c, by, *more):
        x, y = place(c, by)
        return spark.range(n).select(F.lit(1).alias("image_id"), F.col("id").cast("int").alias(c), (F.col("id") % 3).cast("int").alias("cls"), *more, x.alias("x1"), y.alias("y1"), (x + 9).alias("x2"), (y + 9).alias("y2"))

    rows_ = lambda c, by, *more: rows("id", by, *more).withColumnRenamed("id", c)
    gt, pred = rows_("box_idx", 0.0), rows_("det_idx", 1.0, F.lit(0.5).alias("conf"))
    got = M.image_errors(gt, pred).first()
    assert (got.n_gt, got.n_pred, got.true_pos, got.badness) == (n, n, n, 0)
    assert M.best_class(gt, pred).where("cls = pred_cls").count() == n


# ---- exact duplicates in a stream ---------------------------------------------------------------------


def test_a_stream_decides_as_a_batch_does(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(k, rnd.choice([None, "", *"abcdefgh", f"own {k}"])) for k in range(120)]
    rows += [(k, c) for k, c in rows[:10]]  # rows that come again
    parts = [rows[:40], rows[40:80], rows[80:]]
    at, got = str(tmp_path), []
    for k, part in enumerate(parts):
        spark.createDataFrame(part, "k long, c string").coalesce(1).write.mode("append").parquet(f"{at}/in")
        if k:  # two batches in the first run; then a restart for the third
            exact.dedup_new_files(spark, f"{at}/in", "k long, c string", f"{at}/checkpoint", f"{at}/out", "k", "c", files=1)
    got = [tuple(r) for r in spark.read.parquet(f"{at}/out").select("k", "sha", "kept").collect()]
    first = {}
    for k, c in rows:
        first.setdefault(c, k)
    want = [(k, None if c is None else c, c is None or first[c] == k) for k, c in rows]
    sha = {r.c: r.s for r in spark.createDataFrame([(c,) for c in {c for _, c in rows if c is not None}], "c string").select("c", F.sha2("c", 256).alias("s")).collect()}
    assert collections.Counter(got) == collections.Counter((k, sha.get(c), kept) for k, c, kept in want)
    # the state is RocksDB's, by key
    stores = [n for _, _, names in os.walk(f"{at}/checkpoint/state") for n in names]
    assert any(n.endswith((".zip", ".changelog")) for n in stores)
    before = len(got)
    exact.dedup_new_files(spark, f"{at}/in", "k long, c string", f"{at}/checkpoint", f"{at}/out", "k", "c")
    assert spark.read.parquet(f"{at}/out").count() == before  # nothing new


def test_the_least_key_of_a_batch_comes_first(spark, tmp_path):
    at = str(tmp_path)
    for rows in ([("m", "x"), ("c", "x"), ("z", "x"), ("c", "x")], [("a", "x"), ("c", "x"), (None, "x")]):
        spark.createDataFrame(rows, "k string, c string").coalesce(1).write.mode("append").parquet(f"{at}/in")
        exact.dedup_new_files(spark, f"{at}/in", "k string, c string", f"{at}/checkpoint", f"{at}/out", "k", "c")
    assert sorted((r.k, r.kept) for r in spark.read.parquet(f"{at}/out").collect()) == [("a", False), ("c", True), ("c", True), ("c", True), ("m", False), ("z", False)]


# ---- functions in SQL ---------------------------------------------------------------------------------


def test_functions_in_sql_say_what_columns_say(spark):
    sql.register(spark)
    rnd = random.Random(5)
    tokens = ["0", "1.9", "-0.5", "x", "nan", "inf", "1e400", "1_0", "_1", "1.", ".5", "+2", "3e9", "0x1", "٣", "1d", ""]
    texts = [None, "", "\n\n"] + ["".join(rnd.choice([" ", "\t", "  "]).join(rnd.choice(tokens if rnd.random() < 0.2 else ["0", "1.9", ".5", "1_0"]) for _ in range(rnd.choice([4, 5, 6]))) + rnd.choice(["\n", "\r\n", "\r"]) for _ in range(rnd.randrange(4))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = spark.sql("SELECT i, p.* FROM {df}, LATERAL parse_label(t) p", df=df)
    lines = df.select("i", F.posexplode(F.split("t", r"\r\n|\r|\n")).alias("line_no", "line"))
    want = L.parse(lines).where(L.strict()).select("i", "line_no", "cls", "cx", "cy", "w", "h")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 50
    boxes = spark.createDataFrame([tuple(rnd.choice([0.0, 1.0, 2.5, 4.0, -1.0]) for _ in range(8)) for _ in range(200)], ", ".join(f"{s}{c} double" for s in "ab" for c in ("x1", "y1", "x2", "y2")))
    both = boxes.select(*[F.struct(*[F.col(f"{s}{c}").alias(c) for c in ("x1", "y1", "x2", "y2")]).alias(s) for s in "ab"])
    assert both.select((F.expr("box_iou(a, b)") == G.iou(F.col("a"), F.col("b"))).alias("same")).where("NOT same").count() == 0
    v = spark.range(-5, 300).select((F.col("id") * 1.0).alias("v"), F.col("id"), (F.col("id") * 7919).alias("h"))
    assert v.where((F.expr("band_label(v)") != X.band_label(F.col("v"))) | (F.expr("hamming(id, h)") != G.hamming(F.col("id"), F.col("h")))).count() == 0


# ---- sub-totals ---------------------------------------------------------------------------------------


def test_totals_count_files_without_boxes(spark):
    boxes = spark.createDataFrame([(1, 0), (1, 0), (1, 2), (2, 2), (3, None)], "image_id int, cls int")
    files = spark.createDataFrame([(k,) for k in range(1, 6)], "image_id int")
    got = {(r.cls, r.is_total): (r.boxes, r.images) for r in K.class_totals(boxes, files).collect()}
    assert got == {(0, False): (2, 1), (2, False): (2, 2), (None, True): (4, 5)}


def test_reasons_of_fallbacks(spark):
    boxes = spark.createDataFrame([(1, 0, 2, 0.5, 0.5, 0.5, 0.5), (1, 1, 3, 0.5, 0.5, 0.5, 0.5), (1, 2, 2, 0.5, 0.5, 0.01, 0.5), (2, 0, 2, 0.5, 0.5, 0.5, 0.5), (2, 1, 0, 0.5, 0.5, 0.5, 0.5), (3, 0, 3, 0.5, 0.5, 0.5, 0.5), (1, 3, 9, 0.5, 0.5, 0.5, 0.5)], "image_id int, box_idx int, cls int, cx double, cy double, w double, h double")
    images = spark.createDataFrame([(1, 100, 100), (2, None, None)], "image_id int, width int, height int")
    decided = spark.createDataFrame([(1, 0, 2), (1, 1, 7)], "image_id int, box_idx int, best_cls int")
    states = D.crop_states(boxes, images)
    assert {(r.image_id, r.box_idx): r.crop for r in states.collect()} == {(1, 0): "ok", (1, 1): "ok", (1, 2): "bad_crop", (2, 0): "no_image", (3, 0): "no_image"}
    got = {(r.how, r.why, r.level): (r.boxes, r.files) for r in D.relabel_reasons(D.relabel(boxes.select("image_id", "box_idx", "cls"), decided), states).collect()}
    assert got == {("decided", "car", 0): (1, 1), ("decided", "other", 0): (1, 1), ("decided", None, 1): (2, 1), ("direct", "direct", 0): (1, 1), ("direct", None, 1): (1, 1), ("fallback", "bad_crop", 0): (1, 1), ("fallback", "no_image", 0): (2, 2), ("fallback", None, 1): (3, 3), (None, None, 3): (6, 3)}
