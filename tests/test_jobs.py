"""Composed jobs: triage, validation, relabelling, error reports, resume; captions; inference."""

import collections
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom import filters, jobs, reports
from boxloom.functions import glyphs, imaging
from boxloom.functions.session import cut_counted
from boxloom.sources import external
from tests.test_grown import put

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def picture(shade, height=40, width=60):
    return imaging.png(np.full((height, width, 3), shade, np.uint8))


def shade(content):
    """The shade of a picture of one shade; by its compressed size and bytes."""
    return next(s for s in range(0, 256, 10) for h, w in ((40, 60), *SIZES) if content == picture(s, h, w))


SIZES = [(20, 30), (32, 48), (10, 15), (8, 12), (26, 39)]


def csv(spark, path):
    return [r.asDict() for r in spark.read.option("header", True).csv(path).collect()]


# ---- triage -------------------------------------------------------------------------------------------


def sees_by_shade():
    """A large vehicle in light pictures, a small one in dark ones, none in black ones."""

    def model(batch):
        return [[(0.0, 0.0, 30.0, 30.0, 0.9, 2), (1.0, 1.0, 30.0, 30.0, 0.5, 2)] if c in (picture(200), picture(150), picture(250)) else [(0.0, 0.0, 3.0, 3.0, 0.9, 2)] if c == picture(50) else [(0.0, 0.0, 60.0, 40.0, 0.9, 0)] for c in batch]

    return model


def asked_by_shade():
    def ask(content):
        if content == picture(250):
            raise OSError("down")
        assert content in (picture(200), picture(150)), "only images with a vehicle are asked for"
        return '{"plates": [{"confidence": 0.2}, {"confidence": %s}]}' % (0.6 if content == picture(200) else 0.3)

    return ask


def test_triage(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(external.time, "sleep", lambda _: None)
    at = str(tmp_path)
    for name, s in (("clean.png", 200), ("noplate.PNG", 150), ("fail.png", 250), ("small.png", 50), ("none.png", 0)):
        put(f"{at}/i/{name}", picture(s))
    put(f"{at}/i/broken.jpg", b"no picture")
    got = filters.triage(spark, f"{at}/i", f"{at}/o", "tests.test_jobs:sees_by_shade", "tests.test_jobs:asked_by_shade", aside=True)
    assert {r.decision: r.n for r in got.collect()} == {"clean": 1, "no_plate": 1, "api_fail": 1, "no_vehicle": 2, "unreadable": 1}
    assert {r["image"]: r["decision"] for r in csv(spark, f"{at}/o/filter_log")} == {"clean.png": "clean", "noplate.PNG": "no_plate", "fail.png": "api_fail", "small.png": "no_vehicle", "none.png": "no_vehicle", "broken.jpg": "unreadable"}
    assert {d: sorted(os.listdir(f"{at}/o/{d}")) for d in ("clean", "no_plate", "no_vehicle")} == {"clean": ["clean.png"], "no_plate": ["noplate.PNG"], "no_vehicle": ["none.png", "small.png"]}
    assert len(os.listdir(f"{at}/i")) == 6 and not os.path.exists(f"{at}/o/api_fail")
    few = filters.triage(spark, f"{at}/i", f"{at}/p", "tests.test_jobs:sees_by_shade", "tests.test_jobs:asked_by_shade", limit=2)
    assert sum(r.n for r in few.collect()) == 2


# ---- validation ---------------------------------------------------------------------------------------


def plates_by_size():
    """A good plate in crops of 30 x 20, a bad one in those of 48 x 32, none in others."""

    def ask(content):
        width, height = int.from_bytes(content[16:20], "big"), int.from_bytes(content[20:24], "big")
        ocr = {(30, 20): 0.9, (48, 32): 0.5}.get((width, height))
        return '{"plates": []}' if ocr is None else '{"plates": [{"confidence": 0.9, "ocr_confidence": %s, "plate": "AB123"}]}' % ocr

    return ask


def test_validation_and_its_record(spark, tmp_path):
    at = str(tmp_path)
    good, bad, tiny, bare = "0 .5 .5 .5 .5", "0 .5 .5 .8 .8", "0 .5 .5 .01 .5", "0 .5 .5 .6 .6"
    for name, label in (("a.png", good), ("b.jpg", None), ("c.png", "x y"), ("d.png", f"{good}\n{tiny}"), ("e.png", f"{good}\n{bad}"), ("f.png", f"{bare}\n{good}"), ("g.png", good)):
        put(f"{at}/i/{name}", picture(100))
        if label is not None:
            put(f"{at}/l/{name[0]}.txt", label)
    put(f"{at}/i/g.png", b"broken")
    run = lambda: filters.validate(spark, f"{at}/i", f"{at}/l", f"{at}/o", "tests.test_jobs:plates_by_size", record=f"{at}/done", aside=True)
    want = {"ok": 1, "missing_label": 1, "empty_label": 1, "invalid_crop": 1, "plate_below_threshold": 1, "no_plate_detected": 1, "corrupt_image": 1}
    assert {r.reason: r.n for r in run().collect()} == want
    log = {r["image"]: (r["reason"], r["vehicle_id"], r["plate_confidence"], r["ocr_confidence"]) for r in csv(spark, f"{at}/o/removed")}
    assert log == {"b.jpg": ("missing_label", None, None, None), "c.png": ("empty_label", None, None, None), "d.png": ("invalid_crop", "1", None, None), "e.png": ("plate_below_threshold", "1", "0.9000", "0.5000"), "f.png": ("no_plate_detected", "0", "0.0000", "0.0000"), "g.png": ("corrupt_image", None, None, None)}
    assert sorted(os.listdir(f"{at}/o/removed_pairs/images")) == ["b.jpg", "c.png", "d.png", "e.png", "f.png", "g.png"]
    assert sorted(os.listdir(f"{at}/o/removed_pairs/labels")) == ["c.txt", "d.txt", "e.txt", "f.txt", "g.txt"]
    again = {r.reason: r.n for r in run().collect()}
    assert again == {k: v for k, v in want.items() if k != "ok"}  # what was accepted is not asked for again


# ---- relabelling --------------------------------------------------------------------------------------


def car_in_wide_crops():
    def model(batch):
        sizes = [(int.from_bytes(c[16:20], "big"), int.from_bytes(c[20:24], "big")) for c in batch]
        return [[(0, 0, 1, 1, 0.6, 7), (0, 0, 1, 1, 0.9, 2)] if w > h else [(0, 0, 1, 1, 0.8, 5), (0, 0, 1, 1, 0.1, 2)] if w < h else [(0, 0, 1, 1, 0.9, 0)] for w, h in sizes]

    return model


def test_relabelling(spark, tmp_path):
    at = str(tmp_path)
    put(f"{at}/i/a.JPG", imaging.png(np.zeros((100, 100, 3), np.uint8)))
    put(f"{at}/l/a.txt", "0 .5 .5 .1 .1\n2 .5 .5 .4 .2\n3 .5 .5 .2 .4\n2 .5 .5 .3 .3\n3 .5 .5 .01 .3\n4 .5 .5 .1 .1\n9 .5 .5 .1 .1\nbad\n")
    put(f"{at}/l/b.txt", "2 .5 .5 .4 .2\n")
    put(f"{at}/l/c.txt", "")
    got = filters.relabel(spark, f"{at}/i", f"{at}/l", f"{at}/o", "tests.test_jobs:car_in_wide_crops", crops_of_each=50)
    rows = {(r.how, r.why): r.boxes for r in got.collect()}
    assert rows == {("decided", "car"): 1, ("decided", "other"): 1, ("decided", None): 2, ("direct", "direct"): 2, ("direct", None): 2, ("fallback", "bad_crop"): 1, ("fallback", "no_detection"): 1, ("fallback", "no_image"): 1, ("fallback", None): 3, (None, None): 7}
    assert [line.split()[0] for line in open(f"{at}/o/labels/a.txt")] == ["0", "2", "5", "2", "3", "6"]
    assert open(f"{at}/o/labels/b.txt").read() == "2 0.500000 0.500000 0.400000 0.200000\n" and open(f"{at}/o/labels/c.txt").read() == ""
    log = sorted((r["stem"], r["old_class"], r["new_class"], r["coco_class"], r["conf"]) for r in csv(spark, f"{at}/o/decisions"))
    assert log == [("a", "2", "2", "car", "0.900"), ("a", "2", "2", "none", "0.000"), ("a", "3", "5", "bus", "0.800")]
    with pytest.raises(ValueError):
        filters.relabel(spark, f"{at}/i", f"{at}/l", f"{at}/o", "x:y", fallback="bus")


# ---- reports ------------------------------------------------------------------------------------------


@pytest.fixture()
def judged(spark, tmp_path):
    at = str(tmp_path)
    for name, label in (("a", "4 .5 .5 .5 .5\n0 .2 .2 .2 .2"), ("b", "4 .5 .5 .5 .5"), ("c", "4 .5 .5 .5 .5"), ("d", "")):
        put(f"{at}/i/{name}.png", picture(0, 400, 600))
        put(f"{at}/l/{name}.txt", label)
    full = (150.0, 100.0, 450.0, 300.0)
    pred = [("a", 60.0, 40.0, 180.0, 120.0, 0.9, 0), ("b", *full, 0.95, 4), ("c", 150.0, 100.0, 450.0, 190.0, 0.7, 4), ("c", 0.0, 0.0, 20.0, 20.0, 0.6, 4), ("d", *full, 0.8, 4)]
    spark.createDataFrame(pred, "image_id string, x1 double, y1 double, x2 double, y2 double, conf double, cls int").write.parquet(f"{at}/pred")
    return at, {"images": f"{at}/i", "labels": f"{at}/l", "detections": f"{at}/pred"}


def test_reports_of_errors(spark, judged):
    at, where = judged
    names = {0: "bike_front", 4: "reg_plate"}
    worst = reports.plate_errors(spark, out=f"{at}/p", names=names, split_by_type=True, **where)
    assert [(r.image_id, r.badness) for r in worst.collect()] == [("a", 3), ("c", 3), ("d", 2)]
    assert [(r["image"], r["badness"], r["missed"], r["spurious"], r["loose_box"]) for r in csv(spark, f"{at}/p/plate_errors")] == [("a.png", "3.0", "1", "0", "0"), ("c.png", "3.0", "0", "1", "1"), ("d.png", "2.0", "0", "1", "0")]
    totals = {r["what"]: (int(r["n"]), r["pct"]) for r in csv(spark, f"{at}/p/totals")}
    assert totals["gt_plates"] == (3, None) and totals["missed"] == (1, "33.33") and totals["with_error"] == (3, None) and totals["spurious"] == (2, "66.67")
    assert sorted(os.listdir(f"{at}/p/overlays/spurious")) == ["002.0_m0_s1_l0_w0_d.png", "003.0_m0_s1_l1_w0_c.png"] and os.listdir(f"{at}/p/overlays/missed") == ["003.0_m1_s0_l0_w0_a.png"]
    x = spark.read.format("image").load(f"{at}/p/overlays/missed/003.0_m1_s0_l0_w0_a.png").select("image.*").first()
    x = np.frombuffer(bytes(x.data), np.uint8).reshape(x.height, x.width, 3)
    assert (x[200, 150] == imaging.COLOURS["gt"]).all() and (x[80, 60] == imaging.COLOURS["other"]).all()
    line = glyphs.mask("gt reg_plate")  # the caption, letter by letter, on a bar above its box
    bar = x[100 - glyphs.EDGE - glyphs.HEIGHT : 100 - glyphs.EDGE, 150 + glyphs.EDGE : 150 + glyphs.EDGE + line.shape[1]]
    assert ((bar == imaging.COLOURS["gt"]).all(2) != line).all()
    reports.bad_predictions(spark, out=f"{at}/b", names=names, **where)
    assert [r["image"] for r in csv(spark, f"{at}/b/bad_predictions")] == ["c.png", "a.png", "d.png"] and sorted(os.listdir(f"{at}/b/overlays")) == ["a.png", "c.png", "d.png"] == sorted(os.listdir(f"{at}/b/images"))
    reports.review(spark, out=f"{at}/r", names=names, **where)
    assert os.listdir(f"{at}/r/good") == ["b.png"] and len(os.listdir(f"{at}/r/bad")) == 3 and len(csv(spark, f"{at}/r/review_sample")) == 4
    rows = {r.name: (r.boxes, r.images) for r in reports.distribution(spark, where["labels"], 2).collect()}
    assert rows["TOTAL"] == (4, 4) and rows["reg_plate"] == (3, 3)
    jobs.draw(spark, where["images"], where["labels"], f"{at}/d", captions=True, names=names)
    assert len(os.listdir(f"{at}/d")) == 4


def two_boxes():
    return lambda batch: [[(5.0, 5.0, 50.0, 50.0, 0.9, 1), (5.0, 5.0, 50.0, 51.0, 0.8, 1)] for _ in batch]


def test_drawing_what_a_model_finds_in_a_sample(spark, judged):
    at, where = judged
    got = reports.infer_draw(spark, where["images"], f"{at}/o", "tests.test_jobs:two_boxes", sample=3)
    assert [tuple(r) for r in got.collect()] == [(1, 3)] and len(os.listdir(f"{at}/o")) == 3


def test_captions_are_cut_off_at_the_edges():
    for x, y in ((0, 0), (58, 2), (-5, 39), (30, 100)):
        image = np.zeros((40, 60, 3), np.uint8)
        glyphs.caption(image, x, y, "plate 0.95 %é", (0, 255, 0))
    glyphs.caption(image, 0, 20, "", (0, 255, 0))
    assert glyphs.mask("").shape == (7, 0) and glyphs.mask("a").shape == (7, 5) and glyphs.mask("ab", 2).shape == (14, 22) and (glyphs.mask("é") == glyphs.mask("?")).all()
    assert (glyphs.mask("1").sum(), glyphs.mask("x").sum()) == (10, 13) and len(glyphs.ROWS) < 200


# ---- going on where a job broke off -------------------------------------------------------------------


def test_duplicates_of_earlier_runs(spark, tmp_path):
    at = str(tmp_path)
    rnd = np.random.default_rng(3)
    one, two = (imaging.png(rnd.integers(0, 255, (64, 64, 3)).astype(np.uint8)) for _ in range(2))
    put(f"{at}/i/b.png", one)
    put(f"{at}/j/a.png", one)
    put(f"{at}/j/c.png", two)
    count = lambda folder: {r.reason: r.n for r in jobs.remove_duplicates(spark, f"{at}/{folder}", f"{at}/o", state=f"{at}/s").collect()}
    assert count("i") == {"ok": 1} and count("j") == {"ok": 1, "exact_duplicate": 1} and count("j") == {"ok": 1, "exact_duplicate": 1} and count("i") == {"ok": 1}
    assert {r["name"]: r["reason"] for r in csv(spark, f"{at}/o")} == {"b.png": "ok"}


def test_duplicates_go_on_from_records(spark, tmp_path):
    import hashlib

    at, rnd = str(tmp_path), np.random.default_rng(5)
    images = {n: rnd.integers(0, 255, (64, 64, 3)).astype(np.uint8) for n in "ab"}
    for n, x in images.items():
        put(f"{at}/i/{n}.png", imaging.png(x))
    put(f"{at}/i/c.png", imaging.png(np.clip(images["a"].astype(int) + 1, 0, 255).astype(np.uint8)))
    h = imaging.phash_of(imaging.luma(images["a"].tobytes(), 64, 64, 3)) % 2**64
    put(f"{at}/r.json", '{"name":"old.png","sha":"%s","phash":%d}\n{"name":"broken"\n' % (hashlib.sha256(b"else").hexdigest(), h))
    for _ in range(2):
        got = jobs.remove_duplicates(spark, f"{at}/i", f"{at}/o", state=f"{at}/s", records=f"{at}/r.json")
        assert {r.reason: r.n for r in got.collect()} == {"near_duplicate": 2, "ok": 1}


def fails_on_b():
    def ask(content):
        if content.endswith(b"b") and not os.path.exists("/tmp/boxloom-service-is-up"):
            raise OSError("down")
        return '{"plates":[{"confidence":0.9,"ocr_confidence":0.9,"plate":"AB123","bbox":[20,20,40,30]}]}'

    return ask


def test_plates_go_on_where_they_broke_off(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(external.time, "sleep", lambda _: None)
    at = str(tmp_path)
    head = b"\x89PNG\r\n\x1a\n\0\0\0\x0dIHDR" + (100).to_bytes(4, "big") * 2 + b"\x08\x02\0\0\0" + bytes(4)
    for name in "ab":
        put(f"{at}/i/{name}.png", head + name.encode())
        put(f"{at}/l/{name}.txt", "1 .5 .5 .2 .2")
    run = lambda: {r.status: r.n for r in jobs.add_plates(spark, f"{at}/i", f"{at}/l", "tests.test_jobs:fails_on_b", f"{at}/done").collect()}
    assert run() == {"plated": 1, "api_fail": 1} and run() == {"api_fail": 1}
    try:
        open("/tmp/boxloom-service-is-up", "w").close()
        assert run() == {"plated": 1} and run() == {}
    finally:
        os.remove("/tmp/boxloom-service-is-up")
    assert open(f"{at}/l/b.txt").read() == "1 .5 .5 .2 .2\n4 0.300000 0.250000 0.200000 0.100000"


def test_brightness_applied(spark, tmp_path):
    at = str(tmp_path)
    for name, s in (("dark.png", 10), ("light.png", 200)):
        put(f"{at}/i/{name}", picture(s))
    put(f"{at}/i/no.png", b"x")
    jobs.brightness(spark, f"{at}/i", f"{at}/o", apply=True)
    assert os.listdir(f"{at}/o/too_dark") == ["dark.png"] and os.listdir(f"{at}/o/bright") == ["light.png"]


def test_counts_come_with_the_data(spark):
    df = spark.range(10).select(F.when(F.col("id") < 3, "a").otherwise("b").alias("x"))
    done, counts = cut_counted(df, "x", ("a", "b", "c"))
    assert counts == {"a": 3, "b": 7} and done.count() == 10


# ---- inference ----------------------------------------------------------------------------------------

LOADS = "/tmp/boxloom-test-loads"


def counting_model(device):
    with open(f"{LOADS}/{os.getpid()}-{device}", "a") as f:
        f.write("x")
    sizes = open(f"{LOADS}/sizes-{os.getpid()}", "a")

    def model(batch):
        sizes.write(f"{len(batch)} ")
        sizes.flush()
        if any(c == b"bad" for c in batch):
            raise RuntimeError("cannot see")
        return [[(0, 0, len(c), 1, 0.5, 1)] * (len(c) % 3) for c in batch]

    return model


def test_inference_batches_failures_and_loads(spark, tmp_path, monkeypatch):
    os.makedirs(LOADS, exist_ok=True)
    for n in os.listdir(LOADS):
        os.remove(f"{LOADS}/{n}")
    rows = [(k, bytearray(b"bad" if k in (7, 30) else b"x" * (k % 5))) for k in range(200)] + [(5, bytearray(b"xx"))]
    df = spark.createDataFrame(rows, "image int, content binary").repartition(2)
    for barrier in (False, True):
        with_conf = external.infer(df, counting_model, batch=16, barrier=barrier)
        got = with_conf.collect()
        assert len(got) == 201 and sorted(r.image for r in got if r.error) == [7, 30] and all(r.error == "RuntimeError: cannot see" for r in got if r.error)
        assert all(len(r.boxes) == (r.image % 5) % 3 for r in got if not r.error and r.image != 5)
    loads = [n for n in os.listdir(LOADS) if not n.startswith("sizes")]
    assert all(open(f"{LOADS}/{n}").read() == "x" for n in loads) and loads  # once for each worker, whatever it ran
    sizes = collections.Counter(s for n in os.listdir(LOADS) if n.startswith("sizes") for s in open(f"{LOADS}/{n}").read().split())
    assert sizes["16"] >= 20
    found = external.detect(df, counting_model, batch=16)
    assert found.where("image = 4").count() == 1 and found.where("image IN (7, 30)").count() == 0


CLUSTER = """
import sys
sys.path.insert(0, {here!r})
from pyspark.sql import SparkSession
from boxloom.sources import external
from tests import test_jobs
spark = (SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false").config("spark.executor.memory", "512m")
  .config("spark.worker.resource.gpu.amount", 2).config("spark.worker.resource.gpu.discoveryScript", {script!r}).config("spark.executor.resource.gpu.amount", 2).config("spark.task.resource.gpu.amount", 1).getOrCreate())
df = spark.createDataFrame([(k, bytearray(b"x")) for k in range(64)], "image int, content binary").repartition(4)
got = external.infer(df, test_jobs.counting_model, batch=8, profile=external.gpu_profile(1)).collect()
print("GOT", len(got))
"""


def test_a_model_is_loaded_once_a_device(tmp_path):
    os.makedirs(LOADS, exist_ok=True)
    for n in os.listdir(LOADS):
        os.remove(f"{LOADS}/{n}")
    script = f"{tmp_path}/gpus.sh"
    put(script, '#!/bin/sh\necho \'{"name": "gpu", "addresses": ["0", "1"]}\'\n')
    os.chmod(script, 0o755)
    env = os.environ | {"PYTHONPATH": HERE, "SPARK_LOCAL_IP": "127.0.0.1"}
    done = subprocess.run([sys.executable, "-c", CLUSTER.format(here=HERE, script=script)], env=env, capture_output=True, text=True, timeout=240, cwd=tmp_path)
    assert "GOT 64" in done.stdout, done.stderr[-3000:]
    devices = [n.split("-")[1] for n in os.listdir(LOADS) if not n.startswith("sizes")]
    assert set(devices) <= {"0", "1"} and devices and all(open(f"{LOADS}/{n}").read() == "x" for n in os.listdir(LOADS) if not n.startswith("sizes"))


def test_lines_of_label_files_are_numbered(spark, tmp_path):
    from boxloom.sources import files

    put(f"{tmp_path}/l/a.txt", "3 .1 .1 .1 .1\r\n\n1 .1 .1 .1 .1\r2 .1 .1 .1 .1\n")
    put(f"{tmp_path}/l/b.txt", "")
    assert [(r.line_no, r.cls) for r in files.boxes(spark, f"{tmp_path}/l").orderBy("line_no").collect()] == [(0, 3), (2, 1), (3, 2)]
    assert {r.stem for r in files.label_lines(spark, f"{tmp_path}/l").collect()} == {"a", "b"}
    put(f"{tmp_path}/u.txt", "".join(f"http://h/{k * 7919 % 1000:04d}\n" for k in range(1000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert [r.url for r in files.urls(spark, f"{tmp_path}/u.txt").orderBy("line_no").collect()] == [f"http://h/{k * 7919 % 1000:04d}" for k in range(1000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# ---- hashes, ranks, command line ----------------------------------------------------------------------


def slowly_resampled(rows, height, width):
    """Lanczos with reach 3 by its definition, weights of 22 bits, columns after rows, each rounded to bytes."""
    from math import pi, sin

    def weights(size, to, k):
        scale = size / to
        wide, centre = max(scale, 1.0), (k + 0.5) * scale
        low, high = max(0, int(centre - 3 * wide + 0.5)), min(size, int(centre + 3 * wide + 0.5))

        def value(x):
            return 0.0 if not -3 <= x < 3 else 1.0 if x == 0 else sin(pi * x) / (pi * x) * (sin(pi * x / 3) / (pi * x / 3))

        w = [value((i - centre + 0.5) / wide) for i in range(low, high)]
        return low, [int(v / sum(w) * 2**22 + (-0.5 if v < 0 else 0.5)) for v in w]

    def smaller(line, to):
        out = []
        for k in range(to):
            low, w = weights(len(line), to, k)
            out.append(max(0, min(255, (sum(a * b for a, b in zip(w, line[low:])) + 2**21) >> 22)))
        return out if len(line) != to else list(line)

    columns = list(zip(*[smaller(list(map(int, r)), width) for r in rows]))
    return [list(r) for r in zip(*[smaller(list(c), height) for c in columns])]


@pytest.mark.parametrize("height,width", [(97, 150), (32, 200), (10, 32), (20, 13)])
def test_resampling_equals_its_definition(height, width):
    x = np.random.default_rng(height).integers(0, 256, (height, width)).astype(np.uint8)
    assert imaging.resampled(x, 32, 32).tolist() == slowly_resampled(x, 32, 32)
    assert (imaging.resampled(np.full((height, width), 77, np.uint8), 32, 32) == 77).all()


def test_hash_bits_by_the_definition(spark):
    rnd = np.random.default_rng(9)
    smooth = np.cumsum(np.cumsum(rnd.integers(-3, 4, (90, 140, 3)), 0), 1)
    image = ((smooth - smooth.min()) * 255 // max(1, smooth.max() - smooth.min())).astype(np.uint8)
    gray = (image[:, :, 2].astype(int) * 19595 + image[:, :, 1].astype(int) * 38470 + image[:, :, 0].astype(int) * 7471 + 32768) >> 16
    small = np.array(slowly_resampled(gray, 32, 32), float)
    cos = np.array([[2 * np.cos(np.pi * u * (2 * n + 1) / 64) for n in range(32)] for u in range(8)])
    low = np.einsum("un,nm,vm->uv", cos, small, cos).ravel()
    want = sum(1 << (63 - k) for k, v in enumerate(low) if v > np.median(low))
    df = spark.createDataFrame([(bytearray(image.tobytes()), 90, 140, 3)], "data binary, height int, width int, channels int")
    assert df.select(imaging.phash("data", "height", "width", "channels").alias("h")).first().h % 2**64 == want


def test_ranks_of_a_hot_target(spark):
    from boxloom.operators import dedup as U

    moves = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "hot.jpg").otherwise(F.concat(F.lit("t"), F.col("id") % 7, F.lit(".jpg"))).alias("t")).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = U._placed(moves, "t", "k")
        spread = dealt.where("t = 'hot.jpg'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = [(r.t, r.k, r["_place"]) for r in dealt.collect()]
    by = collections.defaultdict(list)
    for t, k, place in got:
        by[t].append((k, place))
    assert all([p for _, p in sorted(v)] == list(range(len(v))) for v in by.values()) and len(got) == 3000
    assert spread > 1
    names = {r.k: r.free_name for r in U.numbered_targets(moves, "k", "t").collect()}
    assert names[1] == "hot.jpg" and names[2] == "hot__1.jpg" and len(set(names.values())) == 3000


def test_every_job_has_a_command():
    from boxloom import __main__ as cli

    parser = cli.parser()
    assert len(cli.JOBS) == 22
    args = parser.parse_args(["relabel", "--images", "i", "--labels", "l", "--out", "o", "--model", "m:f", "--fallback", "other", "--crops-of-each", "5"])
    assert (args.fallback, args.crops_of_each, args.pad) == ("other", 5, 0.15)
    args = parser.parse_args(["plate-errors", "--images", "i", "--labels", "l", "--detections", "d", "--out", "o", "--split-by-type", "--names", "4:reg_plate"])
    assert args.split_by_type and args.names == {4: "reg_plate"}
    args = parser.parse_args(["split", "--images", "i", "--labels", "l", "--out", "o", "--layout", "by_split", "--no-by-hash", "--link"])
    assert args.layout == "by_split" and not args.by_hash and args.link
