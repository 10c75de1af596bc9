"""Sources, sinks, pixels and incremental runs on small files."""

import os

import numpy as np
from pyspark.sql import functions as F

from boxloom.functions import imaging
from boxloom.sources import external, files, sinks
from boxloom.streaming import incremental


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def test_scans(spark, tmp_path):
    at = str(tmp_path)
    for n in ("a.JPG", "b.png", "c.txt"):
        put(f"{at}/i/{n}", b"x")
    put(f"{at}/l/a.txt", "0 .1 .2 .3 .4\r\nbad\n1 .1 .2 .3 .4 9\n")
    put(f"{at}/urls.txt", " http://b/1.jpg \nftp://x\nhttp://a/2.jpg\nhttp://b/1.jpg\n")
    put(f"{at}/rec.json", '{"name":"a","sha":"s","phash":18446744073709551615}\nbroken\n{"name":"a","sha":"t","phash":1}\n')
    put(f"{at}/t.csv", 'entry_image_url,x\n"http://q",1\n')
    assert sorted(r.name for r in files.images(spark, f"{at}/i").select("name").collect()) == ["a.JPG", "b.png"]
    assert [(r.stem, r.cls) for r in files.boxes(spark, f"{at}/l").orderBy("line_no").collect()] == [("a", 0), ("a", 1)]
    assert [r.url for r in files.url_list(spark, f"{at}/urls.txt").orderBy("line_no").collect()] == ["http://b/1.jpg", "http://a/2.jpg"]
    assert [tuple(r) for r in files.dedup_records(spark, f"{at}/rec.json").collect()] == [("a", "t", 1)]
    assert [tuple(r) for r in files.transactions(spark, f"{at}/t.csv").collect()] == [("http://q", None)]


def test_external_failures_become_statuses(spark):
    def make():
        def get(url):
            if "bad" in url:
                raise OSError("no")
            return b"" if "empty" in url else b"body"

        return get

    urls = spark.createDataFrame([("http://ok",), ("http://bad",), ("http://empty",)], "url string")
    got = {r.url: (r.status, r.error) for r in external.fetch(urls, make, wait=0, partitions=2).collect()}
    assert got == {"http://ok": ("ok", None), "http://bad": ("error", "OSError: no"), "http://empty": ("error", "empty body")}


def test_sinks(spark, tmp_path):
    assert sinks.data_yaml({0: "a", 2: "c"}, "/d", {"train": "t"}) == "path: /d\ntrain: t\nnc: 3\nnames: ['a', 'class_1', 'c']\n"
    boxes = spark.createDataFrame([(1, 1, 0, 0.5, 0.5, 0.25, 0.25), (1, 0, 2, 0.1, 0.1, 0.2, 0.2)], "image_id int, box_idx int, cls int, cx double, cy double, w double, h double")
    assert sinks.label_text(boxes).first().text.split("\n")[0] == "2 0.100000 0.100000 0.200000 0.200000"
    sinks.append_removals(spark.createDataFrame([("a", "no", None, 0.12345)], "image string, reason string, vehicle_id int, plate_confidence double"), f"{tmp_path}/log")
    assert spark.read.option("header", True).csv(f"{tmp_path}/log").first().plate_confidence == "0.1235"


def test_pixels(spark):
    flat = spark.createDataFrame([(bytearray(bytes([80]) * 64 * 48 * 3), 48, 64, 3), (None, None, None, None)], "data binary, height int, width int, channels int")
    got = flat.select(imaging.brightness("data", "height", "width", "channels").alias("b"), imaging.phash("data", "height", "width", "channels").alias("h")).collect()
    assert abs(got[0].b - 80) < 1e-6 and got[1].b == -1.0 and got[1].h is None
    x = np.random.default_rng(1).random((64, 64)) * 255
    assert (imaging.phash_of(x) ^ imaging.phash_of(x + 3)).bit_count() <= 2


def test_incremental(spark, tmp_path):
    at, seen = str(tmp_path), []

    def job(batch, _):
        seen.extend(r.id for r in incremental.dedup_batch(batch, f"{at}/state", "id", "c").collect())

    for k, rows in enumerate([[(1, "x"), (2, "x")], [(3, "x"), (4, "y")]]):
        spark.createDataFrame(rows, "id long, c string").coalesce(1).write.mode("append").parquet(f"{at}/in")
        incremental.run_new_files(spark, f"{at}/in", "id long, c string", f"{at}/cp", job)
    assert sorted(seen) == [1, 4]
    rows = spark.createDataFrame([(1,), (2,)], "id long")
    work = lambda df: df.withColumn("status", F.when(F.col("id") == 1, "api_fail").otherwise("plated"))
    assert incremental.retry_failures(f"{at}/done", rows, "id", work).count() == 2
    assert [r.id for r in incremental.retry_failures(f"{at}/done", rows, "id", work).collect()] == [1]


def png(width, height):
    return b"\x89PNG\r\n\x1a\n\0\0\0\x0dIHDR" + width.to_bytes(4, "big") + height.to_bytes(4, "big") + b"\x08\x02\0\0\0" + bytes(4)


def make_model():
    """Two vehicles in each image; the second is a copy that is suppressed."""
    return lambda batch: [[(10, 10, 60, 60, 0.9, 3), (10, 10, 60, 59, 0.8, 3), (0, 0, 3, 3, 0.7, 2)] for _ in batch]


def make_service():
    return lambda content: '{"plates":[{"confidence":0.9,"ocr_confidence":0.9,"plate":"AB123","bbox":[20,20,40,30]}]}'


def make_client():
    return lambda url: png(100, 100) if "good" in url else b""


def test_a_batch_from_addresses_to_metrics(spark, tmp_path, capsys, monkeypatch):
    from boxloom import __main__ as cli

    monkeypatch.syspath_prepend(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    at, here = str(tmp_path), "tests.test_sources"
    put(f"{at}/t.csv", "entry_image_url,exit_image_url\nhttp://h/good1.png,http://h/bad.png\nhttp://h/good2.png,none\n")
    cli.main(["add-dataset", "--name", "n", "--orientation", "back", "--base", at, "--merged", f"{at}/m", "--csv", f"{at}/t.csv", "--model", f"{here}:make_model", "--plates", f"{here}:make_service", "--client", f"{here}:make_client"])
    assert sorted(os.listdir(f"{at}/n_images")) == ["good1.png", "good2.png"]
    assert [r.error for r in spark.read.option("header", True).csv(f"{at}/n_images_failed").collect()] == ["empty body"]
    assert open(f"{at}/m/labels/good1.txt").read() == "1 0.350000 0.350000 0.500000 0.500000\n4 0.300000 0.250000 0.200000 0.100000"
    cli.main(["download", "--urls", f"{at}/n_urls", "--out", f"{at}/n_images", "--client", f"{here}:make_client"])  # only what failed
    assert "ok" not in capsys.readouterr().out.split("status|n")[-1]
    cli.main(["split", "--images", f"{at}/n_images", "--labels", f"{at}/m/labels", "--out", f"{at}/s", "--ratios", "0.5,0.5,0", "--names", "1:bike_back,4:reg_plate"])
    assert "names: ['class_0', 'bike_back', 'class_2', 'class_3', 'reg_plate']" in open(f"{at}/s/data.yaml").read()
    pred = spark.createDataFrame([("good1", 10.0, 10.0, 60.0, 60.0, 0.9, 1), ("good2", 10.0, 10.0, 60.0, 60.0, 0.8, 1)], "image_id string, x1 double, y1 double, x2 double, y2 double, conf double, cls int")
    pred.write.parquet(f"{at}/pred")
    where = ["--images", f"{at}/n_images", "--labels", f"{at}/m/labels", "--detections", f"{at}/pred"]
    for job in (["metrics", "--only", "1"], ["classification"], ["bad-predictions"], ["plate-errors"], ["review"]):
        cli.main([*job, *where])
    said = capsys.readouterr().out
    assert "|1.0 |1.0|2  |0  |0  |1.0      |1.0   |1.0|" in said
    cli.main(["distribution", "--labels", f"{at}/m/labels", "--version", "2"])
    assert "|1  |bike_back     |2    |2     |100.0    |" in capsys.readouterr().out
    cli.main(["merge", "--sources", f"{at}/n_dataset", f"{at}/n_dataset", "--out", f"{at}/again"])
    assert "collision|2" in capsys.readouterr().out


def test_services_and_models_give_rows(spark):
    rows = spark.createDataFrame([("a", bytearray(b"x"))], "image string, content binary")
    assert external.detect(rows, make_model).count() == 3
    got = external.ask_service(rows, make_service).first()
    assert got.api_error is None and "AB123" in got.payload


def make_plate_model():
    return lambda batch: [[(2, 2, 12, 8, 0.9, 0)] if len(c) < 2000 else [] for c in batch]


def test_pictures_with_outlines_and_crops(spark, tmp_path, capsys):
    from boxloom import __main__ as cli

    at = str(tmp_path)
    black = np.zeros((40, 60, 3), np.uint8)
    noise = np.random.default_rng(1).integers(0, 255, (40, 60, 3)).astype(np.uint8)
    put(f"{at}/i/a.png", imaging.png(black))
    put(f"{at}/i/b.png", imaging.png(noise))
    put(f"{at}/l/a.txt", "1 0.5 0.5 0.5 0.5\n4 .1 .1 .01 .01\n")
    back = spark.read.format("image").load(f"{at}/i").select("image.*").orderBy("origin").collect()
    assert bytes(back[1].data) == noise.tobytes() and (back[0].height, back[0].width) == (40, 60)
    cli.main(["draw", "--images", f"{at}/i", "--labels", f"{at}/l", "--out", f"{at}/d"])
    x = spark.read.format("image").load(f"{at}/d/a.png").select("image.data").first().data
    x = np.frombuffer(bytes(x), np.uint8).reshape(40, 60, 3)
    assert (x[10, 15:45] == (0, 255, 0)).all() and (x[20, 20] == 0).all() and sorted(os.listdir(f"{at}/d")) == ["a.png", "b.png"]
    cli.main(["crops", "--images", f"{at}/i", "--labels", f"{at}/l", "--out", f"{at}/c"])
    assert os.listdir(f"{at}/c/1") == ["a_0.png"] and not os.path.exists(f"{at}/c/4")
    cli.main(["recover-plates", "--images", f"{at}/i", "--labels", f"{at}/l", "--out", f"{at}/r", "--model", "tests.test_sources:make_plate_model"])
    assert open(f"{at}/r/recovered/labels/a.txt").read() == "1 0.5 0.5 0.5 0.5\n4 0.116667 0.125000 0.166667 0.150000\n"
    assert [r.value.rsplit("/", 1)[1] for r in spark.read.text(f"{at}/r/rejected.list").collect()] == ["b.png"]
    assert "recovered|1" in capsys.readouterr().out


def test_brightness_and_duplicates_of_a_folder(spark, tmp_path, capsys):
    from boxloom import __main__ as cli

    at = str(tmp_path)
    rnd = np.random.default_rng(3)
    one = rnd.integers(0, 255, (64, 64, 3)).astype(np.uint8)
    for name, x in (("a", one), ("b", one), ("c", np.clip(one.astype(int) + 2, 0, 255).astype(np.uint8)), ("d", rnd.integers(0, 30, (64, 64, 3)).astype(np.uint8))):
        put(f"{at}/i/{name}.png", imaging.png(x))
    put(f"{at}/i/e.png", b"no picture")
    cli.main(["remove-duplicates", "--images", f"{at}/i", "--out", f"{at}/dup"])
    got = {r.name[0]: r.reason for r in spark.read.option("header", True).csv(f"{at}/dup").collect()}
    assert got == {"a": "ok", "b": "exact_duplicate", "c": "near_duplicate", "d": "ok", "e": "corrupt_image"}
    cli.main(["brightness", "--images", f"{at}/i", "--out", f"{at}/br"])
    assert [r.name for r in spark.read.option("header", True).csv(f"{at}/br/dark").collect()] == ["d.png"]
    assert "band" in capsys.readouterr().out
