"""What grows from run to run: manifests, the index of hashes, merged data sets; and files that appear at commit only."""

import collections
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom import jobs
from boxloom.functions import imaging
from boxloom.operators import curation as C
from boxloom.operators import dedup as U
from boxloom.operators.hash_index import HashIndex
from boxloom.sources import dataset, files, filesets
from boxloom.sources.manifest import Conflict, Manifest
from boxloom.streaming import incremental

ROWS = "key long, sha string, hash long"


def put(path, text=b"x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def tree(root):
    return sorted(os.path.relpath(os.path.join(d, n), root) for d, _, names in os.walk(root) for n in names if not n.startswith("."))


# ---- manifests ----------------------------------------------------------------------------------------


def test_a_manifest_shows_what_was_committed(spark, tmp_path):
    at = Manifest(spark, f"{tmp_path}/m")
    one, two = (at.stage("a", spark.createDataFrame([(k,)], "x int")) for k in (1, 2))
    assert at.version() == 0 and at.read("a", "x int").collect() == []
    assert at.commit(0, {"a": one}) == 1
    with pytest.raises(Conflict):
        Manifest(spark, f"{tmp_path}/m").commit(0, {"a": two})
    assert [r.x for r in at.read("a", "x int").collect()] == [1] and at.vacuum() == 1
    two, other = at.stage("a", spark.createDataFrame([(2,)], "x int")), at.stage("b", spark.createDataFrame([(3, 4)], "x int, y int"), "x")
    assert at.commit(1, {"a": two, "b": other}) == 2 and tuple(at.read("b", "x int, y int").first()) == (3, 4)
    assert sorted(r.x for r in at.read("a", "x int").collect()) == [1, 2] and at.read("a", "x int", 1).count() == 1
    both = at.stage("a", at.read("a", "x int").coalesce(1))
    assert at.commit(2, {"a": both}, replaces=True) == 3 and at.folders("b") == [] and at.read("a", "x int").count() == 2
    assert at.unmarked("files") == [3] and not [n for n in os.listdir(f"{tmp_path}/m/log") if n.startswith(".") and not n.endswith(".crc")]
    at.mark(3, "files")
    assert at.unmarked("files") == []


# ---- the index of hashes ------------------------------------------------------------------------------


def some_hashes(n, seed, start=0):
    rnd = random.Random(seed)
    middles = [rnd.getrandbits(64) for _ in range(max(1, n // 6))]
    rows = []
    for k in range(start, start + n):
        h = rnd.choice(middles)
        for _ in range(rnd.choice([0, 0, 1, 2, 4, 7])):
            h ^= 1 << rnd.randrange(64)
        signed = h - 2**64 if h >= 2**63 else h
        rows.append((k, f"{signed}:{rnd.randrange(2)}", None if rnd.random() < 0.05 else signed))
    return rows


def greedily(rows, kept, within=6):
    """{key: reason}; ``kept`` (name, sha, hash) grows."""
    before, out = list(kept), {}
    for k, sha, h in sorted(rows, key=lambda r: r[0]):
        if h is None:
            out[k] = "corrupt_image"
        elif any(n == str(k) and s == sha for n, s, _ in before):
            out[k] = "ok"
        elif any(((h ^ x) & (2**64 - 1)).bit_count() <= within for _, _, x in kept):
            out[k] = "exact_duplicate" if any(s == sha for _, s, _ in kept) else "near_duplicate"
        else:
            out[k] = "ok"
            kept.append((str(k), sha, h))
    return out


def test_runs_of_the_index_decide_as_one_pass_does(spark, tmp_path):
    index, kept = HashIndex(spark, f"{tmp_path}/i", buckets=8), []
    for run in range(3):
        # the hashes of a run come from the middles of the run before, too
        rows = some_hashes(60, run // 2, start=100 * run) + some_hashes(20, 9, start=100 * run + 60)
        want = greedily(rows, kept)
        got = index.curate(spark.createDataFrame(rows, ROWS)).collect()
        assert {r.key: r.reason for r in got} == want
        names = {n for n, _, _ in kept}
        assert all((r.kept_by in names) if r.hash is not None else r.kept_by is None for r in got)
        assert all(r.kept_by == str(r.key) for r in got if r.reason == "ok")
        if run == 1:
            before = index.entries().count()
            assert index.compact() == index.manifest.version() and index.entries().count() == before
            assert len(index.manifest.folders("bands")) == 1
        again = HashIndex(spark, f"{tmp_path}/i").curate(spark.createDataFrame(rows, ROWS))  # run again
        assert {r.key: r.reason for r in again.collect()} == want
    assert sorted(map(tuple, index.entries().select("name", "sha", "hash").collect())) == sorted(kept)
    with pytest.raises(ValueError):
        HashIndex(spark, f"{tmp_path}/i", within=5)


def test_a_name_that_returns_keeps_what_it_stood_for(spark, tmp_path):
    def batch(*rows):
        df = spark.createDataFrame(list(rows), "k string, c string, h long")
        return {r.k: r.reason for r in incremental.curate_batch(df, f"{tmp_path}/s", "k", "c", "h").collect()}

    assert batch(("a", "AAA", 0)) == {"a": "ok"}
    assert batch(("a", "BBB", -1), ("b", "AAA", 0)) == {"a": "ok", "b": "exact_duplicate"}
    assert batch(("c", "BBB", -1)) == {"c": "exact_duplicate"}
    assert batch(("a", "AAA", 0), ("d", "CCC", 1)) == {"a": "ok", "d": "near_duplicate"}


def test_equal_hashes_are_members_and_never_pairs(spark, tmp_path):
    rows = spark.range(3000).select(F.col("id").alias("key"), F.col("id").cast("string").alias("sha"), F.lit(77).cast("long").alias("hash"))
    index = HashIndex(spark, f"{tmp_path}/i")
    got = index.curate(rows)
    assert collections.Counter((r.reason, r.kept_by) for r in got.collect()) == {("ok", "0"): 1, ("near_duplicate", "0"): 2999}
    bands = index.manifest.read("bands", "key long, hash long, bucket int")
    assert bands.count() == 84 and bands.select("hash").distinct().count() == 1
    table = rows.select("key", F.col("sha").alias("c"), "hash")
    assert U.curated(table, "key", "c", "hash").groupBy("reason").count().count() == 2


def test_a_batch_reads_the_folders_that_its_keys_name(spark, tmp_path):
    index = HashIndex(spark, f"{tmp_path}/i", buckets=128)
    index.curate(spark.createDataFrame(some_hashes(200, 1), ROWS))
    one = spark.createDataFrame([(5000, "x", 123456789)], ROWS)
    asked = index._only(index.manifest.read("bands", "key long, hash long, bucket int"), index.decide(one).select(F.explode(F.array(*[F.lit(k) for k in (3, 7)])).alias("bucket")))
    assert "PartitionFilters: [bucket" in asked._jdf.queryExecution().toString() and asked.rdd.getNumPartitions() <= 8


def test_two_runs_at_once_never_both_commit(spark, tmp_path):
    one, two = HashIndex(spark, f"{tmp_path}/i"), HashIndex(spark, f"{tmp_path}/i")
    a, b = ([(1, "s", 5)], [(2, "t", 4)])
    decided = [x.decide(spark.createDataFrame(r, ROWS), 0) for x, r in ((one, a), (two, b))]
    assert one.add(decided[0], 0) == 1
    with pytest.raises(Conflict):
        two.add(decided[1], 0)
    assert [r.reason for r in two.curate(spark.createDataFrame(b, ROWS)).collect()] == ["near_duplicate"]


# ---- merged data sets ---------------------------------------------------------------------------------


def source(root, **labels):
    for name, text in labels.items():
        stem, _, ext = name.rpartition("_")
        put(f"{root}/images/{stem}.{ext}", name)
        if text is not None:
            put(f"{root}/labels/{stem}.txt", text)
    return root


def outcomes(df):
    return {r.outcome: r.n for r in df.collect()}


def test_merges_collide_with_what_the_output_holds(spark, tmp_path):
    a = source(f"{tmp_path}/a", x_jpg="0 1 1 1 1", y_JPG="1 1 1 1 1", z_png="")
    b = source(f"{tmp_path}/b", x_png="9 9 9 9 9", w_Png="2 2 2 2 2", v_jpg=None)
    out = f"{tmp_path}/m"
    assert outcomes(jobs.merge(spark, [a], out)) == {"added": 2, "no_label": 1}
    assert outcomes(jobs.merge(spark, [f"{tmp_path}/nowhere", b], out)) == {"added": 1, "collision": 1, "no_label": 1}
    assert open(f"{out}/labels/x.txt").read() == "0 1 1 1 1" and sorted(os.listdir(f"{out}/labels")) == ["w.txt", "x.txt", "y.txt"]
    before, version = tree(out), Manifest(spark, f"{out}/_manifest").version()
    assert outcomes(jobs.merge(spark, [a, b], out)) == {"collision": 4, "no_label": 2}
    assert Manifest(spark, f"{out}/_manifest").version() == version == 2 and [x for x in tree(out) if "_manifest" not in x] == [x for x in before if "_manifest" not in x]
    held = dataset.Grown(spark, out).held()
    assert sorted((r.name, r.source) for r in held.collect()) == [("w.Png", b), ("x.jpg", a), ("y.JPG", a)]
    assert jobs.merge(spark, [f"{tmp_path}/nowhere"], out).collect() == []


def test_files_without_a_manifest_are_not_replaced(spark, tmp_path):
    out = f"{tmp_path}/m"
    put(f"{out}/labels/x.txt", "by hand")
    put(f"{out}/images/y.jpg")
    a = source(f"{tmp_path}/a", x_jpg="0 1 1 1 1", y_jpg="1 1 1 1 1", q_jpg="1 1 1 1 1")
    assert outcomes(jobs.merge(spark, [a], out, "link")) == {"added": 1, "collision": 2}
    assert open(f"{out}/labels/x.txt").read() == "by hand" and os.path.islink(f"{out}/images/q.jpg") and open(f"{out}/images/q.jpg").read() == "q_jpg"
    assert outcomes(jobs.merge(spark, [source(f"{tmp_path}/b", k_jpg="0 1 1 1 1")], out, "copy")) == {"added": 1}
    assert not os.path.islink(f"{out}/images/k.jpg") and open(f"{out}/images/k.jpg").read() == "k_jpg"


def test_a_merge_decides_anew_when_another_came_between(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/m"
    a, b = source(f"{tmp_path}/a", x_jpg="0 1 1 1 1"), source(f"{tmp_path}/b", x_jpg="2 2 2 2 2", y_jpg="2 2 2 2 2")
    real, other = Manifest.commit, []

    def commit(self, base, adds, **how):
        if not other:
            other.append(1)
            assert outcomes(jobs.merge(spark, [a], out)) == {"added": 1}
        return real(self, base, adds, **how)

    monkeypatch.setattr(Manifest, "commit", commit)
    assert outcomes(jobs.merge(spark, [b], out)) == {"added": 1, "collision": 1}
    assert open(f"{out}/labels/x.txt").read() == "0 1 1 1 1" and open(f"{out}/labels/y.txt").read() == "2 2 2 2 2"


def test_files_of_a_commit_are_written_again_where_that_broke_off(spark, tmp_path, monkeypatch):
    out, a = f"{tmp_path}/m", source(f"{tmp_path}/a", x_jpg="0 1 1 1 1")
    with monkeypatch.context() as m:
        m.setattr(dataset, "save_files", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.merge(spark, [a], out)
    assert not os.path.exists(f"{out}/labels/x.txt")
    assert outcomes(jobs.merge(spark, [a], out)) == {"collision": 1} and open(f"{out}/labels/x.txt").read() == "0 1 1 1 1"


def test_rows_that_collide_do_not_stand_in_the_way(spark):
    rows = spark.createDataFrame([(0, "a.jpg", "a", True), (1, "a.png", "a", True), (2, "a.bmp", "a", True), (0, "b.jpg", "b", True), (0, "c.jpg", "c", None)], "rank int, name string, stem string, ok boolean")
    held = spark.createDataFrame([("a.jpg", None), (None, "b")], "name string, stem string")
    got = C.merge(rows, ["rank"], "stem", F.col("ok"), held, "name")
    assert {r.name: r.outcome for r in got.collect()} == {"a.jpg": "collision", "a.png": "added", "a.bmp": "collision", "b.jpg": "collision", "c.jpg": "no_label"}


# ---- splits -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("layout,link", [("by_kind", False), ("by_split", True)])
def test_a_trainer_finds_all_that_the_configuration_names(spark, tmp_path, layout, link):
    a = source(f"{tmp_path}/a", A_JPG="0 .5 .5 .1 .1", b_jpg="1 .5 .5 .1 .1", c_Png="1 .5 .5 .1 .1", d_png="")
    out = f"{tmp_path}/s"
    got = jobs.split(spark, f"{a}/images", f"{a}/labels", out, (0.67, 0.33, 0.0), names={0: "n", 1: "m"}, layout=layout, link=link)
    assert {r.split: r.images for r in got.collect()} == {"train": 2, "val": 0, "test": 1} or sum(r.images for r in got.collect()) == 3
    yaml = dict(line.split(": ", 1) for line in open(f"{out}/data.yaml").read().splitlines())
    seen = []
    for split in dataset.SPLITS:
        folder = os.path.join(yaml["path"], yaml[split])
        assert os.path.isdir(folder)
        listed = open(f"{out}/{split}.txt").read().split()
        names = sorted(n for n in os.listdir(folder) if n != ".keep")
        assert listed == sorted(f"{folder}/{n}" for n in names)
        for path in listed:
            label = os.path.splitext(path.replace("/images", "/labels", 1))[0] + ".txt"
            assert open(label).read() and os.path.islink(path) == link
            seen.append(open(path).read())
    assert sorted(seen) == ["A_JPG", "b_jpg", "c_Png"] and not [x for x in os.listdir(out) if x.startswith(".staging")]


def test_a_grown_data_set_can_be_split(spark, tmp_path):
    a = source(f"{tmp_path}/a", x_jpg="0 .5 .5 .1 .1", y_jpg="1 .5 .5 .1 .1")
    jobs.merge(spark, [a], f"{tmp_path}/m")
    jobs.split(spark, f"{tmp_path}/m", f"{tmp_path}/m/labels", f"{tmp_path}/s", (1.0, 0.0, 0.0))
    assert [n for n in sorted(os.listdir(f"{tmp_path}/s/images/train")) if n != ".keep"] == ["x.jpg", "y.jpg"]


def test_extensions_in_either_case(spark):
    names = spark.createDataFrame([("a.PNG", "a"), ("a.Jpg", "a"), ("a.JPG", "a"), ("b.GIF", "b")], "name string, stem string")
    found = files.find_images(names, names.select("stem").distinct())
    assert {r.stem: r.image for r in found.collect()} == {"a": "a.JPG", "b": None}


# ---- data sources -------------------------------------------------------------------------------------


def test_files_appear_at_commit_only(spark, tmp_path):
    at = f"{tmp_path}/o"
    put(f"{at}/old", "stays")
    bad = spark.range(40).repartition(4).select(F.concat(F.lit("d/"), F.col("id")).alias("name"), F.when(F.col("id") == 39, F.raise_error(F.lit("broken"))).otherwise(F.lit(b"1")).cast("binary").alias("content"))
    with pytest.raises(Exception, match="broken"):
        dataset.save_files(bad, at)
    assert os.listdir(at) == ["old"]
    dataset.save_files(bad.where("id < 39") if "id" in bad.columns else spark.range(39).select(F.concat(F.lit("d/"), F.col("id")).alias("name"), F.col("id").cast("string").cast("binary").alias("content")), at)
    assert len(os.listdir(f"{at}/d")) == 39 and open(f"{at}/d/7").read() == "7" and sorted(os.listdir(at)) == ["d", "old"]
    again = spark.createDataFrame([("d/7", bytearray(b"new"))], "name string, content binary")
    dataset.save_files(again, at)
    assert open(f"{at}/d/7").read() == "new"
    for name in ("../x", "/x", None):
        with pytest.raises(Exception, match="below"):
            dataset.save_files(spark.createDataFrame([(name, bytearray(b""))], "name string, content binary"), at)


def test_lines_become_one_file(spark, tmp_path):
    rows = spark.range(5000).select(F.format_string("%05d", F.lit(4999) - F.col("id")).alias("x")).repartition(7)
    dataset.save_lines(rows.orderBy("x"), f"{tmp_path}/l.txt")
    assert open(f"{tmp_path}/l.txt").read().split() == [f"{k:05d}" for k in range(5000)]
    dataset.save_lines(rows.where("false"), f"{tmp_path}/l.txt")
    assert open(f"{tmp_path}/l.txt").read() == "" and os.listdir(tmp_path) == ["l.txt"]


def make_client():
    def get(url):
        if url.endswith("7"):
            raise OSError("no")
        return url.encode()

    return get


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_each_address_is_fetched_once(spark, tmp_path, parts):
    urls = [f"http://h/{'x' * (k % 11)}{k}" for k in range(90)]
    put(f"{tmp_path}/u.txt", "\n".join(["no address", "", *urls]))
    filesets.register(spark)
    got = spark.read.format("fetched").option("urls", f"{tmp_path}/u.txt").option("client", "tests.test_grown:make_client").option("wait", 0).option("partitions", parts).load()
    rows = got.collect()
    assert sorted(r.url for r in rows) == sorted(urls)
    assert all((r.status, r.error) == (("error", "OSError: no") if r.url.endswith("7") else ("ok", None)) for r in rows)


def test_local_folders_are_refused_on_a_cluster(spark):
    class Cluster:
        _jvm, _jsc = spark._jvm, spark._jsc

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        filesets.reachable(Cluster(), "/data/out")
    assert filesets.reachable(spark, "/data/out") == "file:///data/out"


# ---- plates by crop -----------------------------------------------------------------------------------


def two_vehicles():
    return lambda batch: [[(2, 2, 22, 22, 0.9, 2), (30, 2, 58, 38, 0.8, 2), (5, 5, 5, 5, 0.7, 2)] for _ in batch]


def sees_white_only():
    """A plate in a crop of the right size whose pixels are white."""

    def ask(content):
        return '{"plates": [{"confidence": 0.95}]}' if content == imaging.png(np.full((36, 28, 3), 255, np.uint8)) else '{"plates": []}'

    return ask


def test_each_vehicle_is_asked_for_itself(spark, tmp_path):
    image = np.zeros((40, 60, 3), np.uint8)
    image[2:38, 30:58] = 255
    put(f"{tmp_path}/i/a.png", imaging.png(image))
    boxes = spark.createDataFrame([("a.png", 0, 2.0, 2.0, 22.0, 22.0), ("a.png", 1, 30.0, 2.0, 58.0, 38.0), ("a.png", 2, 5.0, 5.0, 5.0, 5.0)], "image_id string, det_idx int, x1 double, y1 double, x2 double, y2 double")
    got = jobs.plates_in_crops(spark, f"{tmp_path}/i", boxes, "tests.test_grown:sees_white_only")
    assert {r.det_idx: r.visible for r in got.collect()} == {0: False, 1: True, 2: False}
