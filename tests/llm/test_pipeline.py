"""Each stage of the pipeline against plain Python, on odd rows, clashing columns and an empty table."""

import base64
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from boxloom.llm import pii, quality
from tests.llm.test_brute_force import contaminated
from tests.llm.test_operators import brute_classes, word_stats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RND = random.Random(17)
WORDS = [f"word{k}" for k in range(900)]


def prose(n, marks=""):
    return " ".join(RND.choice(WORDS) + marks for _ in range(n))


ITEMS = [prose(30), prose(18), None, "", "only three words"]


def texts():
    out = [None, "", " ", "a b c", prose(25), prose(300), "x y z " * 30]
    out += [prose(60, "#$") for _ in range(40)] + [prose(60) for _ in range(80)]
    for _ in range(12):
        t = prose(120).split()
        for _ in range(3):
            out.append(" ".join(t))
            t[RND.randrange(len(t))] = "changed"
    out += [prose(30) + " " + ITEMS[0] + " " + prose(10), ITEMS[1] + " " + prose(20), prose(30) + " only three words " + prose(5)]
    out += [prose(30) + f" mail me{k}@example.org or 10.0.0.{k} " + prose(5) for k in range(10)]
    out.append(prose(20_000))
    return out + out[4:9]


ROWS = [(k, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts())] + [(None, prose(40), "en", "s", 1), (30, prose(40), "en", "s", 1)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    labels = [(k, int("#" not in (t or "")), 0) for k, t, *_ in ROWS if k is not None and k % 2 == 0] + [(2, None, 0), (None, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def docs_of(spark, rows=ROWS):
    more = {c: F.lit(1) for c in ("map_of_gone", "held", "doc", "key", "label", "sid", "s", "h", "kept", "base_failed", "component_id", "item_id", "quality_stats")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(more)


def untouched(got, but=()):
    """Whether the further columns are as ``docs_of`` made them."""
    more = [c for c in got.columns if c not in ("doc_id", "text", "lang", "source", "n_chars", *but)]
    return len(more) == 13 and got.where(" OR ".join(f"`{c}` <> 1" for c in more)).count() == 0


def test_quality_rules(spark, folder):
    docs = docs_of(spark)
    got = corpus_pipeline.quality_rules(spark, docs, folder)
    assert got.columns == docs.columns and untouched(got)
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)

    def passes(t):
        n, _, _, _, repeated = word_stats(t)
        return n >= quality.MIN_WORDS and 100 * repeated <= quality.MAX_REPEAT_PERCENT * n

    assert kept == sorted(((k, t) for k, t, *_ in ROWS if passes(t) and "#" not in t), key=str)


def test_near_duplicates(spark, folder):
    docs = docs_of(spark)
    got = corpus_pipeline.near_duplicates(spark, docs, folder)
    assert got.columns == docs.columns and untouched(got)
    classes = brute_classes([r[1] for r in ROWS])
    least = {}
    for (k, *_), (_, _, root) in zip(ROWS, classes):
        if k is not None:
            least[root] = min(least.get(root, k), k)
    gone = {k for (k, *_), (_, n, root) in zip(ROWS, classes) if k is not None and n and least[root] < k}
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted((str(k), str(t)) for k, t, *_ in ROWS if k not in gone)


def test_benchmark_leaks(spark, folder):
    docs = docs_of(spark)
    got = corpus_pipeline.benchmark_leaks(spark, docs, folder)
    assert got.columns == docs.columns and untouched(got)
    gone = {d for d, *_ in contaminated([r[:2] for r in ROWS], list(enumerate(ITEMS)), True)} - {None}
    assert gone and sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted((str(k), str(t)) for k, t, *_ in ROWS if k not in gone)


def test_private_data(spark, folder):
    docs = docs_of(spark)
    got = corpus_pipeline.private_data(spark, docs, folder)
    assert got.columns == docs.columns and untouched(got)
    clean = {(r.doc_id, r.text) for r in got.collect()}
    for k, t, *_ in ROWS:
        spans = sorted((a, b, kind) for kind, found in pii.base_spans(t or "").items() for a, b in found)
        want = t
        for a, b, kind in reversed(spans):
            want = want[:a] + f"[{kind}]" + want[b:]
        assert (k, want) in clean
    assert got.where("n_chars <> length(text)").count() == 0 and got.count() == len(ROWS)


def test_tokens(spark, folder):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = corpus_pipeline.tokens(spark, docs_of(spark), folder).collect()
    want = {(k, tuple(own.encode_ordinary(t or ""))) for k, t, *_ in ROWS}
    assert len(got) == len(ROWS) and {(r.doc_id, tuple(r.ids)) for r in got} == want


def test_all_stages_and_an_empty_table(spark, folder, tmp_path):
    out = corpus_pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, docs.where("false"), folder)
        assert nothing.count() == 0, name
        docs = stage(spark, docs, folder)
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect())) and 0 < out.count() < len(ROWS)
    assert not re.search("key", " ".join(out.columns))
