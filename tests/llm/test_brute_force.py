"""URL verdicts, shards, contamination, event logs and learned parts against plain Python, with odd rows."""

import collections
import itertools
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from boxloom.llm import chat, common, decontamination, pii, quality, sharding, suffix_dedup, url_filter
from tests.llm.test_operators import ODD, empty, frame

SF = "/root/testdata/sf0.01"


# ---- URLs ---------------------------------------------------------------------------------------------


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_for(host, path):
    best = None
    for action, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, action)
    return best


def spread(edges, seeds):
    scores = {h: url_filter.UNIT // len(seeds) for h in seeds}
    base = {h: url_filter.UNIT // len(seeds) * (100 - url_filter.DAMPING_PERCENT) // 100 for h in seeds}
    out = collections.Counter(a for a, _ in edges)
    for _ in range(url_filter.ROUNDS):
        new = collections.Counter(base)
        for a, b in edges:
            if scores.get(a):
                new[b] += scores[a] * url_filter.DAMPING_PERCENT // 100 // out[a]
        scores = {h: v for h, v in new.items() if v > 0}
    return scores


def judged(pages):
    parsed = [(k, *split_url(u), re.findall(url_filter.LINK, h or "")) for k, u, h in pages]
    edges = {(host, d) for _, host, _, links in parsed if host for d in (re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in links) if d != host}
    seeds = collections.defaultdict(set)
    for _, host, path, _ in parsed:
        if host and (r := rule_for(host, path)):
            seeds[r[1]].add(host)
    for _, d in edges:
        if r := rule_for(d, "/"):
            seeds[r[1]].add(d)
    trust, distrust = (spread(e, seeds[s]) if seeds[s] else {} for e, s in ((edges, "allow"), ({(b, a) for a, b in edges}, "block")))
    least = url_filter.MIN_SCORE // max(1, len(seeds["block"]))
    out = []
    for k, host, path, _ in parsed:
        r = rule_for(host, path)
        bad = bool(edges) and distrust.get(host, 0) > max(least, trust.get(host, 0))
        out.append((k, host, path, r and r[0], r[1] if r else "block" if bad else "allow"))
    return sorted(out, key=str)


def test_urls_against_plain_python(spark):
    rnd = random.Random(4)
    hosts = [f"h{k}.io" for k in range(12)] + ["a.net", "Example.NET", "x.example.net", "example.com", "b.org", "net", "ample.net"]
    url = lambda: f"http{rnd.choice(['', 's'])}://{rnd.choice(hosts)}{rnd.choice(['', '/', '/en/1', '/de/x?y', '/fr/#z', '?q=/en/'])}"
    pages = [(k, url(), " ".join(f'<a href="{url()}">' for _ in range(rnd.choice([0, 1, 3])))) for k in range(150)]
    pages += [(900, None, None), (901, "", ""), (902, "no scheme", "<a href='//a.net'>"), (903, "http://h1.io", "<a href=//a.net>" * 2000), *pages[:3], (None, "http://a.net", None)]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit(1), "fit": F.lit(2), "key": F.lit(3), "score": F.lit(4)})
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(docs).collect()), key=str)
    assert got == judged(pages)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_a_blocked_host_without_a_page_spreads_distrust(spark):
    pages = spark.createDataFrame([(1, "http://a.io/", "<a href=//b.net/x>"), (2, "http://c.io/", "")], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(pages).collect()} == {1: "block", 2: "allow"}


# ---- shards -------------------------------------------------------------------------------------------


def test_shards_against_plain_python(spark):
    rnd = random.Random(9)
    texts = ODD + ["same"] * 200 + ["x" * rnd.randint(1, 300) + str(k) for k in range(200)] + ["long" * 20_000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "same")] * 30 + [(5, "same")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("key", "item", "part", "bytes", "a", "own", "shard")})
    got = sharding.shard(docs, shards=6, part_rows=11).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in rows)
    of, slots = collections.defaultdict(set), collections.defaultdict(list)
    text = dict(enumerate(texts))
    for r in got:
        slots[r.shard].append(r.slot)
        of["same" if r.doc_id is None or text[r.doc_id] == "same" else text[r.doc_id] or ""].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(6))
    assert max(len(v) for k, v in of.items() if k != (ODD[5] or "")) == 1
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_shards_of_a_capacity(spark):
    rnd = random.Random(3)
    sizes = [rnd.randint(1, 60) for _ in range(120)] + [500]
    where = sharding.pack_into(sizes, 100)
    room, opened = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):  # the tightest room by a plain search
        fits = [(r, k) for k, r in enumerate(room) if r >= sizes[i]] if sizes[i] <= 100 else []
        k = min(fits)[1] if fits else len(room)
        if not fits:
            room.append(max(100, sizes[i]))
        room[k] -= sizes[i]
        opened[i] = k
    assert where == [opened[i] for i in range(len(sizes))]
    docs = frame(spark, ["y" * n + str(k) for k, n in enumerate(sizes)])
    got = sharding.shard(docs, bundles=64, capacity=2000).collect()
    per = collections.Counter()
    for r in got:
        per[r.shard] += r.size
    assert max(per.values()) <= 2000 and len(per) == max(per) + 1 and sum(per.values()) / 2000 <= len(per) <= 2 * sum(per.values()) / 2000 + 1


# ---- contamination ------------------------------------------------------------------------------------


def tokens_of(text):
    text = re.sub("([一-鿿぀-ヿ])", r" \1 ", text or "")
    return re.findall(r"[^\W_]+", text.lower())


def contaminated(docs, items, short):
    """All pairs of a text and an item whose aligned tokens overlap around a place where a mask fits both."""
    out = {}
    for d, t in docs:
        a = tokens_of(t)
        for i, u in items:
            b = tokens_of(u)
            masks = decontamination.masks_for(len(b)) if len(b) >= decontamination.MIN_ITEM else [tuple(range(len(b)))] if short and b else []
            for mask in masks:
                for q in range(len(b) - mask[-1]):
                    for p in range(len(a) - mask[-1]):
                        if all(a[p + k] == b[q + k] for k in mask):
                            run = best = equal = 0
                            for k in range(-decontamination.AROUND, decontamination.AROUND + 1):
                                inside = 0 <= p + k < len(a) and 0 <= q + k < len(b)
                                same = inside and a[p + k] == b[q + k]
                                run = max(0, run + 1) if same else max(0, run - 2) if inside else 0
                                best, equal = max(best, run), equal + same
                            if best >= min(decontamination.MIN_SCORE, -(-4 * len(b) // 5)) or 5 * equal >= 4 * len(b):
                                x = out.get((d, i), (0, 0))
                                out[d, i] = (max(x[0], best), max(x[1], equal))
    return {(d, i, *v) for (d, i), v in out.items()}


@pytest.mark.parametrize("short", [False, True])
def test_contamination_against_all_pairs(spark, short):
    rnd = random.Random(6)
    words = [f"w{k}" for k in range(60)]
    items = [" ".join(rnd.choice(words) for _ in range(n)) for n in (1, 2, 3, 5, 5, 6, 7, 9, 12, 20, 40, 90)] + [None, "", "日本語のテスト文です"]
    items.append(items[7])
    texts = [None, "", items[3], "x " + items[4].upper() + ", y", items[12 + 2]]
    for _ in range(60):
        t = [rnd.choice(words) for _ in range(rnd.choice([3, 30, 120]))]
        source = (rnd.choice(items) or "").split()
        source = [rnd.choice(words) if rnd.random() < 0.12 else w for w in source[rnd.randrange(len(source) // 2 + 1) :]]
        at = rnd.randrange(len(t))
        texts.append(" ".join(t[:at] + source + t[at:]))
    texts += texts[5:7]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumns({"seed": F.lit(1), "item": F.lit(2)})
    docs = frame(spark, texts).withColumns({"key": F.lit("k"), "x": F.lit(1), "map": F.lit(2), "item_tokens": F.lit(3)})
    got = {(r.doc_id, r.item_id, r.score, r.equal_tokens) for r in decontamination.overlaps(docs, bench, short_items=short).collect()}
    assert got == contaminated(list(enumerate(texts)), list(enumerate(items)), short)
    # copies and rows without a key
    again = docs.unionByName(docs).unionByName(docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    more = {(r.doc_id, r.item_id, r.score, r.equal_tokens) for r in decontamination.overlaps(again, bench, short_items=short).collect()}
    assert {r for r in more if r[0] is not None} == got and decontamination.overlaps(again, bench, short_items=short).count() == len(more)


def test_any_fifth_of_an_item_may_be_replaced(spark):
    """Against no masks at all: each text holds an item with floor(n / 5) tokens replaced."""
    rnd = random.Random(8)
    items, texts, want = [], [], set()
    for n in range(6, 21):
        item = [f"i{n}w{k}" for k in range(n)]
        every = [c for r in range(n // 5 + 1) for c in itertools.combinations(range(n), r)]
        for places in every if n < 12 else rnd.sample(every, 25):
            want.add((len(texts), n))
            around = [f"f{rnd.randrange(500)}" for _ in range(20)]
            texts.append(" ".join([*around[:10], *[f"x{k}" if k in places else w for k, w in enumerate(item)], *around[10:]]))
        items.append((n, " ".join(item)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for some in (bench, bench.where("item_id >= 12"), bench.where("item_id < 8")):
        ids = {r.item_id for r in some.collect()}
        got = {(r.doc_id, r.item_id) for r in decontamination.overlaps(frame(spark, texts), some).collect()}
        assert got == {(d, i) for d, i in want if i in ids}


def test_overlaps_are_scored_once_a_row(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    df = decontamination.overlaps(frame(spark, ["x a b c d e f g h"]), bench)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with") == 1 and [decontamination.map_size(n) for n in (1, 10**4, 10**9)] == [1 << 20, 1 << 22, 1 << 27]


def test_masks_are_laid_where_neighbours_are_known_only(spark):
    d = decontamination
    masks = [*d.MASKS, *d.FEW_MASKS, *map(d.whole, range(2, d.MIN_ITEM))]
    assert d.lead(d.whole(1)) is None and all(d.lead(m) in m and d.lead(m) + 1 in m for m in masks)
    bench = frame(spark, ["a b c d", "A-b", "e", None]).select(F.col("text"))
    assert d.benchmark_pairs(bench, "text").count() == 3


def test_statistics_are_computed_once_a_labelled_text(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(quality, "cut", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or common.cut(df))
    docs = frame(spark, [" ".join(f"w{k}" for k in range(30))] * 3)
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int")
    assert quality.labelled_stats(docs, labels, "doc_id", "text", 100).count() == 2
    once = docs.select(quality.stats(F.col("text")).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plans) == 1 and plans[0].count("regexp_replace") == once.count("regexp_replace")


# ---- event logs ---------------------------------------------------------------------------------------


def final_messages(log):
    """Turn by turn: what no later regenerate of an earlier turn drops, folded."""
    out, by = [], collections.defaultdict(list)
    for e in log:
        by[e[0]].append(e)
    for conv, events in by.items():
        last = None
        for turn in sorted({e[1] for e in events}):
            said = []
            for _, _, seq, kind, role, text in sorted(e for e in events if e[1] == turn):
                if last is not None and seq < last:
                    continue
                if kind == "regenerate":
                    said[-1:] = [[said[-1][0] if said else role, text]]
                    last = seq
                elif kind == "message" or not said:
                    said.append([role, text])
                elif kind == "edit":
                    said[-1][1] = text
                else:
                    said[-1][1] += text
            out += [(conv, turn, *m) for m in said]
    return sorted(out)


def test_event_logs_against_plain_python(spark):
    rnd = random.Random(8)
    log = []
    for conv in range(40):
        seqs = rnd.sample(range(100), 25)
        for k in range(25):
            kind = rnd.choice(["message", "delta", "delta", "edit", "regenerate"])
            log.append((conv, rnd.randrange(5), seqs[k], kind, rnd.choice(["user", "assistant"]), f"<{seqs[k]}>"))
    events = spark.createDataFrame(log, "conv_id long, turn long, seq long, kind string, role string, text string").withColumns({"formatted": F.lit(1), "mask_start": F.lit(2)})
    got = sorted((r.conv_id, r.turn, *m[:2]) for r in chat.reconstruct(events).collect() for m in chat.parse(r.formatted))
    assert got == final_messages(log)


def test_a_regenerated_turn_goes_when_an_earlier_one_is_regenerated(spark):
    log = [(1, 0, 0, "message", "assistant", "a"), (1, 1, 1, "message", "assistant", "b"), (1, 1, 4, "regenerate", "assistant", ""), (1, 0, 10, "regenerate", "assistant", "c"), (None, 0, None, "message", "user", "x" * 100_000), (None, 0, None, "regenerate", None, None)]
    events = spark.createDataFrame(log, "conv_id long, turn long, seq long, kind string, role string, text string")
    assert sorted(((r.conv_id, r.turn, *m[:2]) for r in chat.reconstruct(events).collect() for m in chat.parse(r.formatted)), key=str) == [(1, 0, "assistant", "c"), (None, 0, "user", "")]


# ---- dedup of long and hot texts ----------------------------------------------------------------------


def test_suffix_dedup_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 300)
    monkeypatch.setattr(suffix_dedup, "REMEMBERED", 3)
    rnd = random.Random(12)
    common_ = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    rows = [(k, "".join(rnd.choice("abcdefgh ") for _ in range(rnd.choice([10, 200, 900]))) + common_[rnd.randrange(200) :] + str(k)) for k in range(60)]
    rows += [(70, common_ * 3), (71, common_[5:]), (71, common_[5:]), (None, common_), (72, None), (73, "é" * 120), (3, "é" * 200)]
    first, want = {}, []
    for d, t in rows:
        for b in [(t or "").encode()] if d is not None else []:
            for i in range(len(b) - 49):
                first[b[i : i + 50]] = min(first.get(b[i : i + 50], d), d)
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49) if d is not None else ():
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        want.append((d, len(b), sum(gone), sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("key", "th", "raw", "low", "spans")})
    assert sorted((tuple(r)[:4] for r in suffix_dedup.digests(docs).collect()), key=str) == sorted(want, key=str)


# ---- what is learned ----------------------------------------------------------------------------------


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_rules_on_held_out_labels(spark):
    at = SF.replace("sf0.01", "sf0.1")
    docs, labels = (spark.read.parquet(f"{at}/{n}.parquet") for n in ("documents", "labels"))
    half = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(2))
    rules = quality.learn(docs, labels.where(half == 0))
    seen = quality.judge(docs.select("doc_id", "text").join(labels.where(half == 1).select("doc_id", "quality"), "doc_id"), rules).where(~F.col("base_failed"))
    n = seen.agg(F.count_if(F.expr("quality = 0")).alias("bad"), F.count_if(F.expr("quality = 0 AND NOT kept")).alias("caught"), F.count_if(F.expr("quality = 1")).alias("good"), F.count_if(F.expr("quality = 1 AND kept")).alias("left")).first()
    assert n.bad >= 50 and n.caught >= 0.9 * n.bad and n.left >= 0.99 * n.good


def secret(rnd):
    kind = rnd.randrange(3)
    hex_ = "".join(rnd.choice("0123456789abcdef") for _ in range(rnd.choice([32, 40, 64])))
    mixed = "".join(rnd.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz0123456789") for _ in range(36))
    return [f'token = "{hex_}"', f"api_key: {mixed}", f"secret={rnd.choice(['sk-', 'ghp_'])}{mixed}"][kind]


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_secrets_in_held_out_documents(spark):
    rnd = random.Random(21)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").where("text IS NOT NULL").orderBy("doc_id").limit(400).collect()]
    plain = [re.sub(r"[@0-9+]", "", t) for t in texts]
    hashes = ["commit " + "".join(rnd.choice("0123456789abcdef") for _ in range(40)) + " of version" for _ in range(40)]
    rows = []
    for k, t in enumerate(plain):
        at = rnd.randrange(len(t) + 1)
        added = secret(rnd) if k % 2 == 0 else hashes[k % 40] if k % 10 == 1 else ""
        rows.append(t[:at] + " " + added + " " + t[at:])
    train, held_out = texts[:200] + rows[:200], rows[200:]
    model = pii.train(common.written(pii.span_table(frame(spark, train), "doc_id", "text")))
    clean = {r.doc_id: r.text for r in pii.redact(frame(spark, held_out), model=model).collect()}
    caught = sum("[secret]" in clean[k] for k in range(0, 200, 2))
    left = sum(clean[k] == held_out[k] for k in range(1, 200, 2))
    assert caught >= 90 and left >= 95


def test_spans_of_names_and_streets(spark):
    texts = [f"please write to Dr. {n} {m} at {k} {s} Street in town" for k, (n, m, s) in enumerate([("John", "Miller", "Main"), ("Anna", "Weber", "High"), ("Mary", "Jones", "Church")] * 20)]
    texts += [f"the {k} Old Towns And Villages of the plain" for k in range(60)]
    got = pii.find(frame(spark, texts)).collect()
    assert sum("street" in r.spans and "name" in r.spans for r in got if r.doc_id < 60) >= 54
    assert sum("street" in r.spans for r in got if r.doc_id >= 60) <= 3
    assert all(r.n_spans == len(list(filter(None, r.spans.split(",")))) for r in got)
    assert pii.find(empty(frame(spark, texts))).count() == 0


def test_without_keeps_clashing_columns(spark):
    docs = spark.range(50).select("id", F.lit(1).alias("map_of_gone"), F.lit(2).alias("key"), F.lit(3).alias("doc"), F.lit(4).alias("held"), F.lit(5).alias("a.b"))
    got = common.without(docs, spark.range(10), "id")
    assert got.columns == docs.columns and sorted(r.id for r in got.collect()) == list(range(10, 50))


def test_intermediate_tables_can_be_deleted(spark, tmp_path):
    shelf = common.Shelf(spark)
    one, two = shelf.put(spark.range(3)), shelf.put(spark.range(4))
    three = common.written(spark.range(5))
    paths = [df.inputFiles()[0].removeprefix("file://") for df in (one, two, three)]
    shelf.clear(two)
    assert [os.path.exists(p) for p in paths] == [False, True, True] and two.count() == 4
    mine = common._WRITTEN[:]
    common._WRITTEN[:] = [p for p in mine if any(p in x for x in paths)]
    common.discard(spark)
    assert not any(os.path.exists(p) for p in paths) and common._WRITTEN == []
    common._WRITTEN[:] = [p for p in mine if not any(p in x for x in paths)]


def test_keys_of_any_length_are_candidates():
    rnd = random.Random(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for n in (16, 102, 200, 201, 5000, 300_000):
        key = "a1" + "".join(rnd.choice(letters) for _ in range(n - 2))
        text = f'token = "{key}" and more'
        found = [(a, b) for k, a, b, _ in pii.candidates(text, pii.base_spans(text)) if pii.KINDS[k] == "secret"]
        assert found == [(9, 9 + n)], n
    for text in ("a" * 300_000, "1" * 300_000, "a1" * 7, "-" * 100_000 + "x"):
        assert not [1 for k, *_ in pii.candidates(text, pii.base_spans(text)) if pii.KINDS[k] == "secret"]
