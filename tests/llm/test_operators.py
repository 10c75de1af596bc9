"""Each operator against a brute-force version, on texts with nulls, ties, repeats, long pieces and clashing columns."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from boxloom.llm import bpe, chat, components, decontamination, jaccard_join, pii, pretoken, quality, sharding, shingling, suffix_dedup, token_count, url_filter
from boxloom.llm.common import bitmap, let, may_hold, without

RND = random.Random(7)
ODD = [None, "", " \t\n", "a" * 3000, "!<|endoftext|> hi  <|endoftext|>", "x\x1cy \x85z q  ", "\U0001f600 ok \U0001e030", "日本語 テスト123", "²½Ⅷ a²", "'s't 're  'll", "\r\n\r\n  a", "aaaa" * 50]
ODD += ["".join(RND.choice("ab '\n\t .,sS1²é日\U0001f600  tdlre") for _ in range(RND.randint(0, 60))) for _ in range(200)]
ODD += ODD[:4]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def empty(df):
    return df.where("false")


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD).withColumn("key", F.lit("clash")).withColumn("pieces", F.lit(1)).withColumn("row", F.lit(2))


def test_bpe_equals_the_library(spark, odd):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in enumerate(ODD):
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.digests(odd).collect())) == want
    back = bpe.decode(bpe.encode(odd))
    assert back.columns == ["doc_id", "text", "key", "pieces", "row", "ids", "decoded"]
    assert back.where(F.coalesce("text", F.lit("")).cast("binary") != F.col("decoded")).count() == 0
    assert bpe.digests(empty(odd)).count() == 0


def test_bpe_merges_a_large_bucket_at_once(monkeypatch):
    own, put = bpe.codec(public_tokenizers.path(bpe.VOCABULARY)), []
    monkeypatch.setattr(bpe.RankQueue, "put", lambda self, rank, at: put.append(at))
    assert len(own.merger.merge([b"qzthe%dqz" % (i % 3) for i in range(1000)])) == 1000
    assert len(put) < 100


def test_bpe_merges_in_rank_order_whatever_the_vocabulary(monkeypatch):
    def plain(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while found := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[x] for x in parts]

    rnd = random.Random(3)
    for turn in range(150):
        letters = [b"a", b"b", b"c"][: 1 + turn % 3]
        # in no order of length: merges bring up pairs of lower ranks
        tokens = list({b"".join(rnd.choices(letters, k=rnd.randint(2, 5))) for _ in range(12)})
        rnd.shuffle(tokens)
        ranks = {bytes([i]): i for i in range(256)} | {t: 256 + i for i, t in enumerate(tokens)}
        texts = [b"".join(rnd.choices(letters, k=rnd.randint(1, 40))) for _ in range(40)]
        monkeypatch.setattr(bpe, "AT_ONCE", rnd.choice([1, 24, 1000]))
        assert [np.frombuffer(x, "<u4").tolist() for x in bpe.Merger(ranks).merge(texts)] == [plain(t, ranks) for t in texts]


def test_a_cache_has_all_new_pieces_of_a_batch_made_together():
    def alone(key):
        raise AssertionError(f"{key} is made by itself")

    cache = pretoken.TwoAges(alone, most=3)
    for keys in ("abcdef", "abcdef", "ghifedcba", "abcdefghi"):
        assert cache.all(list(keys), lambda new: {k: ord(k) for k in new}) == list(map(ord, keys))


def test_token_counts_equal_the_library(odd):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [(i, len((t or "").encode()), n := len(own.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in enumerate(ODD)]
    assert sorted(map(tuple, token_count.token_counts(odd).collect())) == want
    assert token_count.token_counts(empty(odd)).count() == 0


def word_stats(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = {k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside)


def test_quality_statistics_and_rules(spark):
    texts = ODD + ["a " * 8, "a " * 9, "x y z\n" * 40, "a b c d e f g h " * 3]
    got = frame(spark, texts).select("doc_id", quality.stats(F.col("text")).alias("s")).collect()
    assert {r.doc_id: tuple(r.s)[:5] for r in got} == {i: word_stats(t) for i, t in enumerate(texts)}
    words = [" ".join(f"w{RND.randint(0, 999)}{'#$' if i % 4 == 0 else ''}" for _ in range(60)) for i in range(400)]
    docs, labels = frame(spark, words), spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(400)], "doc_id long, quality int")
    rules = quality.learn(docs.where("doc_id < 300"), labels)
    held_out = quality.judge(docs.where("doc_id >= 300"), rules).join(labels, "doc_id")
    assert held_out.where(F.col("kept") != (F.col("quality") == 1)).count() == 0
    assert quality.learn(docs, empty(labels)).rules == ()
    assert quality.judge(empty(docs), rules).count() == 0


def test_url_filter(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.org/fr/1", '<a href="http://b.io/x"><a href="https://c.io">'), (2, "http://d.io/", '<a href="http://E.net/x">'), (3, "http://b.io/1", "<a href=//q.io/>"), (4, "http://e.NET/", ""), (5, None, None), (6, "x", "y"), (7, "http://Q.io", None), (8, "https://s.example.net/en/x?y", ""), (9, "http://example.com/de/#a", ""), (9, "http://net", "")],
        "page_id long, url string, html string",
    )
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()), key=str)
    want = [(1, "a.org", "/fr/1", "org/fr/", "allow"), (2, "d.io", "/", None, "block"), (3, "b.io", "/1", None, "allow"), (4, "e.net", "/", "net/", "block"), (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "q.io", "", None, "allow"), (8, "s.example.net", "/en/x", "example.net/en/", "allow"), (9, "example.com", "/de/", "example.com/de/", "block"), (9, "net", "", None, "allow")]
    assert got == sorted(want, key=str)
    assert url_filter.judge_urls(empty(pages)).count() == 0


@pytest.mark.parametrize("seeds", [2, 10_000])
def test_url_verdicts_do_not_fade_with_the_number_of_seeds(spark, seeds):
    linkers = [(k, f"http://l{k}.io/", "<a href=//b0.net/>") for k in range(20)]
    pages = linkers + [(100 + k, f"http://b{k}.net/", "") for k in range(seeds)] + [(50, "http://c.io/", "<a href=//l0.com/>")]
    got = url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).where("page_id < 100")
    assert {r.page_id: r.verdict for r in got.collect()} == {k: "block" for k in range(20)} | {50: "allow"}


def test_pii_base_spans(spark):
    texts = ODD + ["".join(RND.choice("aé.@-+%1 2()34\n_") for _ in range(RND.randint(0, 40))) for _ in range(1500)] + ["".join(RND.choice("1234567890. -+") for _ in range(RND.randint(0, 60))) for _ in range(1500)]
    texts += ["a@b.c%x@d.e", "1.2.3.4.5.6.7.8", "0001.2.3.4", "x" * 50000 + "@", "1" * 20000]
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    number = lambda s: re.sub("[^0-9]", "", s)
    holds = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")), "card": lambda s: 13 <= len(number(s)) <= 19 and pii.luhn(number(s)), "phone": lambda s: 9 <= len(number(s)) <= 15}

    def want(t):
        if len(t or "") > 10000:  # the plain pattern takes quadratic time here
            return (0,) * 4, ""
        found = {k: [m.span() for m in re.finditer(p, t or "") if holds[k](m[0])] for k, p in patterns.items()}
        return tuple(len(v) for v in found.values()), ",".join(f"{k}:{a}:{b}" for k, v in found.items() for a, b in v)

    for r in pii.find(frame(spark, texts)).collect():
        counts, said = want(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == counts and r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))
    assert pii.find(frame(spark, [])).count() == 0


def test_pii_model_on_held_out_spans(spark):
    def text(i, good):
        a, b, c = (RND.randint(200, 999) for _ in range(3))
        return f"please call ({a}) {b}-{c}{RND.randint(0, 9)} today" if good else f"order number {a} {b} {c}x section"

    texts = [text(i, i % 2 == 0) for i in range(400)]
    got = pii.find(frame(spark, texts)).collect()
    right = sum(("phone_national" in r.spans) == (r.doc_id % 2 == 0) for r in got)
    assert right >= 0.95 * len(texts)
    clean = [r.text for r in pii.redact(frame(spark, [*texts, None, "me@example.org x"])).orderBy("doc_id").collect()]
    assert clean[-2:] == [None, "[email] x"] and clean[0].startswith("please call [phone_national]")


def brute_classes(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [(i, len(sets[i]), root(i)) for i in range(len(texts))]


def test_jaccard_join(spark):
    texts = [None, "", " ", "a b", "A b", "a b c d e", "one two three four five six"]
    for k in range(12):
        base = [f"t{k}w{RND.randint(0, 500)}" for _ in range(RND.choice([12, 40, 90, 300]))]
        for _ in range(RND.choice([1, 2, 25])):
            own = list(base)
            for _ in range(max(1, len(own) // RND.choice([30, 60, 100]))):
                own[RND.randrange(len(own))] = f"e{RND.randint(0, 10**6)}"
            texts.append(" ".join(own))
    header = " ".join(f"h{i}" for i in range(30))
    texts += [header + " " + " ".join(f"u{k}x{i}" for i in range(RND.choice([6, 14, 40]))) for k in range(60)]
    want = brute_classes(texts)
    docs = frame(spark, texts)
    for bucket in (12, 2):  # with 2, nearly all buckets are large
        assert sorted(map(tuple, jaccard_join.jaccard_join(docs, bucket=bucket).collect())) == want
    assert jaccard_join.jaccard_join(empty(docs)).count() == 0


def as_sets(texts):
    """(shingles, sizes) of texts, as workers make them."""
    raw = [t.encode() for t in texts]
    return shingling.shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw]))


@pytest.mark.parametrize("small, large", [(9, 12), (33, 44), (45, 60), (60, 80), (75, 100), (240, 320), (900, 1200), (50, 50), (400, 400)])
def test_linked_sets_share_enough_signatures(small, large):
    rnd, least = np.random.default_rng(small), []
    for _ in range(200):
        common = -(-3 * (small + large) // 7)  # as unlike as a link allows
        x = np.unique(rnd.integers(0, 2**63, small + large - common).astype(np.uint64))
        rnd.shuffle(x)
        a, b = np.sort(x[:small]), np.sort(np.concatenate([x[:common], x[small:]]))
        given = []
        for s in (a, b):
            given.append(set(jaccard_join.signatures(s, np.array([len(s)]))[0].tolist()))
        assert len(given[0] & given[1]) >= max(1, jaccard_join.least_shared(len(a), len(b)))
        least.append(len(given[0] & given[1]))
    assert min(least) >= 1


def test_the_least_over_partners_is_a_bound(spark):
    rows = spark.range(1, 1500).select("id", jaccard_join._fewest(F.col("id")).alias("f")).collect()
    for r in rows:
        assert r.f <= max(1, min(jaccard_join.least_shared(r.id, m) for m in range(-(-r.id * 3 // 4), r.id * 4 // 3 + 1)))


@pytest.mark.parametrize("bucket", [2, 12])
def test_all_links_between_sets(spark, bucket):
    rnd = random.Random(33)
    texts = [None, "", "a b", "A b"]
    for n in (20, 60, 150):
        base = [f"w{n}x{k}" for k in range(n)]
        for _ in range(18):
            t = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, n // 15])):
                t[rnd.randrange(n)] = f"e{rnd.randrange(40)}"
            texts.append(" ".join(t))
    texts += texts[-3:]
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w := re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())) >= 5 else frozenset([tuple(w)] if w else []) for t in texts]
    linked = {frozenset((x, y)) for x in set(sets) for y in set(sets) if x != y and x and y and 100 * len(x & y) >= 75 * len(x | y)}
    pairs, members = jaccard_join.jaccard_links(frame(spark, texts), bucket=bucket)
    of = {r.doc_id: r for r in members.collect()}
    named = {of[i].sid: s for i, s in enumerate(sets)}
    got = [frozenset((named[r.a], named[r.b])) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == linked
    assert [of[i].n_links for i in range(len(texts))] == [sum(s in x for x in linked) if s else None for s in sets]


def test_jaccard_join_finds_contained_sets_in_large_buckets(spark):
    texts = []
    for small, large in ((33, 44), (45, 60), (150, 200)):
        rnd = random.Random(small)
        fresh = lambda n: [f"w{rnd.getrandbits(60)}" for _ in range(n)]
        for _ in range(6):
            w = fresh(large + 4)
            texts += [" ".join(w), " ".join(w[: small + 4]), " ".join(w[large - small :])]
            for _ in range(8):  # these share passages with the pair, but do not link
                at = rnd.randrange(large - large // 2)
                texts.append(" ".join(w[at : at + large // 2] + fresh(large // 2)))
    want = brute_classes(texts)
    assert sorted(map(tuple, jaccard_join.jaccard_join(frame(spark, texts), bucket=2).collect())) == want


def test_hot_signatures_of_one_task_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT", 3)
    common = " ".join(f"c{i}" for i in range(40))
    texts = [common + " " + " ".join(f"x{k}y{i}" for i in range(k % 25)) for k in range(80)] * 2
    want = brute_classes(texts)
    docs = frame(spark, texts).coalesce(1)
    assert sorted(map(tuple, jaccard_join.jaccard_join(docs, bucket=2).collect())) == want


def test_blocks_round_trip():
    rnd = np.random.default_rng(1)
    for n, names in ((1, 1), (1000, 7), (200_000, 70_000)):
        sig, sid = rnd.integers(0, 2**63, n).astype(np.uint64), rnd.integers(-(2**62), 2**62, names)[rnd.integers(0, names, n)]
        back = jaccard_join.unpacked(jaccard_join.packed(sig, sid))
        assert (back[0] == sig >> np.uint64(16)).all() and (back[1] == sid).all()


def test_rows_of_a_set_are_packed_in_under_seven_bytes():
    for n in (20, 2000):  # rows of each of five sets
        sig, sid = np.random.default_rng(2).integers(0, 2**63, 5 * n).astype(np.uint64), np.repeat(np.arange(5) - 2, n)
        block = jaccard_join.packed(sig, sid)
        assert len(block) < 7 * len(sig)
        back = jaccard_join.unpacked(block)
        assert (back[0] == sig >> np.uint64(16)).all() and (back[1] == sid).all()
    assert [len(x) for x in jaccard_join.unpacked(jaccard_join.packed(sig[:0], sid[:0]))] == [0, 0]


def test_set_arrays_stay_where_they_are_in_joins(spark):
    docs = frame(spark, ["%d a b c d e f g h i j k" % (i % 3) for i in range(9)])
    found = jaccard_join.candidates(docs, "doc_id", "text", 2)
    joined = found.arrays.hint("merge").join(found.classes.select("sid"), "sid").select("sid", "low", "high")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # that of the classes
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith("boxloom_")]
    found.shelf.clear()
    assert names and not set(names) & {t.name for t in spark.catalog.listTables()}


def test_shingles_of_odd_texts():
    texts = [t or "" for t in ODD] + ["a b c d", "A B c d", "a b c d e", "x" * 60 + " y", "x" * 59 + "y y"]
    s, size = as_sets(texts)
    begin = np.cumsum(size) - size
    assert size.tolist() == [n for _, n, _ in brute_classes(texts)]
    of = lambda i: s[begin[i] : begin[i] + size[i]].tolist()
    assert of(-5) == of(-4) and of(-2) != of(-1) and of(-3) != of(-5)


def test_jaccard_join_links_through_a_row_without_key(spark):
    w = [f"k{i}" for i in range(104)]
    head, tail = [f"a{i}" for i in range(12)] + w[12:], w[:-12] + [f"c{i}" for i in range(12)]
    docs = spark.createDataFrame([(1, " ".join(head)), (None, " ".join(w)), (2, " ".join(tail)), (None, "alone")], "doc_id long, text string")
    got = sorted(map(tuple, jaccard_join.jaccard_join(docs).collect()), key=str)
    assert got == [(1, 100, 1), (2, 100, 1), (None, 1, None), (None, 100, 1)]


def test_suffix_dedup(spark):
    x = "the quick brown fox jumps over the lazy dog and runs away é " * 3
    parts = ["".join(RND.choice("abc ") for _ in range(RND.randint(30, 90))) for _ in range(12)]
    rows = [(i, "".join(RND.choice(parts) for _ in range(RND.randint(1, 6)))) for i in range(80)]
    rows += [(900, None), (901, ""), (902, "a" * 49), (903, "a" * 200), (904, "b" + "a" * 120 + "c"), (905, x), (906, x[7:] + "zz"), (906, "q" + x), (907, x), (907, x)]
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            first[b[i : i + 50]] = min(first.get(b[i : i + 50], d), d)
    want = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        want.append((d, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, suffix_dedup.digests(docs).collect())) == sorted(want)
    assert suffix_dedup.digests(empty(docs)).count() == 0


def test_suffix_family_levels():
    family, seen = suffix_dedup.Family(), {}
    for doc in range(12):
        raw = np.frombuffer(bytes(RND.choice(b"ab") for _ in range(58)), np.uint8)
        starts = np.arange(9)
        keys = [raw.tobytes()[i : i + 50] for i in starts]
        for k in keys:
            seen.setdefault(k, doc)
        assert family.add(raw, starts, np.full(9, doc)).tolist() == [seen[k] for k in keys]
    assert len(family.levels) <= 4


def test_chat_fold_and_round_trip(spark):
    log = [(1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", "a"), (1, 1, 2, "delta", "assistant", "b"), (1, 2, 3, "message", "user", "gone"), (1, 1, 4, "regenerate", "assistant", ""), (1, 1, 5, "delta", "assistant", "new"), (1, 0, 6, "edit", "user", "HI"), (2, 0, 0, "message", None, None)]
    events = spark.createDataFrame(log, "conv_id long, turn long, seq long, kind string, role string, text string")
    turns = chat.reconstruct(events).collect()
    assert [(r.conv_id, r.turn, *x[:2]) for r in sorted(turns, key=lambda r: (r.conv_id, r.turn)) for x in chat.parse(r.formatted)] == [(1, 0, "user", "HI"), (1, 1, "assistant", "new"), (2, 0, "", "")]
    for text in ["\\### Assistant: </turn> ok", "#### ", "\\\\", "### ### </turn></turn>\n", " </turn>\n### user: x", "#", "<", ""] + ["".join(RND.choice("\\# </turn>:\nx") for _ in range(30)) for _ in range(300)]:
        whole, a, b = chat.render_turn("ro:le\n", text)
        assert [x[:2] for x in chat.parse(whole + whole)] == [("ro:le\n", text)] * 2 and chat.unescape(whole[a:b]) == text
    assert chat.read_back(chat.reconstruct(empty(events))).count() == 0


def test_sharding(spark):
    texts = [None, "", "same"] + ["same"] * 30 + ["x" * RND.randint(1, 400) + str(i) for i in range(300)]
    docs = frame(spark, texts)
    rows = sharding.shard(docs, shards=5, part_rows=7).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        assert r.size == len((texts[r.doc_id] or "").encode()) + 16
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    sums = [sum(r.size for r in v) for v in by.values()]
    assert len(by) == 5 and max(sums) - min(sums) <= 0.02 * sum(sums) / 5
    assert len({r.shard for r in rows if texts[r.doc_id] == "same"}) == 1
    assert sharding.shard(empty(docs)).count() == 0


def test_packing_is_best_fit():
    assert sharding.pack([5, 4, 3, 3], 2, 8) == [0, 1, 0, 1]
    assert sharding.pack([5, 5, 5], 2, 8) is None
    sizes = [4, 2, 2, 4, 2, 2]
    where = sharding.pack_evenly(sizes, 2)
    assert [sum(s for s, k in zip(sizes, where) if k == j) for j in (0, 1)] == [8, 8]


def test_decontamination(spark):
    items = [" ".join(f"i{k}w{j}" for j in range(n)) for k, n in enumerate((3, 7, 20, 60))]
    fill = lambda k: " ".join(f"f{k}x{j}" for j in range(25))
    swapped = items[3].split()
    for at in range(5, 60, 6):
        swapped[at] = "zz"
    texts = [None, "", fill(0), fill(1) + " " + items[2].upper() + ". " + fill(2), fill(3) + " " + " ".join(swapped) + " " + fill(4), items[1], items[0], " ".join(items[3].split()[10:24]), " ".join(items[3].split()[:6])]
    docs, bench = frame(spark, texts), spark.createDataFrame([*enumerate(items), (9, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.overlaps(docs, bench).collect()}
    assert got == {(3, 2), (4, 3), (5, 1), (7, 3)}
    assert decontamination.overlaps(docs, empty(bench)).count() == 0 and decontamination.overlaps(empty(docs), bench).count() == 0


def test_decontamination_of_short_items_with_replaced_tokens(spark):
    fill = lambda k: " ".join(f"f{k}x{j}" for j in range(25))
    items, texts = [], []
    for n, places in ((12, [4]), (10, [5]), (15, [5, 10]), (12, [1, 4, 7, 10])):
        w = [f"n{len(items)}w{j}" for j in range(n)]
        items.append(" ".join(w))
        texts.append(" ".join([fill(1), *["zz" if j in places else t for j, t in enumerate(w)], fill(2)]))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.overlaps(frame(spark, texts), bench).collect()}
    assert got == {(0, 0), (1, 1), (2, 2)}


def test_decontamination_of_scripts_without_spaces(spark):
    items = ["今天天气很好,我们去公园散步吧。", "昨日は友達と映画を見に行きました。", "วันนี้อากาศดีมากเราไปเดินเล่นกัน"]
    texts = [f"前文{items[0]}后文", f"ああ{items[1]}いい", f"abc {items[2]} def", "这里没有任何相同的句子", None]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.overlaps(frame(spark, texts), bench).collect()}
    assert got == {(0, 0), (1, 1), (2, 2)}


@pytest.mark.parametrize("small", [0, components.SMALL_GRAPH])
def test_components(spark, small):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in components.components(edges, small=small).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components.components(empty(edges), small=small).count() == 0
    more = components.merged(components.components(edges, small=small), spark.createDataFrame([(102, 40), (500, 501)], "a long, b long"))
    assert {r.node: r.label for r in more.collect()} == {i: 0 for i in [*range(41), 100, 101, 102]} | {500: 500, 501: 500}


def test_components_are_never_partial(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)], "a long, b long")
    with pytest.raises(RuntimeError):
        components.components(edges, rounds=1)


def test_bitmap_and_without(spark):
    keys = spark.range(0, 300, 3).select(F.col("id").alias("k"))
    every = spark.range(300).withColumn("map", bitmap(keys, "k", 4096).scalar())
    held = {r.id for r in every.where(let(F.col("map"), lambda m: may_hold(m, F.col("id")))).collect()}
    assert held >= set(range(0, 300, 3)) and len(held) < 200
    docs = spark.range(300).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    assert {r.k for r in without(docs, keys, "k").collect()} == {None} | {i for i in range(1, 300) if i % 3}


def test_few_pairs_and_sets_take_fewer_passes(spark, monkeypatch):
    rnd = random.Random(11)
    texts = []
    for _ in range(6):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(90)]
        texts += [" ".join(w if rnd.random() > 0.02 else f"x{rnd.randrange(99)}" for w in base) for _ in range(9)]
    texts += [None, "", texts[0], "one two"]

    def run():
        group = f"passes-{rnd.random()}"
        spark.sparkContext.setJobGroup(group, group)
        got = sorted(map(tuple, jaccard_join.jaccard_join(frame(spark, texts), bucket=2).collect()))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)  # the session is shared
        return got, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    want = brute_classes(texts)
    few, n_few = run()
    monkeypatch.setattr(jaccard_join, "FEW_SHINGLES", 10)  # few pairs, but of large sets: by quarters of the domain
    assert run()[0] == few == want
    for name in ("FEW_PAIRS", "FEW_SETS", "SMALL_GRAPH"):
        monkeypatch.setattr(jaccard_join, name, -1)
    many, n_many = run()
    assert many == want and n_few < n_many
