"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

Tokens are lower-cased runs of letters and digits; in scripts without spaces each letter is one. Fixed masks
over neighbouring tokens ignore some positions, so a seed survives a substituted token there. Seeds of all
benchmark items set bits in a map of fixed size; a text keeps only the places whose seed is in the map (two
bits by independent hashes), and these places join the benchmark seeds exactly. Around each hit the
neighbourhoods of both, AROUND tokens to each side, are laid side by side and the best run is scored: +1 for
an equal token, -2 for a different one. A text and an item overlap when the run reaches ``min_score``, or
four fifths of an item that is shorter, or when the tokens equal in that position of the two reach four
fifths of the item. Scores and equal tokens count what lies in the neighbourhood, 65 tokens at most.

Items of fewer than FEW tokens have two shorter masks besides, so that any fifth of their tokens may be replaced;
texts are looked up with these only where the benchmark has such items. The map has MAP_BITS bits for each seed.

Items of fewer than ``min_item`` tokens are too short for the masks. With ``short_items`` they match word for
word: one seed of all their tokens, looked up at every place of the texts. Without it they match nothing.

Every mask of two tokens or more has two neighbours in it, so a mask is laid only where such a pair of a text is a
pair of neighbours in the benchmark, by a map of those pairs: one look at each place instead of one for each mask.

Hot seeds: texts are matched in a join on the seed that AQE can split, and what leaves it is merged by
(document, item) with partial sums before the shuffle. Only the benchmark's seeds are ever repeated for a
place. Defined results: null and empty texts and items match nothing; repeated items count as one each by
their id; repeated documents give one row together, and so do documents without a key; of several hits the
greatest score and the greatest number of equal tokens stand; very long texts are read as a whole; no
benchmark gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import bitmap, let, may_hold, table, written

#: Places of the tokens that count; the others are ignored.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 4, 6), (0, 2, 3, 6, 7))
#: The same for items of fewer than FEW tokens: of these and MASKS one always lies on tokens that were not replaced.
FEW_MASKS, FEW = ((0, 1, 2, 3), (0, 1, 4, 5)), 12
AROUND = 32
MIN_SCORE = 10
MIN_ITEM = 6
#: Bits of the map for each mark (two for each seed), so that one place in some 16,000 passes by chance, and the least
#: and greatest size of the map: 128 KB to 16 MB.
MAP_BITS, LEAST_BITS, MOST_BITS = 128, 1 << 20, 1 << 27
#: Letters of scripts that put no spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def token_hashes(text: Column) -> Column:
    """Hashes of the tokens of a text in order."""
    spaced = F.when((F.octet_length(text) > F.length(text)) & text.rlike(UNSPACED), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)
    tokens = F.split(F.lower(F.coalesce(spaced, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(tokens, lambda t: t != ""), lambda t: F.xxhash64(t))


def _seed(h: Column, at: Column, mask: tuple[int, ...]) -> Column:
    """The seed of a mask laid at place ``at`` (from 0) of the hashes ``h``."""
    return F.xxhash64(F.lit(sum(1 << k for k in mask)), *[F.get(h, at + k) if k else F.get(h, at) for k in mask])


def _places(h: Column, mask: tuple[int, ...]) -> Column:
    """The places at which the mask lies wholly inside."""
    n = F.size(h) - mask[-1]
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _around(h: Column, at: Column) -> Column:
    """2 * AROUND + 1 hashes with place ``at`` in the middle; null beyond the ends."""
    return F.transform(F.sequence(F.lit(-AROUND), F.lit(AROUND)), lambda k: F.when(at + k >= 0, F.get(h, at + k)))


def whole(n: int) -> tuple[int, ...]:
    """The mask of an item of ``n`` tokens that must match word for word."""
    return tuple(range(n))


def masks_for(n: int) -> tuple[tuple[int, ...], ...]:
    """The masks of an item of ``n`` tokens, at least MIN_ITEM."""
    return (*MASKS, *FEW_MASKS) if n < FEW else MASKS


def map_size(seeds: int) -> int:
    """Bits of the map for a number of seeds: a power of two."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (2 * seeds * MAP_BITS - 1).bit_length()))


def lead(mask: tuple[int, ...]) -> int | None:
    """The first place of a mask whose neighbour is in it too."""
    return next((k for k in mask if k + 1 in mask), None)


def _pair(h: Column, at: Column) -> Column:
    """The key of the two tokens from place ``at`` on."""
    return F.xxhash64(F.get(h, at), F.get(h, at + 1))


def benchmark_pairs(benchmark: DataFrame, text: str) -> DataFrame:
    """(pair) of all neighbours in the items, each once."""
    items = benchmark.select(token_hashes(F.col(text)).alias("ih"))
    return items.select(F.explode(F.transform(_places(F.col("ih"), (0, 1)), lambda i: _pair(F.col("ih"), i))).alias("pair")).distinct()


def benchmark_seeds(benchmark: DataFrame, key: str, text: str, min_item: int, short: bool = False) -> DataFrame:
    """(seed, item, item_tokens, item_around) of all places and masks of items with ``min_item`` tokens or more.

    With ``short``, also of the others: their one seed.
    """
    items = benchmark.select(F.col(key).alias("item"), token_hashes(F.col(text)).alias("ih")).where(F.size("ih") >= (1 if short else min_item))
    ih = F.col("ih")

    def of(mask: tuple[int, ...]) -> Column:
        return F.transform(_places(ih, mask), lambda i: F.struct(_seed(ih, i, mask).alias("seed"), i.alias("q")))

    each = F.when(F.size(ih) < FEW, F.concat(*map(of, masks_for(FEW - 1)))).otherwise(F.concat(*map(of, masks_for(FEW))))
    for n in range(1, min_item):
        each = F.when(F.size(ih) == n, F.array(F.struct(_seed(ih, F.lit(0), whole(n)).alias("seed"), F.lit(0).alias("q")))).otherwise(each)
    hits = items.select("item", "ih", F.explode(each).alias("x"))
    return hits.select(F.col("x.seed").alias("seed"), "item", F.size("ih").alias("item_tokens"), _around(F.col("ih"), F.col("x.q")).alias("item_around"))


def _best_run(a: Column, b: Column) -> Column:
    """Struct (best, run, equal) of the best-scored run of two aligned arrays; equal counts equal tokens in all."""
    same = F.zip_with(a, b, lambda x, y: F.when(x == y, F.lit(1)).when(x.isNull() | y.isNull(), F.lit(-1000)).otherwise(F.lit(-2)))
    start = F.struct(F.lit(0).alias("best"), F.lit(0).alias("run"), F.lit(0).alias("equal"))

    def step(s: Column, x: Column) -> Column:
        run = F.greatest(F.lit(0), s["run"] + x)
        return F.struct(F.greatest(s["best"], run).alias("best"), run.alias("run"), (s["equal"] + F.when(x == 1, 1).otherwise(0)).alias("equal"))

    return F.aggregate(same, start, step)


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", min_score: int = MIN_SCORE, min_item: int = MIN_ITEM, map_bits: int | None = None, short_items: bool = False) -> DataFrame:
    """``key``, ``item_key``, score and equal tokens of each document and item that overlap."""
    seeds = written(benchmark_seeds(benchmark, item_key, item_text, min_item, short_items))
    # the lengths of items that need masks of their own: fewer than FEW numbers
    few = seeds.where(F.col("item_tokens") < max(FEW, min_item)).select("item_tokens").distinct()
    lengths = sorted(r.item_tokens for r in few.collect())
    masks = [*MASKS, *(FEW_MASKS if any(min_item <= n < FEW for n in lengths) else ())]
    masks += [m for m in (whole(n) for n in lengths if n < min_item) if m not in masks]
    map_bits = map_bits or map_size(seeds.count())
    marks = seeds.select("seed").unionByName(seeds.select(F.xxhash64(F.lit(5), "seed").alias("seed")))

    pairs = written(benchmark_pairs(benchmark, item_text))
    pair_bits = map_size(pairs.count())

    def found(h: Column, map_: Column, pairs_: Column) -> Column:
        def known(seed: Column) -> Column:
            return may_hold(map_, seed) & may_hold(map_, F.xxhash64(F.lit(5), seed))

        def of(mask: tuple[int, ...], at: Column) -> Column:
            first = lead(mask)
            if first is None:
                places = _places(h, mask)
            else:
                inside = F.filter(at, lambda i: (i >= first) & (i - first + mask[-1] < F.size(h)))
                places = F.transform(inside, lambda i: i - first) if first else inside
            laid = F.transform(places, lambda i: F.struct(_seed(h, i, mask).alias("seed"), i.alias("i")))
            return F.transform(F.filter(laid, lambda x: known(x["seed"])), lambda x: F.struct(x["seed"].alias("seed"), _around(h, x["i"]).alias("around")))

        there = F.filter(_places(h, (0, 1)), lambda i: may_hold(pairs_, _pair(h, i)))
        return let(there, lambda at: F.concat(*[of(mask, at) for mask in masks]))

    # named once, so that the optimizer puts the subqueries' values in place instead of copies into each row
    with_map = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.struct(bitmap(marks, "seed", map_bits).scalar().alias("map"), bitmap(pairs, "pair", pair_bits).scalar().alias("pairs")).alias("maps"))
    places = with_map.select("key", let(F.col("maps"), lambda m: let(token_hashes(F.col("text")), lambda h: found(h, m["map"], m["pairs"]))).alias("x"))
    # explode() would infer a filter on the array that computes it a second time
    hits = places.select("key", F.explode_outer("x").alias("x")).where("x IS NOT NULL").select("key", "x.seed", "x.around")
    enough = F.least(F.lit(min_score), F.ceil(F.col("item_tokens") * 4 / 5))

    def judged(run: Column) -> Column:
        good = (run["best"] >= enough) | (5 * run["equal"] >= 4 * F.col("item_tokens"))
        return F.when(good, F.struct(run["best"].alias("score"), run["equal"].alias("equal")))

    # one array of one, exploded, so that no filter on the result moves down and computes it again
    run = F.explode_outer(F.array(let(_best_run(F.col("around"), F.col("item_around")), judged)))
    scored = hits.join(seeds, "seed").select("key", "item", run.alias("run")).where("run IS NOT NULL")
    best = scored.groupBy("key", "item").agg(F.max("run.score").alias("score"), F.max("run.equal").alias("equal_tokens"))
    return best.select(F.col("key").alias(key), F.col("item").alias(item_key), "score", "equal_tokens")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


QUERIES = {"op10_decontamination": op10_decontamination}
