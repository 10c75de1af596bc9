"""Quality rules as a learned decision list, in DataFrame operations only.

Statistics of each whole text are built-in expressions. The list is learned by sequential covering: a rule
grows by adding the threshold condition with the best information gain on the growing rows, is pruned on
the pruning rows, and what it covers leaves the data before the next rule grows. All counts come from one
small aggregation a step over binned statistics; the driver sees counts only. The list becomes an ordered
Spark conditional expression: the first rule that fits rejects the row.

Learning uses at most ``max_labelled`` labelled rows, those with the least hash of their id; everything
else covers all rows. Defined results: null and empty texts have no words and fail the base test; rows
without statistics that a condition needs pass it; labels for unknown ids are ignored, and of several
labels of an id the lowest quality counts; no labels give an empty list, which keeps what passes the base
test; repeated rows are judged each for itself; of conditions with equal gain the first in the order of
features and thresholds is taken; very long texts are read as a whole; other columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import SPACES, WORD, cut, let, table, words

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_LABELLED = 20_000
BINS = 16


def _count(text: Column, chars: str) -> Column:
    """How many characters of the class ``chars`` a text has."""
    return F.regexp_count(text, F.lit(chars)).cast("long")


def _repeated(w: Column) -> Column:
    """Words inside windows of WINDOW words that occur at two places or more of the word array ``w``."""
    windows = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    def covered(found: Column) -> Column:
        """``found``: sorted structs (hash, place); places of equal neighbours, each covering WINDOW words."""
        twice = F.filter(found, lambda e, i: (F.get(found, i - 1)["h"] == e["h"]) | F.coalesce(F.get(found, i + 1)["h"] == e["h"], F.lit(False)))
        places = F.sort_array(F.transform(twice, lambda e: e["p"]))
        return let(
            places,
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("long"),
                lambda a, x: a + x,
            ),
        )

    def count(h: Column) -> Column:
        any_twice = let(F.sort_array(h), lambda s: F.exists(F.sequence(F.lit(1), F.size(s) - 1), lambda i: F.get(s, i) == F.get(s, i - 1)))
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(any_twice, let(placed, covered)).otherwise(F.lit(0).cast("long"))

    return F.when(F.size(w) > WINDOW, let(windows, count)).otherwise(F.lit(0).cast("long"))


def stats(text: Column) -> Column:
    """A struct of the statistics of a whole text."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD))
    line_counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    chars = F.length(F.regexp_replace(body, SPACES, ""))
    in_words = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated(w).alias("r")))
    return let(
        F.struct(in_words.alias("w"), line_counts.alias("l")),
        lambda s: F.struct(
            s["w"]["n"].alias("n_words"),
            chars.cast("long").alias("word_chars"),
            _count(body, SYMBOLS).alias("n_symbols"),
            (s["l"]["n"] - s["l"]["d"]).cast("long").alias("n_dup_lines"),
            s["w"]["r"].alias("n_repeat_words"),
            s["l"]["n"].cast("long").alias("n_lines"),
            _count(body, "[!?]").alias("n_marks"),
            _count(body, "[,;]").alias("n_commas"),
            _count(body, "[0-9]").alias("n_digits"),
        ),
    )


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


#: What conditions may test, each from a struct of statistics.
FEATURES = {
    "words": lambda s: s["n_words"].cast("double"),
    "chars_per_word": lambda s: F.try_divide(s["word_chars"], s["n_words"]),
    "symbols_per_word": lambda s: F.try_divide(s["n_symbols"], s["n_words"]),
    "marks_per_word": lambda s: F.try_divide(s["n_marks"], s["n_words"]),
    "commas_per_word": lambda s: F.try_divide(s["n_commas"], s["n_words"]),
    "digits_per_word": lambda s: F.try_divide(s["n_digits"], s["n_words"]),
    "dup_line_share": lambda s: F.try_divide(s["n_dup_lines"], s["n_lines"]),
    "repeat_share": lambda s: F.try_divide(s["n_repeat_words"], s["n_words"]),
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float
    cell: int  # of the binned statistics: above means bin > cell, else bin <= cell

    def fits(self, s: Column) -> Column:
        x = FEATURES[self.feature](s)
        return x > self.threshold if self.above else x <= self.threshold

    def fits_bins(self) -> Column:
        return F.col(self.feature) > self.cell if self.above else F.col(self.feature) <= self.cell

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float
    covers: int

    def fits(self, s: Column) -> Column:
        return _all([c.fits(s) for c in self.conditions])

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions)) + f" -> reject ({self.covers} rows, precision {self.precision:.3f})"


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...] = field(default=())

    def verdict(self, s: Column) -> Column:
        """True if no rule rejects; the rules apply in order."""
        out = F
        for rule in self.rules:
            out = out.when(rule.fits(s), F.lit(False))
        return F.lit(True) if out is F else out.otherwise(F.lit(True))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def labelled_stats(docs: DataFrame, labels: DataFrame, key: str, text: str, max_labelled: int) -> DataFrame:
    """Statistics ``s`` and ``bad`` of at most ``max_labelled`` labelled rows that pass the base test."""
    best = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(key).alias("label_key")).agg(F.min("quality").alias("quality"))
    chosen = best.orderBy(F.xxhash64("label_key"), "label_key").limit(max_labelled)
    # bounded by max_labelled rows of two numbers
    rows = docs.select(F.col(key).alias("label_key"), F.col(text).alias("label_text")).join(F.broadcast(chosen), "label_key")
    # cut before the filter, which would move below the statistics and compute them again for each thing it tests
    known = cut(rows.select("label_key", (F.col("quality") == 0).cast("int").alias("bad"), stats(F.col("label_text")).alias("s")))
    return known.where(~base_failed(F.col("s")))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED, max_rules: int = 6, max_conditions: int = 3, min_precision: float = 0.97, min_cover: int = 4) -> DecisionList:
    """A decision list that rejects what resembles rows labelled with quality 0."""
    rows = labelled_stats(docs, labels, key, text, max_labelled)
    probs = [k / BINS for k in range(1, BINS)] + [0.97, 0.99]
    s = F.col("s")
    quantiles = rows.select([F.percentile_approx(f(s), probs, 10_000).alias(name) for name, f in FEATURES.items()]).first()
    cells = {name: sorted({x for x in (quantiles[name] or []) if x is not None}) for name in FEATURES}

    def binned(name: str) -> Column:
        x = FEATURES[name](s)
        return F.when(x.isNotNull(), sum([(x > t).cast("int") for t in cells[name]], F.lit(0))).alias(name)

    # the pruning rows are a third, by another hash than the one that chose the rows
    fold = (F.pmod(F.xxhash64(F.lit(11), "label_key"), F.lit(3)) == 0).alias("prune")
    left = cut(rows.select("bad", fold, *[binned(name) for name in FEATURES]))

    def histogram(at: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
        pairs = F.array(*[F.struct(F.lit(name).alias("f"), F.col(name).alias("b")) for name in FEATURES])
        got = at.select("bad", F.explode(pairs).alias("x")).groupBy("x.f", "x.b").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
        return {(r.f, r.b): (r.p, r.n) for r in got.collect() if r.b is not None}

    rules: list[Rule] = []
    while len(rules) < max_rules:
        growing = left.where(~F.col("prune"))
        chosen: list[Condition] = []
        while len(chosen) < max_conditions:
            counts = histogram(growing.where(_all([c.fits_bins() for c in chosen])))
            best = _best(counts, cells)
            if best is None:
                break
            chosen.append(best)
        if not chosen:
            break
        prefixes = [_all([c.fits_bins() for c in chosen[:k]]) for k in range(1, len(chosen) + 1)]
        got = left.where("prune").agg(*[F.sum(F.when(p, F.col("bad") * v + (1 - F.col("bad")) * (1 - v)).otherwise(0)).alias(f"{'p' if v else 'n'}{k}") for k, p in enumerate(prefixes) for v in (1, 0)]).first()
        scores = [((got[f"p{k}"] or 0), (got[f"n{k}"] or 0)) for k in range(len(prefixes))]
        k = max(range(len(scores)), key=lambda i: ((scores[i][0] - scores[i][1]) / max(1, sum(scores[i])), -i))
        p, n = scores[k]
        if p < min_cover or p < min_precision * (p + n):
            break
        rules.append(Rule(tuple(chosen[: k + 1]), p / (p + n), p + n))
        left = left.where(~prefixes[k])
    return DecisionList(tuple(rules))


def _best(counts: dict[tuple[str, int], tuple[int, int]], cells: dict[str, list[float]]) -> Condition | None:
    """The condition with the best information gain; None if none gains or nothing is left to tell apart."""
    best, gain = None, 0.0
    for name, thresholds in cells.items():
        each = [counts.get((name, b), (0, 0)) for b in range(len(thresholds) + 1)]
        p_all, n_all = sum(p for p, _ in each), sum(n for _, n in each)
        if not p_all or not n_all:
            continue
        before = math.log2(p_all / (p_all + n_all))
        p_low = n_low = 0
        for cell, threshold in enumerate(thresholds):
            p_low, n_low = p_low + each[cell][0], n_low + each[cell][1]
            for above, p, n in ((True, p_all - p_low, n_all - n_low), (False, p_low, n_low)):
                if p and (g := p * (math.log2(p / (p + n)) - before)) > gain + 1e-9:
                    best, gain = Condition(name, above, threshold, cell), g
    return best


def passes(text: Column, rules: DecisionList) -> Column:
    """True for texts that pass the base test and that no rule rejects; their statistics are computed once."""
    return let(stats(text), lambda s: ~base_failed(s) & rules.verdict(s))


def judge(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """``docs`` with columns base_failed and kept, and ``quality_stats``, replacing columns of these names."""
    judged = docs.withColumn("quality_stats", stats(F.col(text)))
    s = F.col("quality_stats")
    return judged.withColumn("base_failed", base_failed(s)).withColumn("kept", ~base_failed(s) & rules.verdict(s))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = learn(docs, table(spark, sf_dir, "labels"))
    s = "quality_stats"
    return judge(docs.select("doc_id", "text"), rules).select("doc_id", *[F.col(f"{s}.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


QUERIES = {"op2_quality_rules": op2_quality_rules}
