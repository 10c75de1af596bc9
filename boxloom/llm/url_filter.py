"""URL filters: rules first, link-graph propagation for hosts that no rule reaches.

Host edges come from the absolute links of pages. Seeds are the hosts of pages that a rule decides, and hosts
that are only linked to where a rule covers a whole host. A rule for a path makes a seed of the host of each
page that it fits; a host may be a seed of both kinds. Trust spreads from trusted hosts along links
(personalised PageRank), distrust from blocked hosts against them (who links to bad hosts is suspect). A
host is blocked when its distrust is above its trust and above the part ``min_score`` / UNIT of what one
blocked seed host starts with, so how many other seeds share UNIT does not matter. Scores are fixed-point
integers, so sums do not depend on the order of rows, and a rerun gives the same verdicts.

Defined results: a null url or one without ``://`` has empty host and path, no rule, and is allowed;
pages without links, or with links to their own host only, add no edges; without edges every host that no
rule reaches is allowed; repeated rows get a row each; rules of equal length go in the order given; very
long urls and pages are read as a whole; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import ascii_lower, cut, table, written

#: (action, host, path) of the query; a parameter of the operator.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UNIT = 10**15
DAMPING_PERCENT = 85
ROUNDS = 10
#: Of a seed that starts with UNIT; it falls with the start of a seed when more of them share UNIT.
MIN_SCORE = 10**9
LINK = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    """What stands behind the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does."""
    out = F
    for action, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = out.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("verdict")))
    return out.otherwise(F.lit(None)) if out is not F else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame, html: str) -> DataFrame:
    """Distinct (src, dst) of links between different hosts; ``pages`` has a column host."""
    links = pages.where(F.col("host") != "").select(F.col("host").alias("src"), F.explode(F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)))).alias("dst"))
    return links.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src <> dst").distinct()


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(host, score) after ``rounds`` rounds along (src, dst); the seeds share UNIT and the restarts."""
    n = seeds.count()
    if not n:
        return seeds.select("host", F.lit(0).cast("long").alias("score"))
    start = UNIT // n
    base = cut(seeds.select("host", F.lit(start * (100 - DAMPING_PERCENT) // 100).cast("long").alias("score")))
    degree = edges.groupBy("src").agg(F.count("*").alias("degree"))
    steps = cut(edges.join(degree, "src"))
    scores = seeds.select("host", F.lit(start).cast("long").alias("score"))
    for k in range(rounds):
        given = steps.join(scores, steps["src"] == scores["host"]).select(F.col("dst").alias("host"), F.expr(f"score * {DAMPING_PERCENT} div 100 div degree").alias("score"))
        scores = given.unionByName(base).groupBy("host").agg(F.sum("score").alias("score")).where("score > 0")
        if k % 4 == 3:
            scores = cut(scores)
    return scores


def host_verdicts(pages: DataFrame, html: str, rules=RULES, min_score: int = MIN_SCORE, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust, method_verdict) of hosts that propagation reaches; ``pages`` has host, fit."""
    edges = cut(host_edges(pages, html))
    none = pages.sparkSession.createDataFrame([], "host string, trust long, distrust long, method_verdict string")
    if edges.isEmpty():
        return none
    judged = written(pages.where("fit IS NOT NULL AND host <> ''").select("host", "fit.verdict").distinct())
    # hosts that are linked to, but have no page here, fit the rules for whole hosts
    linked = written(edges.select(F.col("dst").alias("host")).distinct()).select("host", rule_of(F.col("host"), F.lit("/"), rules).alias("fit"))
    seeds = judged.unionByName(written(linked.where("fit IS NOT NULL").select("host", "fit.verdict"))).distinct()
    trust = propagate(edges, seeds.where("verdict = 'allow'").select("host"), rounds).withColumnRenamed("score", "trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    blocked = seeds.where("verdict = 'block'").select("host")
    distrust = propagate(back, blocked, rounds).withColumnRenamed("score", "distrust")
    least = min_score // max(1, blocked.count())
    both = trust.join(distrust, "host", "full").fillna(0, ["trust", "distrust"])
    return both.withColumn("method_verdict", F.when((F.col("distrust") > least) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow"))


def judge_urls(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules=RULES, min_score: int = MIN_SCORE, rounds: int = ROUNDS) -> DataFrame:
    """``key``, host, path, rule, verdict, trust, distrust of each page."""
    parsed = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.col(html).alias("html"))
    fitted = parsed.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = host_verdicts(fitted, "html", rules, min_score, rounds)
    return (
        fitted.drop("html")
        .join(verdicts, "host", "left")
        .select(
            F.col("key").alias(key),
            "host",
            "path",
            F.col("fit.rule").alias("rule"),
            F.coalesce(F.col("fit.verdict"), F.col("method_verdict"), F.lit("allow")).alias("verdict"),
            F.coalesce("trust", F.lit(0).cast("long")).alias("trust"),
            F.coalesce("distrust", F.lit(0).cast("long")).alias("distrust"),
        )
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


QUERIES = {"op1_url_filter": op1_url_filter}
