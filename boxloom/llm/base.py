"""What of the operators SQL can say too: rules of URLs, base statistics, base spans, sizes and groups of shards.

Queries beside those of the operators, each with its SQL twin. They read the operators' own outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm import pii, quality, sharding, url_filter
from boxloom.llm.common import table

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def base_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("rule_verdict"))


def _rules(of: int) -> str:
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    cases = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, action)[of]}'" for action, h, p in rules)
    return f"CASE {cases} END"


_URLS = f"""WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_UPPER}, {_LOWER}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r)
SELECT page_id, host, path, {_rules(0)} AS rule, {_rules(1)} AS rule_verdict FROM h"""


def base_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), quality.DecisionList())
    return judged.select("doc_id", *[F.col(f"quality_stats.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed")


_QUALITY = r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT doc_id, i, w[i:i + 7] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
n AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(8) x(k) GROUP BY doc_id),
s AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM w LEFT JOIN n ON n.doc_id = w.doc_id)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s"""


def base_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


_PII = r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
c AS (SELECT doc_id, t, list_transform(regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+'), lambda m: list_transform(string_split(regexp_replace(m, '[^0-9]', '', 'g'), ''), lambda x: CAST(x AS INT))) AS cards FROM t)
SELECT doc_id, CAST(len(regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+')) AS BIGINT) AS n_email,
  CAST(len(list_filter(regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), lambda m: len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || right(ltrim(p, '0'), 4) AS INT) > 255)) = 0)) AS BIGINT) AS n_ip,
  CAST(len(list_filter(cards, lambda d: len(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, len(d) + 1), lambda i: CASE WHEN (len(d) - i) % 2 = 0 THEN d[i] WHEN d[i] > 4 THEN 2 * d[i] - 9 ELSE 2 * d[i] END)) % 10 = 0)) AS BIGINT) AS n_card,
  CAST(len(list_filter(regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), lambda m: length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 9 AND 15)) AS BIGINT) AS n_phone FROM c"""


def base_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    placed = sharding.shard(table(spark, sf_dir, "documents")).join(docs, "doc_id")
    groups = placed.groupBy("sha").agg(F.count("*").alias("n_docs"), F.sum("size").alias("bytes"), F.countDistinct("shard").alias("n_shards"))
    return groups.select("sha", "n_docs", "bytes", "n_shards")


_SHARDS = "SELECT sha256(coalesce(text, '')) AS sha, count(*) AS n_docs, CAST(sum(strlen(coalesce(text, '')) + 16) AS BIGINT) AS bytes, 1::BIGINT AS n_shards FROM documents GROUP BY 1"

QUERIES = {"base_url_rules": base_url_rules, "base_quality": base_quality, "base_pii": base_pii, "base_shards": base_shards}
ORACLE_SQL = {"base_url_rules": _URLS, "base_quality": _QUALITY, "base_pii": _PII, "base_shards": _SHARDS}
