"""Stand-ins for images, labels and detections, derived from the driver's tables by SQL that both engines run.

Each view is a SELECT with the names of what it reads in braces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WIDTH, HEIGHT = 640, 480

VIEWS = {
    "v_gt": """
SELECT l_orderkey AS image_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INT) AS box_idx,
  CAST(l_partkey % 5 AS INT) AS cls,
  CAST(20 + l_partkey % 61 AS DOUBLE) / 1e2 AS cx, CAST(20 + l_suppkey % 61 AS DOUBLE) / 1e2 AS cy,
  CAST(8 + l_partkey % 31 AS DOUBLE) / 1e2 AS w, CAST(8 + l_suppkey % 31 AS DOUBLE) / 1e2 AS h,
  l_partkey AS pk, l_suppkey AS sk
FROM {lineitem}""",
    "v_pred": """
SELECT image_id,
  CAST(row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, kind, box_idx) - 1 AS INT) AS det_idx,
  (cx - w / 2e0) * 640 AS x1, (cy - h / 2e0) * 480 AS y1, (cx + w / 2e0) * 640 AS x2, (cy + h / 2e0) * 480 AS y2, conf, cls
FROM (
  SELECT image_id, 0 AS kind, box_idx, cx + CAST(sk % 7 - 3 AS DOUBLE) / 1e2 AS cx, cy, w, h,
    CAST((pk * 31 + sk * 17 + image_id * 7) % 1000 AS DOUBLE) / 1e3 AS conf,
    CASE WHEN pk % 13 = 0 THEN CAST((cls + 1) % 5 AS INT) ELSE cls END AS cls
  FROM {v_gt} WHERE sk % 11 <> 0
  UNION ALL
  SELECT image_id, 1 AS kind, box_idx, 1e0 - cx AS cx, 1e0 - cy AS cy, w, h,
    CAST((pk * 13 + sk * 29 + image_id * 3) % 1000 AS DOUBLE) / 1e3 AS conf, cls
  FROM {v_gt} WHERE sk % 9 = 0) t""",
    "v_gt_px": """
SELECT image_id, box_idx, cls, (cx - w / 2e0) * 640 AS x1, (cy - h / 2e0) * 480 AS y1, (cx + w / 2e0) * 640 AS x2, (cy + h / 2e0) * 480 AS y2
FROM {v_gt}""",
    "v_label_lines": """
SELECT image_id, box_idx AS line_no,
  CASE WHEN pk % 17 = 0 THEN 'x 0.5 0.5 0.1 0.1' WHEN pk % 19 = 0 THEN concat(CAST(cls AS STRING), ' 0.5 0.5')
       WHEN pk % 23 = 0 THEN concat(CAST(cls AS STRING), ' 0.5 oops 0.1 0.1') WHEN pk % 29 = 0 THEN ''
       ELSE concat(CAST(cls AS STRING), ' 0.', CAST(20 + pk % 61 AS STRING), ' 0.', CAST(20 + sk % 61 AS STRING), ' 0.3 0.3') END AS line
FROM {v_gt}""",
    "v_plates": """
SELECT image_id, box_idx AS vehicle_id,
  CAST(pk % 101 AS DOUBLE) / 1e2 AS plate_confidence, CAST((pk * 7 + sk) % 101 AS DOUBLE) / 1e2 AS ocr_confidence,
  substr(concat('KA', CAST(pk AS STRING), CAST(sk AS STRING)), 1, CAST(2 + pk % 7 AS INT)) AS plate
FROM {v_gt} WHERE sk % 5 <> 0""",
    "v_txn": """
SELECT page_id,
  CASE WHEN page_id % 10 = 0 THEN 'None' WHEN page_id % 10 = 1 THEN ' ' ELSE concat('  ', url) END AS entry_image_url,
  prev AS exit_image_url
FROM (SELECT p.page_id, p.url, q.url AS prev FROM {pages} p LEFT JOIN {pages} q ON q.page_id = p.page_id - 1) t""",
}
#: What each view reads.
READS = {"v_gt": ("lineitem",), "v_pred": ("v_gt",), "v_gt_px": ("v_gt",), "v_label_lines": ("v_gt",), "v_plates": ("v_gt",), "v_txn": ("pages",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver or a view over its tables."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(VIEWS[name], **{n: table(spark, sf_dir, n) for n in READS[name]})


#: v_pred in one pass over v_gt, for Spark: a union forgets that the boxes of an image are together already.
_PRED_ONCE = """
SELECT image_id,
  CAST(row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, kind, box_idx) - 1 AS INT) AS det_idx,
  (cx - w / 2e0) * 640 AS x1, (cy - h / 2e0) * 480 AS y1, (cx + w / 2e0) * 640 AS x2, (cy + h / 2e0) * 480 AS y2, conf, cls
FROM (
  SELECT image_id, box_idx, w, h, inline(filter(array(
    IF(sk % 11 <> 0, named_struct('kind', 0, 'cx', cx + CAST(sk % 7 - 3 AS DOUBLE) / 1e2, 'cy', cy,
      'conf', CAST((pk * 31 + sk * 17 + image_id * 7) % 1000 AS DOUBLE) / 1e3,
      'cls', CASE WHEN pk % 13 = 0 THEN CAST((cls + 1) % 5 AS INT) ELSE cls END), NULL),
    IF(sk % 9 = 0, named_struct('kind', 1, 'cx', 1e0 - cx, 'cy', 1e0 - cy,
      'conf', CAST((pk * 13 + sk * 29 + image_id * 3) % 1000 AS DOUBLE) / 1e3, 'cls', cls), NULL)), x -> x IS NOT NULL))
  FROM {v_gt}) t"""


def by_image(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The rows of v_gt_px and v_pred from one shuffle of the few columns that they need, where all boxes of an image meet."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition(parts, "l_orderkey")
    gt = spark.sql(VIEWS["v_gt"], lineitem=lines)
    return spark.sql(VIEWS["v_gt_px"], v_gt=gt), spark.sql(_PRED_ONCE, v_gt=gt)


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, h): the signs of 64 numbers as a bigint, the first the most significant bit."""
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id", "aggregate(transform(embedding, x -> CASE WHEN x > 0 THEN 1L ELSE 0L END), 0L, (a, b) -> shiftleft(a, 1) | b) AS h")


#: The same for the other engine.
HASH_SQL = """SELECT vec_id, CAST(list_sum(list_transform(embedding, lambda x, i:
  CASE WHEN x > 0 AND i > 1 THEN 1::HUGEINT << (64 - i)::INT ELSE 0::HUGEINT END))
  - CASE WHEN embedding[1] > 0 THEN 9223372036854775808::HUGEINT ELSE 0::HUGEINT END AS BIGINT) AS h FROM embeddings"""


def with_views(sql: str, *names: str) -> str:
    """``sql`` behind a WITH of the named views and what they read; ``sql`` may begin with further parts and a comma."""
    need: list[str] = []

    def add(name: str) -> None:
        for n in READS.get(name, ()):
            add(n)
        if name in VIEWS and name not in need:
            need.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS MATERIALIZED ({VIEWS[n].format(**{r: r for r in READS[n]})})" for n in need]
    return f"WITH RECURSIVE {', '.join(parts)} {sql}"
