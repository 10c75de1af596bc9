"""The engine's own queries over the driver's tables, each with its SQL twin for another engine."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom import sql
from boxloom.functions import geometry as G
from boxloom.functions import labels as L
from boxloom.functions import text as X
from boxloom.functions.session import cut, shared_dir
from boxloom.operators import curation as C
from boxloom.operators import decisions as D
from boxloom.operators import dedup as U
from boxloom.operators import matching as M
from boxloom.operators import metrics as K
from boxloom.operators import spatial as S
from boxloom.operators.hash_index import HashIndex
from boxloom.plans.fixtures import HASH_SQL, HEIGHT, WIDTH, by_image, hashes, table, with_views
from boxloom.sources.manifest import Manifest
from boxloom.streaming.exact import dedup_new_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str, *views: str):
    """Registers a query under its function's name, with its SQL (behind a WITH of ``views``)."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = with_views(sql, *views) if views else sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# ---- label lines -----------------------------------------------------------------------------------

_NUM = r"'^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$'"
_TOKENS = "list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '')"
_PARSED = f""", t AS (SELECT image_id, line_no, {_TOKENS} AS t FROM v_label_lines),
n AS (SELECT image_id, line_no, len(t) AS n_tokens, list_transform(t, lambda x: CASE WHEN regexp_matches(x, {_NUM}) THEN TRY_CAST(x AS DOUBLE) END) AS v FROM t),
p AS (SELECT image_id, line_no, n_tokens, CAST(trunc(v[1]) AS INT) AS cls, v[2] AS cx, v[3] AS cy, v[4] AS w, v[5] AS h FROM n)
"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.parse(table(spark, sf_dir, "v_label_lines"))


@query(_PARSED + "SELECT image_id, line_no, cls, cx, cy, w, h FROM p WHERE n_tokens >= 5 AND cls IS NOT NULL AND cx IS NOT NULL AND cy IS NOT NULL AND w IS NOT NULL AND h IS NOT NULL", "v_label_lines")
def label_parse_strict(spark, sf_dir):
    return _lines(spark, sf_dir).where(L.strict()).select("image_id", "line_no", "cls", "cx", "cy", "w", "h")


@query(_PARSED + "SELECT image_id, line_no, cls FROM p WHERE n_tokens >= 5 AND cls IS NOT NULL", "v_label_lines")
def label_parse_class_only(spark, sf_dir):
    return _lines(spark, sf_dir).where(L.class_only()).select("image_id", "line_no", "cls")


@query(_PARSED + "SELECT image_id, line_no, cls FROM p WHERE cls IS NOT NULL", "v_label_lines")
def label_parse_loose(spark, sf_dir):
    return _lines(spark, sf_dir).where(L.loose()).select("image_id", "line_no", "cls")


@query(", l AS (SELECT image_id, bool_or(trim(line) <> '') AS any_text, sum(length(line)) > 0 AS any_bytes FROM v_label_lines GROUP BY image_id) SELECT image_id, any_text, any_bytes FROM l", "v_label_lines")
def label_nonempty(spark, sf_dir):
    lines = table(spark, sf_dir, "v_label_lines")
    return lines.groupBy("image_id").agg(F.bool_or(L.any_text(F.col("line"))).alias("any_text"), (F.sum(F.length("line")) > 0).alias("any_bytes"))


@query(
    """, k AS (SELECT * FROM (VALUES (0, 'bike_front'), (1, 'bike_back'), (2, 'non_bike_front'), (3, 'non_bike_back')) k(cls, name)),
s AS (SELECT cls, count(*) AS boxes, count(DISTINCT image_id) AS images FROM v_gt GROUP BY cls)
SELECT coalesce(s.cls, k.cls) AS cls, coalesce(name, concat('class_', s.cls)) AS name, coalesce(boxes, 0) AS boxes, coalesce(images, 0) AS images,
  round(100.0::DOUBLE * coalesce(images, 0) / greatest((SELECT count(DISTINCT image_id) FROM v_gt), 1), 4) AS image_pct
FROM s FULL JOIN k ON s.cls = k.cls""",
    "v_gt",
)
def class_distribution(spark, sf_dir):
    return K.class_distribution(table(spark, sf_dir, "v_gt"))


_FILES = ", f AS (SELECT o_orderkey AS image_id, o_orderstatus <> 'P' AS readable FROM orders), b AS (SELECT g.* FROM v_gt g JOIN f ON f.image_id = g.image_id WHERE readable)"


def _files(spark, sf_dir):
    """Label files, some of which cannot be read, and the boxes of the others."""
    files = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"), (F.col("o_orderstatus") != "P").alias("readable"))
    return files, table(spark, sf_dir, "v_gt").join(files.where("readable").select("image_id"), "image_id")


@query(
    _FILES + """, k AS (SELECT * FROM (VALUES (0, 'bike_front'), (1, 'bike_back'), (2, 'non_bike_front'), (3, 'non_bike_back'), (4, 'reg_plate')) k(cls, name)),
s AS (SELECT cls, count(*) AS boxes, count(DISTINCT image_id) AS images FROM b GROUP BY cls)
SELECT coalesce(s.cls, k.cls) AS cls, coalesce(name, concat('class_', s.cls)) AS name, coalesce(boxes, 0) AS boxes, coalesce(images, 0) AS images,
  round(100.0::DOUBLE * coalesce(images, 0) / greatest((SELECT count(*) FROM f), 1), 4) AS image_pct FROM s FULL JOIN k ON s.cls = k.cls""",
    "v_gt",
)
def class_distribution_files(spark, sf_dir):
    files, boxes = _files(spark, sf_dir)
    return K.class_distribution(boxes, 2, files)


@query(
    _FILES + """, n AS (SELECT f.image_id, readable, count(b.image_id) AS n FROM f LEFT JOIN b ON b.image_id = f.image_id GROUP BY ALL)
SELECT count(*) AS files, CAST(sum(n) AS BIGINT) AS boxes, count(*) FILTER (n > 0) AS with_boxes, count(*) FILTER (readable AND n = 0) AS empty, count(*) FILTER (NOT readable) AS unreadable FROM n""",
    "v_gt",
)
def class_file_totals(spark, sf_dir):
    return K.file_totals(*_files(spark, sf_dir))


@query(
    _FILES + """ SELECT cls, count(*) AS boxes, count(DISTINCT image_id) AS images, false AS is_total FROM b WHERE cls IS NOT NULL GROUP BY cls
UNION ALL SELECT NULL, (SELECT count(*) FROM b WHERE cls IS NOT NULL), count(DISTINCT image_id), true FROM f""",
    "v_gt",
)
def class_totals(spark, sf_dir):
    files, boxes = _files(spark, sf_dir)
    return K.class_totals(boxes, files)


@query(", b AS (SELECT list_sort(list(DISTINCT cls)) AS classes, max(cls) + 1 AS n_names FROM v_gt) SELECT unnest(classes) AS cls, n_names FROM b", "v_gt")
def classes_seen(spark, sf_dir):
    return C.classes_seen(table(spark, sf_dir, "v_gt")).select(F.explode("classes").alias("cls"), "n_names")


@query("SELECT DISTINCT image_id FROM v_gt WHERE cls = 3", "v_gt")
def images_with_class(spark, sf_dir):
    return C.with_class(table(spark, sf_dir, "v_gt"), 3)


@query(_PARSED + "SELECT p.image_id, p.line_no, l.line FROM p JOIN v_label_lines l ON l.image_id = p.image_id AND l.line_no = p.line_no WHERE n_tokens >= 5 AND cls IS NOT NULL AND cls <> 4", "v_label_lines")
def vehicle_lines(spark, sf_dir):
    return D.vehicle_lines(_lines(spark, sf_dir)).select("image_id", "line_no", "line")


@query(", m AS (SELECT image_id, box_idx, CASE cls WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE cls END AS cls FROM v_gt) SELECT cls, count(*) AS n FROM m GROUP BY cls", "v_gt")
def class_map(spark, sf_dir):
    boxes = table(spark, sf_dir, "v_gt").withColumn("cls", L.remap(F.col("cls"), L.parse_class_map("0:4, 1:2,")))
    return boxes.groupBy("cls").agg(F.count("*").alias("n"))


# ---- geometry --------------------------------------------------------------------------------------


def _clamp(x: str, top: str) -> str:
    return f"least(greatest({x}, 0), {top})"


_CORNERS = ("(cx - w / 2) * 640", "(cy - h / 2) * 480", "(cx + w / 2) * 640", "(cy + h / 2) * 480")


@query("SELECT image_id, box_idx, " + ", ".join(f"CAST({_clamp(f'CAST(round_even({v}, 0) AS INT)', m)} AS INT) AS {n}" for v, m, n in zip(_CORNERS, ("640", "480", "640", "480"), ("x1", "y1", "x2", "y2"))) + " FROM v_gt", "v_gt")
def yolo_to_pixels(spark, sf_dir):
    px = G.to_pixels(*map(F.col, ("cx", "cy", "w", "h")), WIDTH, HEIGHT)
    return table(spark, sf_dir, "v_gt").select("image_id", "box_idx", *[v.alias(n) for v, n in zip(px, ("x1", "y1", "x2", "y2"))])


@query(
    "SELECT image_id, det_idx, " + ", ".join(f"CAST(floor(least(greatest({v}, 0.0::DOUBLE), 1.0::DOUBLE) * 1e6 + 0.5) AS BIGINT) AS {n}" for v, n in (("(x1 + x2) / 2 / 640", "cx"), ("(y1 + y2) / 2 / 480", "cy"), ("(x2 - x1) / 640", "w"), ("(y2 - y1) / 480", "h"))) + " FROM v_pred",
    "v_pred",
)
def xyxy_to_yolo(spark, sf_dir):
    yolo = G.to_yolo(*map(F.col, ("x1", "y1", "x2", "y2")), WIDTH, HEIGHT)
    return table(spark, sf_dir, "v_pred").select("image_id", "det_idx", *[F.floor(v * 1e6 + 0.5).alias(n) for v, n in zip(yolo, ("cx", "cy", "w", "h"))])


@query(
    "SELECT image_id, box_idx, " + ", ".join(f"CAST(trunc(least(greatest({v}, 0.0::DOUBLE), 1.0::DOUBLE) * {m}) AS INT) AS {n}" for v, m, n in (("cx - w / 2 - w * 0.15::DOUBLE", "640", "x1"), ("cy - h / 2 - h * 0.15::DOUBLE", "480", "y1"), ("cx + w / 2 + w * 0.15::DOUBLE", "640", "x2"), ("cy + h / 2 + h * 0.15::DOUBLE", "480", "y2"))) + " FROM v_gt",
    "v_gt",
)
def padded_crop(spark, sf_dir):
    crop = G.padded_crop(*map(F.col, ("cx", "cy", "w", "h")), WIDTH, HEIGHT)
    return table(spark, sf_dir, "v_gt").select("image_id", "box_idx", *[v.alias(n) for v, n in zip(crop, ("x1", "y1", "x2", "y2"))])


_AREA = "greatest(0.0::DOUBLE, x2 - x1) * greatest(0.0::DOUBLE, y2 - y1) / greatest(1, 307200)"


@query(f"SELECT image_id, det_idx, CAST(floor({_AREA} * 1e6) AS BIGINT) AS area_ppm, {_AREA} >= 0.05::DOUBLE AS kept FROM v_pred", "v_pred")
def min_area_filter(spark, sf_dir):
    x = D.with_area(table(spark, sf_dir, "v_pred"), WIDTH, HEIGHT)
    return x.select("image_id", "det_idx", F.floor(F.col("area_frac") * 1e6).alias("area_ppm"), (F.col("area_frac") >= D.BOX_AREA).alias("kept"))


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every image of the labels; one in 97 cannot be read."""
    return table(spark, sf_dir, "v_gt").select("image_id").distinct().withColumn("readable", F.col("image_id") % 97 != 0)


_IMAGES = ", img AS (SELECT DISTINCT image_id, image_id % 97 <> 0 AS readable FROM v_gt)"
_HAS = f"{_IMAGES}, hv AS (SELECT i.image_id, CASE WHEN readable THEN coalesce(bool_or({_AREA} >= 0.02::DOUBLE), false) END AS has_vehicle FROM img i LEFT JOIN v_pred p ON p.image_id = i.image_id GROUP BY i.image_id, readable)"


@query(_HAS + " SELECT image_id, has_vehicle FROM hv", "v_pred", "v_gt")
def has_vehicle(spark, sf_dir):
    return D.has_vehicle(_images(spark, sf_dir), table(spark, sf_dir, "v_pred"), WIDTH, HEIGHT)


# ---- matching and metrics --------------------------------------------------------------------------

_INTER = "greatest(0.0::DOUBLE, least(g.x2, p.x2) - greatest(g.x1, p.x1)) * greatest(0.0::DOUBLE, least(g.y2, p.y2) - greatest(g.y1, p.y1))"
_PAIRS = f""", pair0 AS (SELECT g.image_id, box_idx, det_idx, g.cls AS gcls, p.cls AS pcls, conf, {_INTER} AS inter,
  (g.x2 - g.x1) * (g.y2 - g.y1) AS ag, (p.x2 - p.x1) * (p.y2 - p.y1) AS ap FROM v_gt_px g JOIN v_pred p ON p.image_id = g.image_id),
pair AS MATERIALIZED (SELECT image_id, box_idx, det_idx, gcls, pcls, conf, CASE WHEN ag + ap - inter > 0 THEN inter / (ag + ap - inter) ELSE 0 END AS iou FROM pair0 WHERE inter > 0)"""
_BOTH = ("v_gt_px", "v_pred")


def _both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "v_gt_px"), table(spark, sf_dir, "v_pred")


@query(_PAIRS + " SELECT image_id, box_idx, det_idx, CAST(floor(iou * 1e6 + 0.5) AS BIGINT) AS iou_ppm FROM pair WHERE iou >= 0.5::DOUBLE", *_BOTH)
def iou_pairs(spark, sf_dir):
    box = ["x1", "y1", "x2", "y2"]
    gt, pred = (x.select("image_id", k, *box) for x, k in zip(_both(spark, sf_dir), ("box_idx", "det_idx")))
    x = S.pairs(gt, pred).withColumn("iou", G.iou(F.col("a"), F.col("b")))
    return x.where("iou >= 0.5").select("image_id", "a.box_idx", "b.det_idx", F.floor(F.col("iou") * 1e6 + 0.5).alias("iou_ppm"))


@query(_PAIRS + " SELECT image_id, box_idx, det_idx FROM pair WHERE iou > 0", *_BOTH)
def overlapping_boxes(spark, sf_dir):
    box = ["x1", "y1", "x2", "y2"]
    gt, pred = (x.select("image_id", k, *box) for x, k in zip(_both(spark, sf_dir), ("box_idx", "det_idx")))
    return S.meeting(gt, pred).select("image_id", "a.box_idx", "b.det_idx")


_BEST = _PAIRS + """, best AS (SELECT g.image_id, g.box_idx, g.cls, (SELECT pcls FROM pair p WHERE p.image_id = g.image_id AND p.box_idx = g.box_idx AND iou >= 0.3::DOUBLE AND conf >= 0.25::DOUBLE ORDER BY iou DESC, det_idx DESC LIMIT 1) AS pred_cls FROM v_gt_px g)"""


def _best(spark, sf_dir):
    gt, pred = _both(spark, sf_dir)
    return M.best_class(gt, pred.where("conf >= 0.25D"))


@query(_BEST + " SELECT image_id, box_idx, cls, pred_cls FROM best", *_BOTH)
def best_pred_class(spark, sf_dir):
    return _best(spark, sf_dir)


_CONF = _BEST + """, cm AS (SELECT c.cls, count(*) FILTER (pred_cls = 0) AS p0, count(*) FILTER (pred_cls = 1) AS p1, count(*) FILTER (pred_cls = 2) AS p2, count(*) FILTER (pred_cls = 3) AS p3,
  count(b.cls) FILTER (pred_cls IS NULL OR pred_cls NOT BETWEEN 0 AND 3) AS missed FROM (SELECT unnest([0, 1, 2, 3]) AS cls) c LEFT JOIN best b ON b.cls = c.cls GROUP BY c.cls)"""


@query(_CONF + " SELECT * FROM cm", *_BOTH)
def confusion_matrix(spark, sf_dir):
    return K.confusion(_best(spark, sf_dir))


@query(_CONF + " SELECT CAST(sum(p0 + p1 + p2 + p3 + missed) AS BIGINT) AS gt, CAST(sum(p0 + p1 + p2 + p3) AS BIGINT) AS found, CAST(sum(CASE cls WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 ELSE p3 END) AS BIGINT) AS correct, round(100.0::DOUBLE * sum(CASE cls WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 ELSE p3 END) / sum(p0 + p1 + p2 + p3), 4) AS class_acc, round(100.0::DOUBLE * sum(p0 + p1 + p2 + p3) / sum(p0 + p1 + p2 + p3 + missed), 4) AS detection FROM cm", *_BOTH)
def overall_accuracy(spark, sf_dir):
    return K.overall_accuracy(K.class_accuracy(K.confusion(_best(spark, sf_dir))))


@query(
    _CONF + """, f AS (SELECT cls, p0 + p1 + p2 + p3 + missed AS gt, p0 + p1 + p2 + p3 AS found, CASE cls WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 ELSE p3 END AS correct FROM cm)
SELECT cls, gt, found, correct, round(100.0::DOUBLE * correct / nullif(found, 0), 4) AS class_acc, round(100.0::DOUBLE * found / nullif(gt, 0), 4) AS detection FROM f""",
    *_BOTH,
)
def class_accuracy(spark, sf_dir):
    return K.class_accuracy(K.confusion(_best(spark, sf_dir)))


def _greedy(thresholds: str, least_conf: str = "0.0") -> str:
    """Parts of a WITH: tp(thr, image_id, det_idx) by a recursion over the detections of an image."""
    return (
        _PAIRS
        + f""", thr AS (SELECT unnest({thresholds}) AS thr),
cand AS (SELECT thr, image_id, det_idx, list(box_idx ORDER BY iou DESC, box_idx) AS l FROM pair, thr WHERE iou >= thr AND conf >= {least_conf}::DOUBLE GROUP BY ALL),
ord AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY thr, image_id ORDER BY det_idx) AS k FROM cand),
rec AS (SELECT thr, image_id, k, det_idx, [l[1]] AS used, true AS tp FROM ord WHERE k = 1
  UNION ALL SELECT o.thr, o.image_id, o.k, o.det_idx,
    CASE WHEN len(list_filter(o.l, lambda x: NOT list_contains(r.used, x))) > 0 THEN list_append(r.used, list_filter(o.l, lambda x: NOT list_contains(r.used, x))[1]) ELSE r.used END,
    len(list_filter(o.l, lambda x: NOT list_contains(r.used, x))) > 0 FROM rec r JOIN ord o ON o.thr = r.thr AND o.image_id = r.image_id AND o.k = r.k + 1),
flag AS MATERIALIZED (SELECT t.thr, p.image_id, p.det_idx, p.conf, coalesce(r.tp, false) AS tp FROM v_pred p CROSS JOIN thr t LEFT JOIN rec r ON r.thr = t.thr AND r.image_id = p.image_id AND r.det_idx = p.det_idx WHERE p.conf >= {least_conf}::DOUBLE),
cum AS (SELECT *, sum(tp::INT) OVER w AS tps, count(*) OVER w AS n FROM flag WINDOW w AS (PARTITION BY thr ORDER BY conf DESC, image_id, det_idx ROWS UNBOUNDED PRECEDING)),
env AS (SELECT *, tps / n AS prec, max(tps / n) OVER (PARTITION BY thr ORDER BY conf DESC, image_id, det_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS env FROM cum),
n_gt AS (SELECT count(*) AS c FROM v_gt_px)"""
    )


_EACH_AP = ", ap AS (SELECT t.thr AS threshold, coalesce(sum(env) FILTER (tp), 0) / (SELECT c FROM n_gt) AS ap, count(*) FILTER (tp) AS n_tp FROM thr t LEFT JOIN env e ON e.thr = t.thr GROUP BY t.thr)"
_AP = _EACH_AP + " SELECT threshold, round(ap, 6) AS ap, n_tp FROM ap"


def _rounded(ap: DataFrame) -> DataFrame:
    return ap.select("threshold", F.round("ap", 6).alias("ap"), "n_tp")


@query(_greedy("[0.5::DOUBLE]") + _AP, *_BOTH)
def ap50(spark, sf_dir):
    return _rounded(K.average_precision(*_both(spark, sf_dir), [0.5]))


@query(_greedy("[0.5::DOUBLE, 0.55::DOUBLE, 0.6::DOUBLE, 0.65::DOUBLE, 0.7::DOUBLE, 0.75::DOUBLE, 0.8::DOUBLE, 0.85::DOUBLE, 0.9::DOUBLE, 0.95::DOUBLE]") + _AP, *_BOTH)
def ap_50_95(spark, sf_dir):
    return _rounded(K.average_precision(*_both(spark, sf_dir), K.IOU_STEPS))


_TEN = "[0.5::DOUBLE, 0.55::DOUBLE, 0.6::DOUBLE, 0.65::DOUBLE, 0.7::DOUBLE, 0.75::DOUBLE, 0.8::DOUBLE, 0.85::DOUBLE, 0.9::DOUBLE, 0.95::DOUBLE]"


@query(_greedy(_TEN) + _EACH_AP + " SELECT round(max(ap) FILTER (threshold = 0.5::DOUBLE), 6) AS ap50, round(avg(ap), 6) AS ap FROM ap", *_BOTH)
def mean_ap(spark, sf_dir):
    n_gt = table(spark, sf_dir, "v_gt_px").count()  # a scan: counting what was shuffled would shuffle it once more
    return K.mean_average_precision(*by_image(spark, sf_dir), n_gt=n_gt).select(F.round("ap50", 6).alias("ap50"), F.round("ap", 6).alias("ap"))


_BY_CLASS = _PAIRS + """, cand AS (SELECT gcls AS cls, image_id, det_idx, list(box_idx ORDER BY iou DESC, box_idx) AS l FROM pair WHERE iou >= 0.5::DOUBLE AND gcls = pcls GROUP BY ALL),
ord AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY cls, image_id ORDER BY det_idx) AS k FROM cand),
rec AS (SELECT cls, image_id, k, det_idx, [l[1]] AS used, true AS tp FROM ord WHERE k = 1
  UNION ALL SELECT o.cls, o.image_id, o.k, o.det_idx, CASE WHEN len(list_filter(o.l, lambda x: NOT list_contains(r.used, x))) > 0 THEN list_append(r.used, list_filter(o.l, lambda x: NOT list_contains(r.used, x))[1]) ELSE r.used END,
    len(list_filter(o.l, lambda x: NOT list_contains(r.used, x))) > 0 FROM rec r JOIN ord o ON o.cls = r.cls AND o.image_id = r.image_id AND o.k = r.k + 1),
flag AS MATERIALIZED (SELECT p.cls, p.image_id, p.det_idx, p.conf, coalesce(r.tp, false) AS tp FROM v_pred p LEFT JOIN rec r ON r.cls = p.cls AND r.image_id = p.image_id AND r.det_idx = p.det_idx),
cum AS (SELECT *, sum(tp::INT) OVER w AS tps, count(*) OVER w AS n FROM flag WINDOW w AS (PARTITION BY cls ORDER BY conf DESC, image_id, det_idx ROWS UNBOUNDED PRECEDING)),
env AS (SELECT cls, tp, max(tps / n) OVER (PARTITION BY cls ORDER BY conf DESC, image_id, det_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS env FROM cum),
n AS (SELECT cls, count(*) AS n_gt FROM v_gt_px GROUP BY cls)
SELECT n.cls, n_gt, round(coalesce((SELECT sum(env) FROM env e WHERE e.cls = n.cls AND tp), 0) / n_gt, 6) AS ap FROM n"""


@query(_BY_CLASS, *_BOTH)
def class_ap(spark, sf_dir):
    return K.class_average_precision(*_both(spark, sf_dir)).select("cls", "n_gt", F.round("ap", 6).alias("ap"))


_ONLY = ", go AS (SELECT image_id, box_idx, 4 AS cls, x1, y1, x2, y2 FROM v_gt_px WHERE cls IN (0, 4)), po AS (SELECT image_id, det_idx, x1, y1, x2, y2, conf, 4 AS cls FROM v_pred WHERE cls IN (0, 4))"


@query(_ONLY + _greedy("[0.5::DOUBLE]").replace("v_gt_px", "go").replace("v_pred", "po") + _AP, *_BOTH)
def only_class_ap(spark, sf_dir):
    classes, only = L.parse_class_map("0:4"), 4
    gt, pred = (K.of_classes(side, classes, only) for side in _both(spark, sf_dir))
    return _rounded(K.average_precision(gt, pred, [0.5]))


@query(_greedy("[0.5::DOUBLE]") + " SELECT image_id, det_idx, tp, round(tps / (SELECT c FROM n_gt), 6) AS recall, round(prec, 6) AS precision, round(env, 6) AS envelope FROM env", *_BOTH)
def pr_curve(spark, sf_dir):
    gt, pred = _both(spark, sf_dir)
    curve = K.precision_recall(M.true_positives(gt, pred, [0.5]), gt.count())
    return curve.select("image_id", "det_idx", "tp", *[F.round(c, 6).alias(c) for c in ("recall", "precision", "envelope")])


@query(
    _greedy("[0.5::DOUBLE]", "0.65") + """, o AS (SELECT count(*) FILTER (tp) AS tp, count(*) FILTER (NOT tp) AS fp, (SELECT c FROM n_gt) AS g FROM flag),
q AS (SELECT tp, fp, g - tp AS fn, tp / greatest(tp + fp, 1) AS p, tp / greatest(g, 1) AS r FROM o)
SELECT tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / greatest(p + r, 1e-12::DOUBLE), 6) AS f1 FROM q""",
    *_BOTH,
)
def operating_point(spark, sf_dir):
    return K.operating_point(*_both(spark, sf_dir)).select("tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


_ALL = """, n AS (SELECT coalesce(g.image_id, p.image_id) AS image_id, coalesce(n_gt, 0) AS n_gt, coalesce(n_pred, 0) AS n_pred FROM (SELECT image_id, count(*) AS n_gt FROM v_gt_px GROUP BY 1) g
  FULL JOIN (SELECT image_id, count(*) AS n_pred FROM v_pred GROUP BY 1) p ON g.image_id = p.image_id)"""


@query(
    _PAIRS + _ALL + """, o AS MATERIALIZED (SELECT image_id, box_idx, det_idx, gcls = pcls AS same, row_number() OVER (PARTITION BY image_id ORDER BY iou DESC, det_idx DESC, box_idx DESC) AS k FROM pair WHERE iou >= 0.5::DOUBLE),
r AS (SELECT image_id, k, [det_idx] AS up, [box_idx] AS ug, same::INT AS tp, (NOT same)::INT AS cm FROM o WHERE k = 1
  UNION ALL SELECT o.image_id, o.k, CASE WHEN f THEN list_append(up, det_idx) ELSE up END, CASE WHEN f THEN list_append(ug, box_idx) ELSE ug END, tp + (f AND same)::INT, cm + (f AND NOT same)::INT
  FROM (SELECT o.*, r.up, r.ug, r.tp, r.cm, NOT list_contains(r.up, o.det_idx) AND NOT list_contains(r.ug, o.box_idx) AS f FROM r JOIN o ON o.image_id = r.image_id AND o.k = r.k + 1) o),
l AS (SELECT image_id, max(tp) AS tp, max(cm) AS cm FROM r GROUP BY image_id),
e AS (SELECT n.image_id, n_gt, n_pred, coalesce(tp, 0) AS true_pos, coalesce(cm, 0) AS class_mismatch, n_gt - coalesce(tp + cm, 0) AS false_neg, n_pred - coalesce(tp + cm, 0) AS false_pos FROM n LEFT JOIN l USING (image_id))
SELECT *, false_neg + false_pos + class_mismatch AS badness FROM e WHERE badness >= 1 ORDER BY badness DESC, image_id LIMIT 100""",
    *_BOTH,
)
def bad_predictions_topn(spark, sf_dir):
    gt, pred = _both(spark, sf_dir)
    return M.image_errors(gt, pred).where("badness >= 1").orderBy(F.desc("badness"), "image_id").limit(100)


_PLATE = (
    _PAIRS
    + """, own AS (SELECT image_id, box_idx, list(det_idx ORDER BY iou DESC, det_idx) AS l, list(iou ORDER BY iou DESC, det_idx) AS v FROM pair WHERE gcls = 4 AND pcls = 4 AND iou >= 0.3::DOUBLE GROUP BY ALL),
oth AS (SELECT DISTINCT image_id, box_idx FROM pair WHERE gcls = 4 AND pcls <> 4 AND iou >= 0.3::DOUBLE),
o AS MATERIALIZED (SELECT g.image_id, g.box_idx, coalesce(l, []) AS l, coalesce(v, []) AS v, oth.box_idx IS NOT NULL AS o, row_number() OVER (PARTITION BY g.image_id ORDER BY g.box_idx) AS k
  FROM (SELECT * FROM v_gt_px WHERE cls = 4) g LEFT JOIN own USING (image_id, box_idx) LEFT JOIN oth USING (image_id, box_idx)),
r AS (SELECT image_id, 0::BIGINT AS k, []::INT[] AS used, 0 AS loose, 0 AS wrong, 0 AS missed FROM (SELECT DISTINCT image_id FROM o)
  UNION ALL SELECT image_id, k, CASE WHEN j > 0 THEN list_append(used, l[j]) ELSE used END, loose + (j > 0 AND v[j] < 0.5::DOUBLE)::INT, wrong + (j = 0 AND o)::INT, missed + (j = 0 AND NOT o)::INT
  FROM (SELECT o.*, r.used, r.loose, r.wrong, r.missed, coalesce(list_position(list_transform(o.l, lambda x: list_contains(r.used, x)), false), 0) AS j FROM r JOIN o ON o.image_id = r.image_id AND o.k = r.k + 1)),
e AS (SELECT image_id, arg_max(used, k) AS used, max(loose) AS loose, max(wrong) AS wrong, max(missed) AS missed FROM r GROUP BY image_id),
i AS (SELECT image_id FROM v_pred UNION SELECT image_id FROM v_gt_px WHERE cls = 4),
z AS (SELECT i.image_id, (SELECT count(*) FROM v_gt_px g WHERE g.image_id = i.image_id AND cls = 4) AS gt_plates, (SELECT count(*) FROM v_pred p WHERE p.image_id = i.image_id AND cls = 4) AS pred_plates,
  coalesce(missed, 0) AS missed, coalesce(len(used), 0) AS n_used, coalesce(loose, 0) AS loose_box, coalesce(wrong, 0) AS wrong_class FROM i LEFT JOIN e USING (image_id)),
pe AS (SELECT image_id, gt_plates, pred_plates, missed, pred_plates - n_used AS spurious, loose_box, wrong_class, 3 * missed + 2 * (pred_plates - n_used) + wrong_class + loose_box AS badness FROM z)"""
)


@query(_PLATE + " SELECT * FROM pe", *_BOTH)
def plate_errors(spark, sf_dir):
    gt, pred = _both(spark, sf_dir)
    return M.plate_errors(gt, pred)


@query(
    _PLATE + """ SELECT image_id, badness, concat(lpad(CAST(badness AS STRING), 3, '0'), '.0_', missed, '_', spurious, '_', loose_box, '_', wrong_class) AS prefix,
CASE WHEN missed > 0 THEN 'missed' WHEN wrong_class > 0 THEN 'wrong_class' WHEN spurious > 0 THEN 'spurious' ELSE 'loose_box' END AS kind
FROM pe WHERE badness > 0 ORDER BY badness DESC, missed DESC, image_id LIMIT 300""",
    *_BOTH,
)
def plate_errors_worst(spark, sf_dir):
    gt, pred = _both(spark, sf_dir)
    kind = F.when(F.col("missed") > 0, "missed").when(F.col("wrong_class") > 0, "wrong_class").when(F.col("spurious") > 0, "spurious").otherwise("loose_box")
    worst = M.plate_errors(gt, pred).where("badness > 0").orderBy(F.desc("badness"), F.desc("missed"), "image_id").limit(300)
    return worst.select("image_id", "badness", F.format_string("%05.1f_%d_%d_%d_%d", F.col("badness").cast("double"), "missed", "spurious", "loose_box", "wrong_class").alias("prefix"), kind.alias("kind"))


@query(
    _PAIRS + _ALL + """, c AS (SELECT image_id, box_idx, list(det_idx ORDER BY iou DESC, det_idx) AS l, list(iou ORDER BY iou DESC, det_idx) AS v, list(pcls ORDER BY iou DESC, det_idx) AS q FROM pair WHERE iou >= 0.3::DOUBLE GROUP BY ALL),
o AS MATERIALIZED (SELECT g.image_id, g.box_idx, g.cls, coalesce(l, []) AS l, coalesce(v, []) AS v, coalesce(q, []) AS q, row_number() OVER (PARTITION BY g.image_id ORDER BY g.box_idx) AS k FROM v_gt_px g LEFT JOIN c USING (image_id, box_idx)),
r AS (SELECT image_id, 0::BIGINT AS k, []::INT[] AS used, 0 AS missed, 0 AS wrong, 0 AS loose FROM n
  UNION ALL SELECT image_id, k, CASE WHEN j > 0 THEN list_append(used, l[j]) ELSE used END, missed + (j = 0)::INT, wrong + (j > 0 AND q[j] <> cls)::INT, loose + (j > 0 AND q[j] = cls AND v[j] < 0.5::DOUBLE)::INT
  FROM (SELECT o.*, r.used, r.missed, r.wrong, r.loose, coalesce(list_position(list_transform(o.l, lambda x: list_contains(r.used, x)), false), 0) AS j FROM r JOIN o ON o.image_id = r.image_id AND o.k = r.k + 1)),
e AS (SELECT image_id, arg_max(used, k) AS used, max(missed) AS missed, max(wrong) AS wrong, max(loose) AS loose FROM r GROUP BY image_id)
SELECT image_id, n_gt AS gt_boxes, n_pred AS pred_boxes, missed, n_pred - len(used) AS spurious, wrong AS wrong_class, loose AS loose_box,
  3 * missed + 2 * (n_pred - len(used)) + 2 * wrong + loose AS badness FROM n JOIN e USING (image_id)""",
    *_BOTH,
)
def review_sample(spark, sf_dir):
    return M.review(*_both(spark, sf_dir))


_REVIEW = SQL["review_sample"]
_KINDS = ("missed", "spurious", "wrong_class", "loose_box")


@query(
    _REVIEW[: _REVIEW.rindex("SELECT image_id, n_gt AS gt_boxes")] + """, v AS (""" + _REVIEW[_REVIEW.rindex("SELECT image_id, n_gt AS gt_boxes") :] + """),
q AS (SELECT *, row_number() OVER (ORDER BY md5('42' || CAST(image_id AS STRING)), image_id) - 1 AS sample_pos FROM v QUALIFY sample_pos < 200)
SELECT image_id, badness, CASE WHEN badness > 0 THEN 'bad' ELSE 'good' END AS part, sample_pos, row_number() OVER (ORDER BY badness DESC, sample_pos) - 1 AS place FROM q"""
)
def review_of_a_sample(spark, sf_dir):
    return M.ranked_review(M.review(*_both(spark, sf_dir)), 200).select("image_id", "badness", "part", "sample_pos", "place")


def _totals(source: str, gt: str, *kinds: str) -> str:
    sums = ", ".join(f"sum({k}) AS {k}" for k in kinds)
    rows = " UNION ALL ".join(f"SELECT '{k}' AS kind, CAST({k} AS BIGINT) AS n, round(100.0::DOUBLE * {k} / greatest(g, 1), 6) AS pct_of_gt FROM z1" for k in kinds)
    return f", z1 AS (SELECT sum({gt}) AS g, {sums} FROM {source}) {rows}"


@query(_PLATE + _totals("pe", "gt_plates", "missed", "spurious", "loose_box", "wrong_class"), *_BOTH)
def plate_error_totals(spark, sf_dir):
    return K.error_totals(M.plate_errors(*_both(spark, sf_dir)), "gt_plates", "missed", "spurious", "loose_box", "wrong_class").withColumn("pct_of_gt", F.round("pct_of_gt", 6))


@query(_REVIEW[: _REVIEW.rindex("SELECT image_id, n_gt AS gt_boxes")] + ", v AS (" + _REVIEW[_REVIEW.rindex("SELECT image_id, n_gt AS gt_boxes") :] + ")" + _totals("v", "gt_boxes", *_KINDS))
def review_totals(spark, sf_dir):
    return K.error_totals(M.review(*_both(spark, sf_dir)), "gt_boxes", *_KINDS).withColumn("pct_of_gt", F.round("pct_of_gt", 6))


# ---- duplicates ------------------------------------------------------------------------------------


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first, doc_id = min(doc_id) OVER (PARTITION BY text) AS kept FROM documents")
def exact_dedup(spark, sf_dir):
    return U.exact_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(f"WITH v AS MATERIALIZED ({HASH_SQL}) SELECT x.vec_id AS a, y.vec_id AS b, CAST(bit_count(xor(x.h, y.h)) AS INT) AS distance FROM v x JOIN v y ON x.vec_id < y.vec_id WHERE bit_count(xor(x.h, y.h)) <= 18")
def near_dup_pairs(spark, sf_dir):
    return U.near_pairs(hashes(spark, sf_dir), "vec_id", "h", 18)


_KEEP = f"""WITH RECURSIVE v AS MATERIALIZED ({HASH_SQL}), o AS MATERIALIZED (SELECT vec_id, h, row_number() OVER (ORDER BY vec_id) AS k FROM v),
r AS (SELECT 1::BIGINT AS k, [h] AS kept, vec_id, true AS keep FROM o WHERE k = 1
  UNION ALL SELECT o.k, CASE WHEN len(list_filter(r.kept, lambda x: bit_count(xor(x, o.h)) <= 20)) = 0 THEN list_append(r.kept, o.h) ELSE r.kept END, o.vec_id,
    len(list_filter(r.kept, lambda x: bit_count(xor(x, o.h)) <= 20)) = 0 FROM r JOIN o ON o.k = r.k + 1)"""


@query(_KEEP + " SELECT vec_id, keep AS kept FROM r")
def near_dup_greedy(spark, sf_dir):
    return U.kept_greedily(hashes(spark, sf_dir), "vec_id", "h", 20)


@query(
    """WITH d AS (SELECT doc_id, text, doc_id % 13 <> 0 AS readable, min(doc_id) FILTER (doc_id % 13 <> 0) OVER (PARTITION BY text) AS f FROM documents)
SELECT doc_id, CASE WHEN NOT readable THEN 'corrupt_image' WHEN f = doc_id THEN 'ok' ELSE 'exact_duplicate' END AS reason FROM d"""
)
def dedup_reasons(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    readable = F.col("doc_id") % 13 != 0
    found = U.exact_duplicates(docs.withColumn("text", F.when(readable, F.col("text"))), "doc_id", "text")
    kept = found.select("doc_id", F.when(readable, F.col("kept")).alias("kept"))
    return U.dedup_reasons(docs, "doc_id", "text", kept)


@query(
    _KEEP + """, w AS (SELECT r.vec_id, o.h, r.keep FROM r JOIN o ON o.vec_id = r.vec_id)
SELECT vec_id, CASE WHEN keep THEN 'ok' WHEN EXISTS (SELECT 1 FROM w x WHERE x.keep AND x.h = w.h AND x.vec_id < w.vec_id) THEN 'exact_duplicate' ELSE 'near_duplicate' END AS reason FROM w"""
)
def curated_images(spark, sf_dir):
    rows = hashes(spark, sf_dir).withColumn("content", F.col("h").cast("string"))
    return U.curated(rows, "vec_id", "content", "h", 20).select("vec_id", "reason")


_RUNS = f"""WITH RECURSIVE v AS MATERIALIZED ({HASH_SQL}), o AS MATERIALIZED (SELECT v.vec_id, h, label % 2 AS run, row_number() OVER (ORDER BY label % 2, v.vec_id) AS k FROM v JOIN embeddings e ON e.vec_id = v.vec_id),
r AS (SELECT 1::BIGINT AS k, [h] AS kept, vec_id, h, run, true AS keep FROM o WHERE k = 1
  UNION ALL SELECT o.k, CASE WHEN len(list_filter(r.kept, lambda x: bit_count(xor(x, o.h)) <= 20)) = 0 THEN list_append(r.kept, o.h) ELSE r.kept END, o.vec_id, o.h, o.run,
    len(list_filter(r.kept, lambda x: bit_count(xor(x, o.h)) <= 20)) = 0 FROM r JOIN o ON o.k = r.k + 1)
SELECT vec_id, run, CASE WHEN keep THEN 'ok' WHEN EXISTS (SELECT 1 FROM r x WHERE x.keep AND x.h = r.h AND x.k < r.k) THEN 'exact_duplicate' ELSE 'near_duplicate' END AS reason FROM r"""


@query(_RUNS)
def hash_index_runs(spark, sf_dir):
    """Two runs of the index of hashes: the second reads what the first has committed."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") % 2).alias("run")).join(hashes(spark, sf_dir), "vec_id")
    rows = rows.select("run", F.col("vec_id").alias("key"), F.sha2(F.col("h").cast("string"), 256).alias("sha"), F.col("h").alias("hash"))
    index = HashIndex(spark, f"{shared_dir(spark)}/hash-index-{uuid.uuid4().hex}", within=20)
    runs = [index.curate(rows.where(F.col("run") == k).drop("run")).withColumn("run", F.lit(k)) for k in (0, 1)]
    index.manifest.delete()
    return runs[0].unionByName(runs[1]).select(F.col("key").alias("vec_id"), "run", "reason")


@query("SELECT doc_id, sha256(text) AS sha, doc_id = min(doc_id) OVER (PARTITION BY text) AS kept FROM documents WHERE text IS NOT NULL UNION ALL SELECT doc_id, NULL, true FROM documents WHERE text IS NULL")
def exact_dedup_stream(spark, sf_dir):
    """The documents as a stream, with the first key of each text in a state store."""
    at = f"{shared_dir(spark)}/exact-{uuid.uuid4().hex}"
    schema = "doc_id long, text string"
    # a pattern, since a stream takes a file by a pattern only, and a folder in either way
    dedup_new_files(spark, f"{sf_dir}/documents.parque[t]", schema, f"{at}/checkpoint", f"{at}/out", "doc_id", "text")
    return spark.read.schema("doc_id long, sha string, kept boolean").parquet(f"{at}/out")


# ---- addresses, merging, splitting -----------------------------------------------------------------

_URL = "CASE WHEN trim({0}) <> '' AND lower(trim({0})) <> 'none' AND starts_with(trim({0}), 'http') THEN trim({0}) END"
_BASE = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


@query(f", u AS (SELECT {_URL.format('entry_image_url')} AS url FROM v_txn UNION SELECT {_URL.format('exit_image_url')} FROM v_txn) SELECT url FROM u WHERE url IS NOT NULL", "v_txn")
def url_extract(spark, sf_dir):
    return C.urls_of(table(spark, sf_dir, "v_txn"), "entry_image_url", "exit_image_url")


@query(f"SELECT page_id, CASE WHEN string_split({_BASE}, '/')[-1] <> '' THEN string_split({_BASE}, '/')[-1] ELSE string_split(url, '/')[-1] END AS file_name FROM pages")
def url_filename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.url_file_name(F.col("url")).alias("file_name"))


@query("SELECT regexp_extract(url, '//([^/]*)', 1) AS host FROM pages WHERE contains(url, '/en/') INTERSECT SELECT regexp_extract(url, '//([^/]*)', 1) FROM pages WHERE NOT contains(url, '/en/')")
def batch_overlap(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "//([^/]*)", 1).alias("host"), F.col("url").contains("/en/").alias("english"))
    return C.overlap(pages.where("english"), pages.where("NOT english"), "host")


_MERGE = """WITH m AS (SELECT doc_id, source, concat('img', doc_id % 700) AS label, n_chars >= 100 AS ok FROM documents),
o AS (SELECT doc_id, source, CASE WHEN NOT ok THEN 'no_label' WHEN row_number() OVER (PARTITION BY label, ok ORDER BY source, doc_id) = 1 THEN 'added' ELSE 'collision' END AS outcome FROM m)"""


def _merged(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", F.concat(F.lit("img"), F.col("doc_id") % 700).alias("label"))
    return C.merge(rows, ["source", "doc_id"], "label", F.col("n_chars") >= 100)


@query(_MERGE + " SELECT doc_id, outcome FROM o")
def merge_sources(spark, sf_dir):
    return _merged(spark, sf_dir).select("doc_id", "outcome")


@query(_MERGE + " SELECT source, outcome, count(*) AS n FROM o GROUP BY ALL")
def merge_collisions(spark, sf_dir):
    return _merged(spark, sf_dir).groupBy("source", "outcome").agg(F.count("*").alias("n"))


@query(
    """WITH m AS (SELECT doc_id, concat('img', doc_id % 700) AS label, concat('img', doc_id % 700, '.', doc_id % 3) AS name, n_chars >= 100 AS ok, source = (SELECT min(source) FROM documents) AS first FROM documents),
a AS (SELECT *, CASE WHEN NOT ok THEN 'no_label' WHEN row_number() OVER (PARTITION BY label, ok ORDER BY doc_id) = 1 THEN 'added' ELSE 'collision' END AS outcome FROM m WHERE first),
h AS (SELECT label FROM a WHERE outcome = 'added'), b AS (SELECT m.*, label IN (SELECT label FROM h) AS met FROM m WHERE NOT first),
c AS (SELECT doc_id, CASE WHEN NOT ok THEN 'no_label' WHEN met THEN 'collision' WHEN row_number() OVER (PARTITION BY label, ok ORDER BY doc_id) = 1 THEN 'added' ELSE 'collision' END AS outcome FROM b)
SELECT doc_id, outcome FROM a UNION ALL SELECT doc_id, outcome FROM c"""
)
def merge_into_filled(spark, sf_dir):
    """One source merged into an empty output, then all others into what that version of it holds."""
    label = F.concat(F.lit("img"), F.col("doc_id") % 700)
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "source", (F.col("n_chars") >= 100).alias("ok"), label.alias("stem"), F.concat(label, F.lit("."), F.col("doc_id") % 3).alias("name"))
    rows = rows.withColumn("first", F.col("source") == docs.agg(F.min("source")).scalar())
    held = Manifest(spark, f"{shared_dir(spark)}/merge-{uuid.uuid4().hex}")
    one = cut(C.merge(rows.where("first"), ["doc_id"], "stem", F.col("ok")))
    held.commit(0, {"images": held.stage("images", one.where("outcome = 'added'").select("name", "stem"))})
    two = cut(C.merge(rows.where("NOT first"), ["doc_id"], "stem", F.col("ok"), held.read("images", "name string, stem string"), "name"))
    held.delete()
    return one.unionByName(two).select("doc_id", "outcome")


@query("SELECT doc_id, source AS target, CASE WHEN n = 0 THEN source || '.txt' ELSE source || '__' || n || '.txt' END AS free_name FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS n FROM documents)")
def safe_move_names(spark, sf_dir):
    moves = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("target"), F.concat("source", F.lit(".txt")).alias("name"))
    return U.numbered_targets(moves, "doc_id", "name").select("doc_id", "target", "free_name")


_SPLIT = """WITH r AS (SELECT doc_id, source, row_number() OVER (ORDER BY md5('42' || CAST(doc_id AS STRING)), doc_id) - 1 AS r, count(*) OVER () AS n FROM documents),
s AS (SELECT doc_id, source, CASE WHEN r < floor(n * 0.75::DOUBLE) THEN 'train' WHEN r < floor(n * 0.75::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM r)"""


@query(_SPLIT + " SELECT doc_id, split FROM s")
def split_assign(spark, sf_dir):
    return C.split_by_hash(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "split")


@query(_SPLIT + " SELECT split, source, count(*) AS n FROM s GROUP BY ALL")
def split_counts(spark, sf_dir):
    return C.split_by_hash(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id").groupBy("split", "source").agg(F.count("*").alias("n"))


_LABELLED = "l AS (SELECT doc_id, bool_or(quality = 1) AS nonempty FROM labels GROUP BY doc_id), g AS (SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing_label' WHEN nonempty THEN 'valid' ELSE 'empty_label' END AS outcome FROM documents d LEFT JOIN l ON l.doc_id = d.doc_id)"


def _pairs_of(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("nonempty"))
    return C.gather_pairs(table(spark, sf_dir, "documents").select("doc_id"), labels, "doc_id")


@query(f"WITH {_LABELLED} SELECT doc_id, outcome FROM g")
def gather_pairs(spark, sf_dir):
    return _pairs_of(spark, sf_dir).select("doc_id", "outcome")


@query(f"WITH {_LABELLED} SELECT outcome, count(*) AS n FROM g GROUP BY outcome")
def gather_pair_counts(spark, sf_dir):
    return _pairs_of(spark, sf_dir).groupBy("outcome").agg(F.count("*").alias("n"))


@query("SELECT c.conv_id, c.turn, d.doc_id AS image FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id")
def labels_with_images(spark, sf_dir):
    labels = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    images = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), F.col("doc_id").alias("image"))
    return C.labels_with_images(labels, images, "conv_id").select("conv_id", "turn", "image")


@query("SELECT doc_id FROM documents WHERE n_chars >= 100 UNION SELECT doc_id FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)")
def kept_still_there(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return C.still_there(docs.where("n_chars >= 100"), table(spark, sf_dir, "labels"), docs, "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending(spark, sf_dir):
    return C.pending(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


# ---- plates, triage, labelling, relabelling --------------------------------------------------------

_VALID = "plate_confidence >= 0.65::DOUBLE AND ocr_confidence >= 0.8::DOUBLE AND length(trim(plate)) >= 5"
_PBEST = f", pb AS (SELECT image_id, vehicle_id, plate_confidence, ocr_confidence, plate, {_VALID} AS valid FROM v_plates QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY ocr_confidence DESC, vehicle_id) = 1)"


@query(_PBEST + " SELECT image_id, vehicle_id AS plate_idx, plate_confidence, ocr_confidence, plate, valid FROM pb", "v_plates")
def plate_best(spark, sf_dir):
    return D.best_plates(table(spark, sf_dir, "v_plates").withColumnRenamed("vehicle_id", "plate_idx"), "image_id")


@query(
    f"""{_IMAGES}, v AS (SELECT g.image_id, CASE WHEN g.image_id % 11 <> 0 THEN g.box_idx END AS box_idx, CAST(floor(g.w * 50) AS INT) AS side, p.plate IS NOT NULL AS seen, {_VALID.replace('plate_confidence', 'p.plate_confidence').replace('ocr_confidence', 'p.ocr_confidence').replace('trim(plate)', 'trim(p.plate)')} AS valid
  FROM v_gt g LEFT JOIN v_plates p ON p.image_id = g.image_id AND p.vehicle_id = g.box_idx),
a AS (SELECT image_id, count(box_idx) AS n, min(box_idx) FILTER (side < 8) AS crop, min(box_idx) FILTER (NOT seen OR NOT valid) AS bad, arg_min(seen, box_idx) FILTER (NOT seen OR NOT valid) AS bad_seen FROM v GROUP BY image_id),
w AS (SELECT i.image_id, CASE WHEN i.image_id % 7 = 0 THEN 'missing_label' WHEN coalesce(n, 0) = 0 THEN 'empty_label' WHEN NOT readable THEN 'corrupt_image' WHEN crop IS NOT NULL THEN 'invalid_crop'
  WHEN bad IS NOT NULL THEN CASE WHEN bad_seen THEN 'plate_below_threshold' ELSE 'no_plate_detected' END ELSE 'ok' END AS reason, crop, bad FROM img i LEFT JOIN a ON a.image_id = i.image_id)
SELECT image_id, reason, CASE WHEN reason = 'invalid_crop' THEN crop WHEN reason IN ('no_plate_detected', 'plate_below_threshold') THEN bad END AS vehicle_id, reason = 'ok' AS accepted FROM w""",
    "v_plates",
)
def plate_validation(spark, sf_dir):
    images = _images(spark, sf_dir).withColumn("has_label", F.col("image_id") % 7 != 0)
    side = F.floor(F.col("w") * 50).cast("int")
    # the labels of some images hold lines that are no boxes
    vehicle = F.when(F.col("image_id") % 11 != 0, F.col("box_idx"))
    boxes = table(spark, sf_dir, "v_gt").select("image_id", vehicle.alias("vehicle_id"), side.alias("crop_w"), side.alias("crop_h"))
    return D.validate(images, boxes, table(spark, sf_dir, "v_plates").withColumn("plate_idx", F.lit(0)))


@query(
    """, p AS (SELECT image_id, vehicle_id AS line_no FROM v_plates WHERE plate_confidence >= 0.65::DOUBLE),
l AS (SELECT image_id, box_idx AS line_no, cls FROM v_gt g WHERE cls <> 4 OR image_id NOT IN (SELECT image_id FROM p) UNION ALL SELECT image_id, line_no, 4 FROM p)
SELECT image_id, cls, count(*) AS n, sum(line_no) AS places FROM l GROUP BY ALL""",
    "v_plates",
)
def plate_upsert(spark, sf_dir):
    lines = table(spark, sf_dir, "v_gt").select("image_id", F.col("box_idx").alias("line_no"), "cls")
    plates = table(spark, sf_dir, "v_plates").where("plate_confidence >= 0.65D").select("image_id", F.col("vehicle_id").alias("line_no"))
    return D.upsert_plates(lines, plates).groupBy("image_id", "cls").agg(F.count("*").alias("n"), F.sum("line_no").alias("places"))





@query(
    f""", i AS (SELECT DISTINCT image_id, CASE WHEN image_id % 53 <> 0 THEN 640 END AS width, image_id % 31 = 0 AS failed FROM v_gt),
b AS (SELECT p.image_id, count(*) AS n, count(*) FILTER (abs(3 - CAST(floor(ocr_confidence * 100 + 0.5) AS INT) % 7) > 0) AS good FROM v_plates p WHERE plate_confidence >= 0.65::DOUBLE GROUP BY 1),
s AS (SELECT i.image_id, CASE WHEN failed THEN 'api_fail' WHEN n IS NULL THEN 'no_plate' WHEN width IS NULL THEN 'size_fail' WHEN good = 0 THEN 'no_plate' ELSE 'plated' END AS status, good FROM i LEFT JOIN b ON b.image_id = i.image_id)
SELECT image_id, status, CAST(CASE WHEN status = 'plated' THEN good ELSE 0 END AS INT) AS n_boxes FROM s""",
    "v_plates",
)
def plate_status(spark, sf_dir):
    images = table(spark, sf_dir, "v_gt").select("image_id").distinct().select("image_id", F.when(F.col("image_id") % 53 != 0, WIDTH).alias("width"), F.lit(HEIGHT).alias("height"), (F.col("image_id") % 31 == 0).alias("failed"))
    left = (F.floor(F.col("ocr_confidence") * 100 + 0.5) % 7).cast("double")
    plates = table(spark, sf_dir, "v_plates").select("image_id", F.col("vehicle_id").alias("plate_idx"), F.col("plate_confidence").alias("confidence"), F.array(left, F.lit(10.0), F.lit(3.0), F.lit(20.0)).alias("bbox"))
    return D.plate_status(images, plates).select("image_id", "status", F.size("boxes").alias("n_boxes"))


@query(
    _HAS + """, b AS (SELECT image_id, max(plate_confidence) AS best FROM v_plates GROUP BY 1)
SELECT h.image_id, CASE WHEN has_vehicle IS NULL THEN 'unreadable' WHEN NOT has_vehicle THEN 'no_vehicle' WHEN b.image_id % 29 = 0 THEN 'api_fail' WHEN best >= 0.45::DOUBLE THEN 'clean' ELSE 'no_plate' END AS decision FROM hv h LEFT JOIN b ON b.image_id = h.image_id""",
    "v_pred", "v_plates",
)
def triage(spark, sf_dir):
    plates = table(spark, sf_dir, "v_plates").groupBy("image_id").agg(F.max("plate_confidence").alias("best")).withColumn("failed", F.col("image_id") % 29 == 0)
    return D.triage(has_vehicle(spark, sf_dir), plates)


@query(
    f"""{_IMAGES}, d AS (SELECT p.image_id, p.det_idx, {_AREA} >= 0.05::DOUBLE AS large, round_even(least(x2, 640), 0) <= round_even(greatest(x1, 0), 0) OR round_even(least(y2, 480), 0) <= round_even(greatest(y1, 0), 0) AS e,
  coalesce(l.plate_confidence >= 0.65::DOUBLE, false) AS vis FROM v_pred p LEFT JOIN v_plates l ON l.image_id = p.image_id AND l.vehicle_id = p.det_idx),
a AS (SELECT image_id, count(*) FILTER (large) AS n, count(*) FILTER (NOT large) AS small, min(det_idx) FILTER (large AND (e OR NOT vis)) AS bad, arg_min(e, det_idx) FILTER (large AND (e OR NOT vis)) AS bad_e FROM d GROUP BY 1),
s AS (SELECT i.image_id, CASE WHEN NOT readable THEN 'read_failed' WHEN coalesce(n, 0) = 0 THEN 'no_box' WHEN n > 3 THEN 'too_many' WHEN bad IS NOT NULL THEN CASE WHEN bad_e THEN 'no_box' ELSE 'no_plate' END ELSE 'labeled' END AS status, n, small FROM img i LEFT JOIN a ON a.image_id = i.image_id)
SELECT image_id, status, CASE WHEN status = 'labeled' THEN n ELSE 0 END AS kept, coalesce(small, 0) AS skipped_small FROM s""",
    "v_pred", "v_plates",
)
def label_decision(spark, sf_dir):
    plates = table(spark, sf_dir, "v_plates").select("image_id", F.col("vehicle_id").alias("det_idx"), (F.col("plate_confidence") >= 0.65).alias("visible"))
    return D.label_decision(_images(spark, sf_dir), table(spark, sf_dir, "v_pred"), plates, WIDTH, HEIGHT)


_RELABEL = """, c AS (SELECT image_id, det_idx // 2 AS box_idx, arg_max(cls, conf * 1000 - det_idx / 1e3) FILTER (conf > 0) AS best_cls FROM (SELECT * FROM v_pred ORDER BY det_idx) GROUP BY 1, 2),
j AS (SELECT g.image_id, g.box_idx, g.cls, best_cls FROM v_gt g LEFT JOIN c ON c.image_id = g.image_id AND c.box_idx = g.box_idx),
n AS (SELECT image_id, box_idx, cls, CASE cls WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 4 THEN 6 WHEN 2 THEN CASE WHEN coalesce(best_cls, 2) = 2 THEN 2 ELSE 4 END WHEN 3 THEN CASE WHEN coalesce(best_cls, 2) = 2 THEN 3 ELSE 5 END END AS new_cls,
  CASE WHEN cls IN (0, 1, 4) THEN 'direct' WHEN best_cls IS NULL THEN 'fallback' ELSE 'decided' END AS how FROM j)"""


def _relabelled(spark, sf_dir):
    boxes = table(spark, sf_dir, "v_gt").select("image_id", "box_idx", "cls")
    crops = table(spark, sf_dir, "v_pred").withColumn("box_idx", F.floor(F.col("det_idx") / 2).cast("int"))
    return D.relabel(boxes, D.best_detection(crops))


@query(_RELABEL + " SELECT image_id, box_idx, new_cls FROM n", "v_gt", "v_pred")
def relabel_7class(spark, sf_dir):
    return _relabelled(spark, sf_dir).select("image_id", "box_idx", "new_cls")


@query(_RELABEL + " SELECT new_cls, how, count(*) AS n FROM n GROUP BY ALL", "v_gt", "v_pred")
def relabel_stats(spark, sf_dir):
    return _relabelled(spark, sf_dir).groupBy("new_cls", "how").agg(F.count("*").alias("n"))


_REASONS = (
    _RELABEL
    + """, s AS (SELECT image_id, box_idx, image_id % 17 = 0 AS gone, CAST(least(1, cx + w / 2 + w * 0.15::DOUBLE) * 40 AS DOUBLE) AS x2, CAST(greatest(0, cx - w / 2 - w * 0.15::DOUBLE) * 40 AS DOUBLE) AS x1,
  CAST(least(1, cy + h / 2 + h * 0.15::DOUBLE) * 30 AS DOUBLE) AS y2, CAST(greatest(0, cy - h / 2 - h * 0.15::DOUBLE) * 30 AS DOUBLE) AS y1 FROM v_gt),
z AS (SELECT n.image_id, how, CASE WHEN how = 'direct' THEN 'direct' WHEN how = 'decided' THEN CASE WHEN new_cls IN (2, 3) THEN 'car' ELSE 'other' END WHEN gone THEN 'no_image'
  WHEN trunc(x2) - trunc(x1) < 8 OR trunc(y2) - trunc(y1) < 8 THEN 'bad_crop' ELSE 'no_detection' END AS why FROM n JOIN s ON s.image_id = n.image_id AND s.box_idx = n.box_idx)
SELECT how, why, count(*) AS boxes, count(DISTINCT image_id) AS files, CAST(grouping_id(how, why) AS INT) AS level FROM z GROUP BY ROLLUP (how, why)"""
)


@query(_REASONS, "v_gt", "v_pred")
def relabel_reasons(spark, sf_dir):
    """Why boxes got their new class, with sub-totals; images of 40 by 30 pixels, every 17th of them missing."""
    boxes = table(spark, sf_dir, "v_gt")
    gone = F.col("image_id") % 17 == 0
    images = boxes.select("image_id").distinct().select("image_id", F.when(~gone, 40).alias("width"), F.when(~gone, 30).alias("height"))
    return D.relabel_reasons(_relabelled(spark, sf_dir), D.crop_states(boxes, images))


# ---- scores, payloads, status ----------------------------------------------------------------------

_BAND = "CASE " + " ".join(f"WHEN value < {t} THEN '{b:03d}-{t:03d}'" for b, t in zip((0, *X.BAND_TOPS[:-1]), X.BAND_TOPS)) + " ELSE '100-plus' END"


@query(f"SELECT {_BAND} AS band, count(*) AS n FROM events WHERE value >= 0 GROUP BY 1")
def brightness_bands(spark, sf_dir):
    return C.bands(table(spark, sf_dir, "events"), "value")


@query("SELECT unnest([1, 5, 10, 25, 50, 75, 90]) AS pct, round(unnest(quantile_cont(value, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9])), 6) AS v FROM events WHERE value >= 0")
def brightness_percentiles(spark, sf_dir):
    return C.percentiles(table(spark, sf_dir, "events"), "value").select("pct", F.round("v", 6).alias("v"))


@query(f"SELECT event_id, band, pos FROM (SELECT event_id, {_BAND} AS band, row_number() OVER (PARTITION BY {_BAND} ORDER BY event_id) AS pos FROM events WHERE value >= 0) WHERE pos <= 25")
def band_samples(spark, sf_dir):
    return C.band_samples(table(spark, sf_dir, "events"), "event_id", "value").select("event_id", "band", "pos")


@query("SELECT event_id FROM events WHERE value >= 0 AND value < 40")
def dark_images(spark, sf_dir):
    return table(spark, sf_dir, "events").where(C.dark(F.col("value"))).select("event_id")


@query("SELECT event_id, CAST(event_id % 100 AS DOUBLE) / 1e2 AS plate_confidence, CASE WHEN event_id % 5 = 0 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS ocr_confidence, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS plate FROM events WHERE event_id % 7 <> 0")
def json_payload_parse(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    ocr = F.when(F.col("event_id") % 5 == 0, "null").otherwise('"0.5"')
    name = F.when(F.col("event_id") % 3 == 0, "null").otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    plate = F.concat(F.lit('{"plates":[{"confidence":'), (F.col("event_id") % 100 / F.lit(1e2)).cast("string"), F.lit(',"ocr_confidence":'), ocr, F.lit(',"plate":'), name, F.lit(',"bbox":[1,2,"3",4]}]}'))
    payload = F.when(F.col("event_id") % 7 == 0, '{"plates":"none"}').otherwise(plate)
    return e.select("event_id", F.explode(D.parse_payload(payload)).alias("p")).select("event_id", "p.plate_confidence", "p.ocr_confidence", "p.plate")


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1")
def download_status_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (value >= 0) AS n, round(avg(value) FILTER (value >= 0), 6) AS mean, min(value) FILTER (value >= 0) AS least, max(value) FILTER (value >= 0) AS greatest, count(*) FILTER (value < 0) AS unreadable FROM events")
def brightness_summary(spark, sf_dir):
    return C.score_summary(table(spark, sf_dir, "events"), "value").withColumn("mean", F.round("mean", 6))


@query(_RELABEL + " SELECT new_cls, how, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM n), 6) AS pct FROM n GROUP BY ALL", "v_gt", "v_pred")
def relabel_shares(spark, sf_dir):
    return D.relabel_counts(_relabelled(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


@query("SELECT image_id, det_idx, CASE WHEN cls IN (1, 3) THEN 1 ELSE 3 END AS batch_class FROM v_pred WHERE cls IN (1, 2, 3, 5, 7)", "v_pred")
def batch_labels(spark, sf_dir):
    pred = table(spark, sf_dir, "v_pred")
    return pred.where(D.is_vehicle(F.col("cls"))).select("image_id", "det_idx", D.batch_class(F.col("cls"), "back").alias("batch_class"))


@query(
    f""", c AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, det_idx) AS k FROM v_pred WHERE conf >= 0.25::DOUBLE),
hide0 AS (SELECT g.image_id, g.k AS a, p.k AS b, {_INTER} AS inter, (g.x2 - g.x1) * (g.y2 - g.y1) + (p.x2 - p.x1) * (p.y2 - p.y1) AS areas FROM c g JOIN c p ON p.image_id = g.image_id AND p.cls = g.cls AND g.k < p.k),
hide AS MATERIALIZED (SELECT image_id, b, list(a) AS a FROM hide0 WHERE areas - inter > 0 AND inter / (areas - inter) > 0.45::DOUBLE GROUP BY ALL),
x AS MATERIALIZED (SELECT c.image_id, c.k, coalesce(h.a, []) AS a FROM c LEFT JOIN hide h ON h.image_id = c.image_id AND h.b = c.k),
r AS (SELECT image_id, k, [k] AS kept, true AS keep FROM x WHERE k = 1
  UNION ALL SELECT x.image_id, x.k, CASE WHEN list_has_any(r.kept, x.a) THEN r.kept ELSE list_append(r.kept, x.k) END, NOT list_has_any(r.kept, x.a) FROM r JOIN x ON x.image_id = r.image_id AND x.k = r.k + 1)
SELECT c.image_id, c.conf, c.cls, CAST(row_number() OVER (PARTITION BY c.image_id ORDER BY c.k) - 1 AS INT) AS det_idx FROM c JOIN r ON r.image_id = c.image_id AND r.k = c.k WHERE keep""",
    "v_pred",
)
def suppressed(spark, sf_dir):
    return D.suppress(table(spark, sf_dir, "v_pred")).select("image_id", "conf", "cls", "det_idx")


@query(
    """, v AS (SELECT image_id, count(*) AS n FROM v_gt WHERE cls <> 4 GROUP BY 1),
d AS (SELECT image_id, count(*) FILTER (cls = 0 AND x1 <> x2 AND y1 <> y2) AS n FROM v_pred GROUP BY 1),
i AS (SELECT o_orderkey AS image_id, o_orderstatus <> 'P' AS readable FROM orders)
SELECT i.image_id, CASE WHEN NOT readable THEN 'read_failed' WHEN d.n > 0 THEN 'recovered' ELSE 'rejected' END AS status, CASE WHEN readable AND d.n > 0 THEN coalesce(v.n, 0) + d.n ELSE 0 END AS n_lines
FROM i LEFT JOIN v ON v.image_id = i.image_id LEFT JOIN d ON d.image_id = i.image_id""",
    "v_gt", "v_pred",
)
def plate_recovery(spark, sf_dir):
    images = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"), F.when(F.col("o_orderstatus") != "P", WIDTH).alias("width"), F.lit(HEIGHT).alias("height"))
    line = F.format_string("%d %.2f %.2f %.2f %.2f", "cls", "cx", "cy", "w", "h")
    lines = L.parse(table(spark, sf_dir, "v_gt").select("image_id", F.col("box_idx").alias("line_no"), line.alias("line")))
    return D.recover_plates(images, lines, table(spark, sf_dir, "v_pred")).select("image_id", "status", F.size("lines").cast("long").alias("n_lines"))


# ---- SQL surface -----------------------------------------------------------------------------------


@query(_PARSED + "SELECT image_id, line_no, cls, cx, cy, w, h FROM p WHERE n_tokens >= 5 AND cls IS NOT NULL AND cx IS NOT NULL AND cy IS NOT NULL AND w IS NOT NULL AND h IS NOT NULL", "v_label_lines")
def sql_parse_label(spark, sf_dir):
    """Label files of several lines, parsed by a table function in SQL."""
    sql.register(spark)
    lines = table(spark, sf_dir, "v_label_lines")
    return spark.sql(
        """SELECT f.image_id, b.* FROM (SELECT image_id, array_join(transform(array_sort(collect_list(struct(line_no, line))), x -> x.line), '\n') AS text FROM {lines} GROUP BY image_id) f,
LATERAL parse_label(f.text) b""",
        lines=lines,
    )


@query(_PAIRS + " SELECT image_id, box_idx, det_idx, CAST(floor(iou * 1e6 + 0.5) AS BIGINT) AS iou_ppm FROM pair WHERE iou >= 0.5::DOUBLE", *_BOTH)
def sql_box_iou(spark, sf_dir):
    sql.register(spark)
    gt, pred = _both(spark, sf_dir)
    return spark.sql(
        """SELECT image_id, box_idx, det_idx, CAST(floor(iou * 1e6 + 0.5) AS BIGINT) AS iou_ppm FROM (
  SELECT g.image_id, g.box_idx, p.det_idx, box_iou(named_struct('x1', g.x1, 'y1', g.y1, 'x2', g.x2, 'y2', g.y2), named_struct('x1', p.x1, 'y1', p.y1, 'x2', p.x2, 'y2', p.y2)) AS iou
  FROM {gt} g JOIN {pred} p ON p.image_id = g.image_id) WHERE iou >= 0.5D""",
        gt=gt,
        pred=pred,
    )


@query(f"SELECT {_BAND} AS band, CAST(bit_count(xor(event_id, user_id)) AS INT) AS distance, count(*) AS n FROM events WHERE value >= 0 GROUP BY ALL")
def sql_bands(spark, sf_dir):
    sql.register(spark)
    events = table(spark, sf_dir, "events")
    return spark.sql("SELECT band_label(value) AS band, hamming(event_id, user_id) AS distance, count(*) AS n FROM {events} WHERE value >= 0 GROUP BY ALL", events=events)
