"""DuckDB SQL for each registered query (the correctness oracle).

The fixture views are spelled out as CTEs in DuckDB's dialect.  Dialect
notes: DuckDB decimal literals are cast to DOUBLE, integer sums cast to
BIGINT, ``strftime`` stands in for ``date_format``, hex parsing goes through
``'0x' || … ::BIGINT``.

Training queries are checked against what a model gives that learned the
rule of the training rows exactly (a threshold on one feature; max_bins
covers every distinct value).  Hold-out rows have another rule, so the
answer is the share where both agree: a model that saw hold-out rows, or
learned nothing, gives another one.
"""

from __future__ import annotations

OBS = """obs AS (
  SELECT md5(cast(l_suppkey AS varchar)) AS uid,
         cast(strftime(l_shipdate, '%Y%m%d') AS int) AS day,
         least(5, cast(floor((l_quantity - 1) / 10) AS int) + 1) AS stress,
         l_quantity AS f1, l_extendedprice AS f2, l_discount AS f3, l_tax AS f4,
         cast(l_linenumber AS double) AS f5,
         l_linestatus AS gender, l_returnflag AS race,
         ('0x' || substr(md5(concat_ws(':', cast(l_orderkey AS varchar), cast(l_partkey AS varchar),
              cast(l_suppkey AS varchar), cast(l_linenumber AS varchar), '42')), 1, 8))::BIGINT % 10000 AS bucket
  FROM lineitem)"""

SCORED = """scored AS (
  SELECT uid, day, race,
         CASE WHEN stress <= 2 THEN 0 ELSE 1 END AS label,
         CAST(CASE WHEN f1 / 51 <= 0.5 THEN 0 ELSE 1 END AS double) AS prediction,
         f1 / 51 AS p1
  FROM obs WHERE bucket >= 8000)"""

SCORED_TWO = """scored_two AS (
  SELECT r.model, o.uid, o.day, o.race,
         CASE WHEN o.stress <= 2 THEN 0 ELSE 1 END AS label,
         CAST(CASE WHEN o.f1 / r.d <= 0.5 THEN 0 ELSE 1 END AS double) AS prediction,
         o.f1 / r.d AS p1
  FROM obs o, (VALUES ('rule_a', CAST(51 AS DOUBLE)), ('rule_b', CAST(41 AS DOUBLE))) r(model, d)
  WHERE o.bucket >= 8000)"""

SCORED_ALL = SCORED.replace(" WHERE bucket >= 8000", "")

SCORED_TWO_ALL = SCORED_TWO.replace("  WHERE o.bucket >= 8000", "")

# label: the rule of the hold-out rows; learned: the rule of the training rows
TEST = """test AS (SELECT *, CASE WHEN stress <= 3 THEN 0 ELSE 1 END AS label,
                CASE WHEN stress <= 2 THEN 0 ELSE 1 END AS learned FROM obs WHERE bucket >= 8000)"""


def _hash(text: str) -> str:
    """32 bits of the stable hash of a lineitem row; ``text`` ends its key."""
    return f"""('0x' || substr(md5(concat_ws(':', cast(l_orderkey AS varchar), cast(l_partkey AS varchar),
        cast(l_suppkey AS varchar), cast(l_linenumber AS varchar), {text})), 1, 8))::BIGINT"""

MONTHLY = """SELECT substr(cast(day AS varchar), 1, 6) AS month,
       avg(CAST(label = prediction AS INT)) AS accuracy, count(*) AS total_samples
FROM scored GROUP BY 1"""


_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
# Rows with their places in the splits of two seeds and the lanes of their digest.
_ROW_TEXT = ", ".join(f"coalesce(length({k}::varchar)::varchar || ':' || {k}::varchar, '-')" for k in _KEYS)
_SPLIT_ROWS = f"""WITH r AS (
  SELECT l_linenumber, {_hash("'42', 'split'")} AS h42, {_hash("'7', 'split'")} AS h7,
         {", ".join(f"('0x' || substr(d, {8 * k + 1}, 8))::BIGINT AS l{k}" for k in range(4))}
  FROM (SELECT *, md5(concat_ws(',', {_ROW_TEXT})) AS d FROM lineitem))"""


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# Expectations of a model that learned the training rule.
def _perfect_confusion(model: str) -> str:
    return _w(OBS, TEST) + f"""
SELECT '{model}' AS model, CAST(a.c AS DOUBLE) AS actual, CAST(p.c AS DOUBLE) AS predicted,
       CAST(sum(CASE WHEN t.label = a.c AND t.learned = p.c THEN 1 ELSE 0 END) AS BIGINT) AS n
FROM (VALUES (0), (1)) a(c), (VALUES (0), (1)) p(c), test t
GROUP BY a.c, p.c"""


HIST_BINS = 30


def _hist_edge(i: str) -> str:
    return (f"CASE WHEN {i} >= {HIST_BINS} THEN hi ELSE lo + CAST({i} AS DOUBLE) * "
            f"((hi - lo) / CAST({HIST_BINS} AS DOUBLE)) END")


KDE_GRID = 21



def _kde(rows: str, keys: str, cut: int, scale: str, decimals: int) -> str:
    return f""",
d AS ({rows}),
st AS (SELECT k, count(*) AS n, stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), CAST(-0.2 AS DOUBLE)) AS h, min(x) AS mn, max(x) AS mx
       FROM d GROUP BY k),
bw AS (SELECT k, n, h, CAST({scale} AS DOUBLE) AS scale, mn - CAST({cut} AS DOUBLE) * h AS lo, mx + CAST({cut} AS DOUBLE) * h AS hi FROM st),
gx AS (SELECT k, n, h, scale, CAST(range AS INT) AS point,
              CASE WHEN range = {KDE_GRID - 1} THEN hi
                   ELSE lo + CAST(range AS DOUBLE) * ((hi - lo) / CAST({KDE_GRID - 1} AS DOUBLE)) END AS gx
       FROM bw, range(0, {KDE_GRID}))
SELECT {keys.replace('k AS', 'gx.k AS')}gx.point, round(gx.gx, {decimals}) AS x,
       round(gx.scale * sum(exp(CAST(-0.5 AS DOUBLE) * ((gx.gx - d.x) / gx.h) * ((gx.gx - d.x) / gx.h)))
             / (gx.n * gx.h * sqrt(2 * pi())), {decimals}) AS density
FROM gx JOIN d ON gx.k IS NOT DISTINCT FROM d.k
GROUP BY gx.k, gx.point, gx.gx, gx.n, gx.h, gx.scale""".replace("\n,\nd AS", ",\nd AS")


# Feature slot names of the fixture, in assembler order (fixed values).
FEATURES = ["f1", "f2", "f3", "f4", "f5", "gender_index", "race_index"]

_GBT_IMPORTANCE = ("SELECT feature, CAST(CASE WHEN feature = 'f1' THEN 1 ELSE 0 END AS DOUBLE) AS importance "
                   "FROM (VALUES " + ", ".join(f"('{f}')" for f in FEATURES) + ") v(feature)")

_GRID_ROWS = """(VALUES (0, 'RF', 'Trees:10, Depth:3', 10, 3, NULL), (1, 'RF', 'Trees:10, Depth:6', 10, 6, NULL),
        (2, 'RF', 'Trees:50, Depth:3', 50, 3, NULL), (3, 'RF', 'Trees:50, Depth:6', 50, 6, NULL),
        (0, 'GBT', 'Depth:3, Iter:10', NULL, 3, 10), (1, 'GBT', 'Depth:3, Iter:25', NULL, 3, 25),
        (2, 'GBT', 'Depth:6, Iter:10', NULL, 6, 10), (3, 'GBT', 'Depth:6, Iter:25', NULL, 6, 25))
        g(seq, model, params, trees, depth, iters)"""

# accuracy of the training rule on the hold-out, from the data
_PERFECT_ACC = "(SELECT avg(CAST(label = learned AS INT)) FROM test)"

# The first boosted tree splits where the sum of squared label sums over
# counts is largest; many trees learn the bands of the training rows.
# A forest of one feature has trees that agree with such a tree.
_BANDED = """, p AS (
  SELECT f1, CASE WHEN bucket < 6000 THEN 'train' WHEN bucket < 8000 THEN 'validation' ELSE 'test' END AS part,
         CAST(f1 > 33 OR (f1 > 8 AND f1 <= 20) AS INT) AS learned,
         CAST(CASE WHEN bucket < 6000 THEN f1 > 33 OR (f1 > 8 AND f1 <= 20)
                   WHEN bucket < 8000 THEN f1 > 30 OR (f1 > 8 AND f1 <= 20)
                   ELSE f1 > 33 OR (f1 > 10 AND f1 <= 20) END AS INT) AS label FROM obs),
h AS (SELECT f1 AS v, count(*) AS n, sum(2 * label - 1) AS s FROM p WHERE part = 'train' GROUP BY f1),
root AS (SELECT arg_max(cut, gain) AS cut FROM (
  SELECT a.v AS cut, pow(sum(CASE WHEN b.v <= a.v THEN b.s ELSE 0 END), 2) / sum(CASE WHEN b.v <= a.v THEN b.n ELSE 0 END)
                     + pow(sum(CASE WHEN b.v > a.v THEN b.s ELSE 0 END), 2) / sum(CASE WHEN b.v > a.v THEN b.n ELSE 0 END) AS gain
  FROM h a, h b WHERE a.v < (SELECT max(v) FROM h) GROUP BY a.v)),
sided AS (SELECT h.*, v > cut AS side FROM h, root),
second AS (SELECT side, arg_max(cut, gain) AS cut FROM (
  SELECT a.side, a.v AS cut, pow(sum(CASE WHEN b.v <= a.v THEN b.s ELSE 0 END), 2) / sum(CASE WHEN b.v <= a.v THEN b.n ELSE 0 END)
                             + pow(sum(CASE WHEN b.v > a.v THEN b.s ELSE 0 END), 2) / sum(CASE WHEN b.v > a.v THEN b.n ELSE 0 END) AS gain
  FROM sided a JOIN sided b ON a.side = b.side
  WHERE a.v < (SELECT max(c.v) FROM sided c WHERE c.side = a.side) GROUP BY a.side, a.v) GROUP BY side),
one AS (SELECT side, sum(s) > 0 AS yes FROM sided GROUP BY side),
two AS (SELECT side, v <= cut AS low, sum(s) > 0 AS yes FROM sided JOIN second USING (side) GROUP BY ALL),
q AS (SELECT p.part, p.label, p.learned, CAST(one.yes AS INT) AS by_one, CAST(two.yes AS INT) AS by_two
      FROM p, root JOIN one ON one.side = (p.f1 > root.cut) JOIN second ON second.side = (p.f1 > root.cut)
      JOIN two ON two.side = (p.f1 > root.cut) AND two.low = (p.f1 <= second.cut))"""

_BANDED_ACC = _BANDED + """,
g AS (SELECT * FROM (VALUES (0, 'RF', 'Trees:3, Depth:1', 3, 1, NULL), (1, 'RF', 'Trees:3, Depth:2', 3, 2, NULL), (2, 'RF', 'Trees:3, Depth:3', 3, 3, NULL),
                            (3, 'RF', 'Trees:9, Depth:1', 9, 1, NULL), (4, 'RF', 'Trees:9, Depth:2', 9, 2, NULL), (5, 'RF', 'Trees:9, Depth:3', 9, 3, NULL),
                            (6, 'GBT', 'Depth:1, Iter:1', NULL, 1, 1), (7, 'GBT', 'Depth:1, Iter:20', NULL, 1, 20),
                            (8, 'GBT', 'Depth:2, Iter:1', NULL, 2, 1), (9, 'GBT', 'Depth:2, Iter:20', NULL, 2, 20))
      x(seq, model, params, trees, depth, iters)),
acc AS (SELECT seq, model, params, trees, depth, iters, part,
               avg(CAST(label = CASE WHEN iters = 20 OR depth = 3 THEN learned WHEN depth = 1 THEN by_one ELSE by_two END AS INT)) AS a
        FROM q, g GROUP BY ALL)"""


ORACLE: dict[str, str] = {
    "flagship_accuracy_by_month": _w(OBS, TEST) + """
SELECT substr(cast(day AS varchar), 1, 6) AS month, avg(CAST(label = learned AS INT)) AS accuracy,
       count(*) AS total_samples FROM test GROUP BY 1""",

    "scan_parquet": _w(OBS, SCORED_TWO_ALL) + """
SELECT model, label, count(*) AS n, sum(prediction) AS pred_pos
FROM scored_two GROUP BY model, label""",

    "table_replace": _w(OBS, SCORED_TWO_ALL) + """
SELECT model, label, count(*) AS n, sum(prediction) AS pred_pos, CAST(2 AS INT) AS version, true AS failed
FROM scored_two WHERE label = 1 GROUP BY model, label""",

    "scan_merged": """
SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS k, count(*) FILTER (l_linenumber <= 2) AS n_q,
       CAST(sum(l_quantity) FILTER (l_linenumber <= 2) AS DOUBLE) AS q, count(l_tax) FILTER (l_linenumber >= 2) AS n_tax,
       round(sum(l_tax) FILTER (l_linenumber >= 2), 6) AS tax, count(*) FILTER (l_linenumber <> 2) AS n_d,
       strftime(max(l_shipdate) FILTER (l_linenumber <> 2), '%Y-%m-%d') AS d, 'bigint,double,timestamp_ntz' AS types
FROM lineitem""",

    "csv_quarantine": """
SELECT CASE l_linenumber WHEN 3 THEN 'q is no double' WHEN 4 THEN 'n is no int' WHEN 5 THEN 'not 3 fields' ELSE '' END AS reason,
       count(*) AS lines, CAST(sum(l_orderkey) AS BIGINT) AS k,
       CAST(sum(l_quantity) FILTER (l_linenumber NOT IN (3, 4, 5)) AS DOUBLE) AS q
FROM lineitem GROUP BY 1""",

    "scan_csv": "SELECT n_nationkey, n_name, n_regionkey FROM nation",

    "scan_csv_inferred": "SELECT n_nationkey, n_name, n_regionkey, n_nationkey + 1 AS next_key FROM nation",

    "scan_csv_headerless": _w(OBS, SCORED) + MONTHLY.replace("total_samples", "samples"),

    "binarize_label": _w(OBS) + """
SELECT stress, CASE WHEN stress <= 2 THEN 0 ELSE 1 END AS label, count(*) AS n FROM obs GROUP BY 1, 2""",

    "binarize_label_null": _w(OBS) + """
SELECT s AS stress, CASE WHEN s <= 2 THEN 0 ELSE 1 END AS label, count(*) AS n
FROM (SELECT CASE WHEN f4 = 0 THEN NULL ELSE stress END AS s FROM obs) GROUP BY 1, 2""",

    "correct_flag": _w(OBS, SCORED_ALL) + """
SELECT label, prediction, CAST(label = prediction AS INT) AS correct, count(*) AS n
FROM scored GROUP BY 1, 2, 3""",

    "accuracy_null_pred": _w(OBS) + """
SELECT avg(CAST(label = prediction AS INT)) AS accuracy, count(*) AS samples, count(prediction) AS scored
FROM (SELECT CASE WHEN stress <= 2 THEN 0 ELSE 1 END AS label,
             CASE WHEN f3 = 0 THEN NULL ELSE CAST(CASE WHEN f1 / 51 <= 0.5 THEN 0 ELSE 1 END AS double) END
               AS prediction
      FROM obs)""",

    "prediction_project": _w(OBS, SCORED_ALL) + "SELECT uid, day, label, prediction, p1 FROM scored",

    "prediction_preview": _w(OBS, SCORED) + """
SELECT uid, day, p1, label, prediction FROM scored ORDER BY uid, day, p1, label, prediction LIMIT 10""",

    # shares of 2**32: 0.3, 0.00375, 0.8
    "sample_hash": f"""
SELECT count(*) AS n, sum(l_quantity) AS sum_qty, CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey
FROM lineitem WHERE {_hash("'7', 'sample'")} < 1288490189""",

    "sample_fine": f"""
SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey
FROM lineitem WHERE {_hash("'7', 'sample'")} < 16106127""",

    "sample_then_split": f"""
SELECT CASE WHEN {_hash("'42', 'split'")} < 3435973837 THEN 'train' ELSE 'test' END AS part, count(*) AS n,
       CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey
FROM lineitem WHERE {_hash("'42', 'sample'")} < 1288490189 GROUP BY 1""",

    "split_fingerprint": _SPLIT_ROWS + """
SELECT coalesce(part, 'all') AS part, count(*) AS rows,
       concat_ws('-', CAST(sum(l0) AS varchar), CAST(sum(l1) AS varchar), CAST(sum(l2) AS varchar), CAST(sum(l3) AS varchar)) AS digest
FROM (SELECT CASE WHEN h42 < 3435973837 THEN 'train' ELSE 'test' END AS part, * FROM r) GROUP BY GROUPING SETS ((part), ())""",

    "split_check": _SPLIT_ROWS + """, c AS (
  SELECT 'same' AS "case", h42 < 3435973837 AS t, h42 >= 3435973837 AS h, * FROM r
  UNION ALL SELECT 'other seed', h42 < 3435973837, h7 >= 3435973837, * FROM r
  UNION ALL SELECT 'smaller share', h42 < 3435973837, h42 >= 3865470566, * FROM r
  UNION ALL SELECT 'changed file', h42 < 3435973837, h42 >= 3435973837, * FROM r WHERE l_linenumber < 7
  UNION ALL SELECT 'holdout only', h42 < 3435973837, true, * FROM r WHERE h42 >= 3435973837),
saved AS (SELECT count(*) AS n, sum(l0) AS s0, sum(l1) AS s1, sum(l2) AS s2, sum(l3) AS s3 FROM r WHERE h42 < 3435973837),
f AS (SELECT "case", count(*) FILTER (t) AS training_rows, coalesce(sum(l0) FILTER (t), 0) AS d0, coalesce(sum(l1) FILTER (t), 0) AS d1,
             coalesce(sum(l2) FILTER (t), 0) AS d2, coalesce(sum(l3) FILTER (t), 0) AS d3,
             count(*) FILTER (h) AS holdout_rows, count(*) FILTER (t AND h) AS seen, count(*) FILTER (NOT t AND NOT h) AS left_out
      FROM c GROUP BY "case"),
g AS (SELECT *, training_rows = n AND d0 = s0 AND d1 = s1 AND d2 = s2 AND d3 = s3 AS same_training FROM f, saved)
SELECT "case", training_rows, same_training, holdout_rows, seen, left_out,
       seen = 0 AND ("case" = 'holdout only' OR (same_training AND left_out = 0)) AS ok FROM g""",

    "sample_bernoulli": "SELECT count(*) AS n_all, CAST(0 AS BIGINT) AS n_not_in_input, true AS size_ok FROM lineitem",

    "split_random": "SELECT count(*) AS n_parts, CAST(0 AS BIGINT) AS n_lost, true AS size_ok FROM lineitem",

    "split_hash": _w(OBS) + """
SELECT CASE WHEN bucket < 8000 THEN 'train' ELSE 'test' END AS part, count(*) AS n, sum(f1) AS sum_f1
FROM obs GROUP BY 1""",

    "holdout_hash": f"""
SELECT l_returnflag, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS sum_linenumber
FROM lineitem WHERE {_hash("'42', 'split'")} >= 3435973837 GROUP BY 1""",

    "month_key": _w(OBS) + "SELECT substr(cast(day AS varchar), 1, 6) AS month, count(*) AS n FROM obs GROUP BY 1",

    "month_label": _w(OBS) + """
SELECT month, substr(month, 1, 4) || '-' || substr(month, 5) AS month_label, n
FROM (SELECT substr(cast(day AS varchar), 1, 6) AS month, count(*) AS n FROM obs GROUP BY 1)""",

    "accuracy_by_month": _w(OBS, SCORED) + MONTHLY,

    "accuracy_by_user": _w(OBS, SCORED) + """
SELECT uid, avg(CAST(label = prediction AS INT)) AS accuracy, count(*) AS samples
FROM scored GROUP BY uid""",

    "accuracy_by_category": _w(OBS, SCORED) + """
SELECT race, avg(CAST(label = prediction AS INT)) AS accuracy FROM scored GROUP BY race""",

    "accuracy_overall": _w(OBS, SCORED_TWO) + """
SELECT model, avg(CAST(label = prediction AS INT)) AS accuracy, count(*) AS samples
FROM scored_two GROUP BY model""",

    "accuracy_grouping_sets": _w(OBS, SCORED) + """
SELECT CASE WHEN grouping(month) = 0 THEN 'month' WHEN grouping(uid) = 0 THEN 'uid'
            WHEN grouping(race) = 0 THEN 'race' ELSE 'all' END AS dim,
       CASE WHEN grouping(month) = 0 THEN month WHEN grouping(uid) = 0 THEN uid
            WHEN grouping(race) = 0 THEN race END AS value,
       avg(CAST(label = prediction AS INT)) AS accuracy, count(*) AS samples
FROM (SELECT *, substr(cast(day AS varchar), 1, 6) AS month FROM scored)
GROUP BY GROUPING SETS ((month), (uid), (race), ())""",

    "state_accuracy": _w(OBS, SCORED_TWO) + """
SELECT model, CASE WHEN grouping(month) = 0 THEN 'month' WHEN grouping(race) = 0 THEN 'race' ELSE 'all' END AS dim,
       CASE WHEN grouping(month) = 0 THEN month WHEN grouping(race) = 0 THEN race END AS value,
       avg(CAST(label = prediction AS INT)) AS accuracy, count(*) AS samples
FROM (SELECT *, substr(cast(day AS varchar), 1, 6) AS month FROM scored_two)
GROUP BY GROUPING SETS ((model, month), (model, race), (model))""",

    "row_counts": _w(OBS) + """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE bucket >= 8000) AS test_rows,
       count(*) FILTER (WHERE bucket < 8000) AS train_rows FROM obs""",

    "confusion_matrix": _w(OBS, SCORED_TWO) + """,
classes AS (SELECT DISTINCT model, c FROM (
    SELECT model, CAST(label AS DOUBLE) AS c FROM scored_two
    UNION ALL SELECT model, prediction AS c FROM scored_two) WHERE c IS NOT NULL),
grid AS (SELECT a.model, a.c AS actual, p.c AS predicted FROM classes a JOIN classes p USING (model)),
counts AS (SELECT model, CAST(label AS DOUBLE) AS actual, prediction AS predicted, count(*) AS n
           FROM scored_two WHERE prediction IS NOT NULL GROUP BY 1, 2, 3)
SELECT g.model, g.actual, g.predicted, coalesce(c.n, 0) AS n
FROM grid g LEFT JOIN counts c USING (model, actual, predicted)""".replace("\n,\nclasses", ",\nclasses"),

    "confusion_pivot": _w(OBS, SCORED) + """
SELECT CAST(label AS DOUBLE) AS actual,
       count(*) FILTER (WHERE prediction = 0) AS pred_0, count(*) FILTER (WHERE prediction = 1) AS pred_1,
       count(*) FILTER (WHERE prediction IS NULL OR prediction NOT IN (0, 1)) AS pred_other
FROM scored GROUP BY 1""",

    "confusion_other": _w(OBS) + """
SELECT CASE WHEN label IN (0, 1) THEN CAST(label AS DOUBLE) END AS actual,
       count(*) FILTER (WHERE prediction = 0) AS pred_0, count(*) FILTER (WHERE prediction = 1) AS pred_1,
       count(*) FILTER (WHERE prediction IS NULL OR prediction NOT IN (0, 1)) AS pred_other
FROM (SELECT stress % 3 AS label, CASE WHEN f3 > 0 THEN f5 % 4 END AS prediction FROM obs) GROUP BY 1""",

    "confusion_many_classes": """
WITH d AS (SELECT l_orderkey % 1100 AS a, l_partkey * 7 % 1100 AS p FROM lineitem),
c AS (SELECT a AS c FROM d UNION SELECT p FROM d)
SELECT (SELECT count(*) * count(*) FROM c) AS cells, count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT a, p FROM d)) AS filled,
       CAST(sum(a) AS DOUBLE) AS by_actual, CAST(sum(p) AS DOUBLE) AS by_predicted FROM d""",

    "evaluator_accuracy": _w(OBS, SCORED_ALL) + "SELECT avg(CAST(label = prediction AS INT)) AS accuracy FROM scored",

    "class1_probability": _w(OBS, SCORED_ALL) + "SELECT uid, day, p1 AS p_class1 FROM scored",

    "confidence_max": _w(OBS, SCORED_ALL) + "SELECT uid, day, greatest(1 - p1, p1) AS confidence FROM scored",

    "threshold_decision": _w(OBS, SCORED_ALL) + """
SELECT label, CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS decision, count(*) AS n FROM scored GROUP BY 1, 2""",

    "confidence_histogram": _w(OBS, SCORED) + f""",
v AS (SELECT greatest(1 - p1, p1) AS x FROM scored),
r AS (SELECT min(x) AS mn, max(x) AS mx FROM v),
s AS (SELECT CASE WHEN mn = mx THEN mn - CAST(0.5 AS DOUBLE) ELSE mn END AS lo,
             CASE WHEN mn = mx THEN mx + CAST(0.5 AS DOUBLE) ELSE mx END AS hi FROM r),
b0 AS (SELECT x, lo, hi,
              least(CAST(floor((x - lo) * (CAST({HIST_BINS} AS DOUBLE) / (hi - lo))) AS INT), {HIST_BINS - 1}) AS i0
       FROM v, s),
b AS (SELECT i0 - CASE WHEN x < {_hist_edge('i0')} THEN 1 ELSE 0 END
             + CASE WHEN x >= {_hist_edge('(i0 + 1)')} AND i0 <> {HIST_BINS - 1} THEN 1 ELSE 0 END AS bin
      FROM b0),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
g AS (SELECT CAST(range AS INT) AS bin, lo, hi FROM s, range(0, {HIST_BINS}))
SELECT g.bin, {_hist_edge('g.bin')} AS bin_lo, {_hist_edge('(g.bin + 1)')} AS bin_hi, coalesce(c.n, 0) AS n
FROM g LEFT JOIN c USING (bin)""".replace("\n,\nv AS", ",\nv AS"),

    "probability_kde": _w(OBS, SCORED_TWO) + f""",
d AS (SELECT model, p1 AS x FROM scored_two),
st AS (SELECT model, count(*) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM d GROUP BY model),
bw AS (SELECT model, n, sd * pow(CAST(n AS DOUBLE), CAST(-0.2 AS DOUBLE)) AS h, mn, mx FROM st),
bw2 AS (SELECT model, n, h, mn - CAST(3 AS DOUBLE) * h AS lo, mx + CAST(3 AS DOUBLE) * h AS hi
        FROM bw WHERE n >= 2 AND h > 0),
gx AS (SELECT model, n, h, CAST(range AS INT) AS point,
              CASE WHEN range = {KDE_GRID - 1} THEN hi
                   ELSE lo + CAST(range AS DOUBLE) * ((hi - lo) / CAST({KDE_GRID - 1} AS DOUBLE)) END AS gx
       FROM bw2, range(0, {KDE_GRID}))
SELECT gx.model, gx.point, round(gx.gx, 6) AS x,
       round(sum(exp(CAST(-0.5 AS DOUBLE) * ((gx.gx - d.x) / gx.h) * ((gx.gx - d.x) / gx.h)))
             / (gx.n * gx.h * sqrt(2 * pi())), 6) AS density
FROM gx JOIN d USING (model)
GROUP BY gx.model, gx.point, gx.gx, gx.n, gx.h""".replace("\n,\nd AS", ",\nd AS"),

    "histogram_by_group": _w(OBS) + f""",
v AS (SELECT CASE WHEN f4 > 0 THEN gender END AS gender, f1 / 51 AS x FROM obs),
s AS (SELECT gender, min(x) AS lo, max(x) AS hi FROM v GROUP BY gender),
b0 AS (SELECT v.gender, x, lo, hi,
              least(CAST(floor((x - lo) * (CAST({HIST_BINS} AS DOUBLE) / (hi - lo))) AS INT), {HIST_BINS - 1}) AS i0
       FROM v JOIN s ON v.gender IS NOT DISTINCT FROM s.gender),
b AS (SELECT gender, i0 - CASE WHEN x < {_hist_edge('i0')} THEN 1 ELSE 0 END
             + CASE WHEN x >= {_hist_edge('(i0 + 1)')} AND i0 <> {HIST_BINS - 1} THEN 1 ELSE 0 END AS bin
      FROM b0),
c AS (SELECT gender, bin, count(*) AS n FROM b GROUP BY ALL),
g AS (SELECT gender, CAST(range AS INT) AS bin, lo, hi FROM s, range(0, {HIST_BINS}))
SELECT g.gender, g.bin, {_hist_edge('g.bin')} AS bin_lo, {_hist_edge('(g.bin + 1)')} AS bin_hi, coalesce(c.n, 0) AS n
FROM g LEFT JOIN c ON g.gender IS NOT DISTINCT FROM c.gender AND g.bin = c.bin""".replace("\n,\nv AS", ",\nv AS"),

    "kde_by_group": _w(OBS) + _kde("SELECT CASE WHEN f4 > 0 THEN gender END AS k, f1 / 51 AS x FROM obs", "k AS gender, ", 3, "1", 6),

    "kde_tolerance": _w(OBS) + _kde("SELECT CASE WHEN f4 > 0 THEN race END AS k, f2 / 1000 AS x FROM obs", "k AS race, ", 3, "1", 7),

    "histogram_distinct": _w(OBS) + f""",
v AS (SELECT CASE WHEN f4 > 0 THEN race END AS race, f2 / 1000 AS x FROM obs),
s AS (SELECT race, min(x) AS lo, max(x) AS hi FROM v GROUP BY race),
b0 AS (SELECT v.race, x, lo, hi,
              least(CAST(floor((x - lo) * (CAST({HIST_BINS} AS DOUBLE) / (hi - lo))) AS INT), {HIST_BINS - 1}) AS i0
       FROM v JOIN s ON v.race IS NOT DISTINCT FROM s.race),
b AS (SELECT race, i0 - CASE WHEN x < {_hist_edge('i0')} THEN 1 ELSE 0 END
             + CASE WHEN x >= {_hist_edge('(i0 + 1)')} AND i0 <> {HIST_BINS - 1} THEN 1 ELSE 0 END AS bin
      FROM b0),
c AS (SELECT race, bin, count(*) AS n FROM b GROUP BY ALL),
g AS (SELECT race, CAST(range AS INT) AS bin, lo, hi FROM s, range(0, {HIST_BINS}))
SELECT g.race, g.bin, round({_hist_edge('g.bin')}, 9) AS bin_lo, coalesce(c.n, 0) AS n
FROM g LEFT JOIN c ON g.race IS NOT DISTINCT FROM c.race AND g.bin = c.bin""".replace("\n,\nv AS", ",\nv AS"),

    "confidence_overlay": _w(OBS, SCORED_ALL) + _kde("SELECT 0 AS k, greatest(1 - p1, p1) AS x FROM scored", "", 0, "(mx - mn) * n / 30", 4),

    "worst_users_top10": _w(OBS, SCORED) + """
SELECT uid, avg(CAST(label = prediction AS INT)) AS accuracy, count(*) AS samples
FROM scored GROUP BY uid ORDER BY accuracy, uid LIMIT 10""",

    "worst_users_report": _w(OBS, SCORED) + """
SELECT substr(uid, 1, 4) || '...' AS short_id, uid, round(accuracy * 100, 2) AS accuracy_pct,
       (SELECT round(avg(CAST(label = prediction AS INT)) * 100, 2) FROM scored) AS overall_pct
FROM (SELECT uid, avg(CAST(label = prediction AS INT)) AS accuracy
      FROM scored GROUP BY uid ORDER BY accuracy, uid LIMIT 5)""",

    "union_predictions": _w(OBS, SCORED_TWO_ALL) + """
SELECT model, label, prediction, count(*) AS n FROM scored_two GROUP BY 1, 2, 3""",

    "model_comparison": _w(OBS, SCORED_TWO_ALL) + """
SELECT model, round(acc * 100, 2) AS accuracy_pct, printf('%.2f%%', acc * 100) AS accuracy_text
FROM (SELECT model, avg(CAST(label = prediction AS INT)) AS acc FROM scored_two GROUP BY model)""",

    "string_index": _w(OBS) + """,
fitted AS (SELECT race, CAST(row_number() OVER (ORDER BY count(*) DESC, race) - 1 AS DOUBLE) AS index
           FROM obs WHERE bucket < 8000 AND race <> 'R' GROUP BY race)
SELECT t.race AS value, coalesce(index, (SELECT CAST(count(*) AS DOUBLE) FROM fitted)) AS index, count(*) AS n
FROM (SELECT CASE WHEN f4 > 0 THEN race END AS race FROM obs WHERE bucket >= 8000) t LEFT JOIN fitted USING (race)
GROUP BY ALL""".replace("\n,\nfitted", ",\nfitted"),

    "string_index_large": f"""WITH li AS (
  SELECT l_partkey, l_returnflag, l_tax, {_hash("'42'")} % 10000 AS bucket FROM lineitem),
train AS (SELECT * FROM li WHERE bucket < 8000 AND l_partkey % 10 <> 3),
p AS (SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, l_partkey::varchar) - 1 AS i FROM train GROUP BY l_partkey),
m AS (SELECT l_returnflag, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS i FROM train GROUP BY l_returnflag)
SELECT r.part, CAST(coalesce(p.i, (SELECT count(*) FROM p)) AS DOUBLE) AS part_index,
       CAST(coalesce(m.i, (SELECT count(*) FROM m)) AS DOUBLE) AS mode_index, count(*) AS n
FROM (SELECT CASE WHEN l_tax > 0 THEN l_partkey END AS part, l_returnflag FROM li WHERE bucket >= 8000) r
LEFT JOIN p ON p.l_partkey = r.part LEFT JOIN m ON m.l_returnflag = r.l_returnflag GROUP BY ALL""",

    "assemble_features": _w(OBS) + "SELECT uid, day, f1 AS v0, f2 AS v1, f3 AS v2, f4 AS v3, f5 AS v4 FROM obs",

    "assemble_skip": _w(OBS) + "SELECT count(*) AS n, sum(f1) AS sum_v0 FROM obs WHERE f4 <> 0",

    "standard_scale": _w(OBS) + """
SELECT uid, day, round(f1 / s1, 6) AS s0, round(f2 / s2, 6) AS s1, round(f3 / s3, 6) AS s2,
       round(f4 / s4, 6) AS s3, round(f5 / s5, 6) AS s4
FROM obs, (SELECT stddev_samp(f1) AS s1, stddev_samp(f2) AS s2, stddev_samp(f3) AS s3,
                  stddev_samp(f4) AS s4, stddev_samp(f5) AS s5 FROM obs)""",

    "rf_train_eval": _perfect_confusion("RF"),
    "gbt_train_eval": _perfect_confusion("GBT"),

    "score_two_models": _w(OBS, TEST) + """
SELECT m.model, label, CAST(learned AS DOUBLE) AS prediction, count(*) AS n
FROM test, (VALUES ('RF'), ('GBT')) m(model) GROUP BY 1, 2, 3""",

    "model_roundtrip": _w(OBS, TEST) + "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_diff FROM test",

    "grid_rf": _w(OBS, TEST) + f"SELECT model, params, {_PERFECT_ACC} AS accuracy FROM {_GRID_ROWS} WHERE model = 'RF'",
    "grid_gbt": _w(OBS, TEST) + f"SELECT model, params, {_PERFECT_ACC} AS accuracy FROM {_GRID_ROWS} WHERE model = 'GBT'",

    "grid_rf_large": _w(OBS, TEST) + f"""
SELECT 'RF' AS model, 'Trees:' || t || ', Depth:' || d AS params, {_PERFECT_ACC} AS accuracy
FROM (VALUES (10), (50), (100)) a(t), (VALUES (3), (5), (10)) b(d)""",
    "grid_gbt_large": _w(OBS, TEST) + f"""
SELECT 'GBT' AS model, 'Depth:' || d || ', Iter:' || i AS params, {_PERFECT_ACC} AS accuracy
FROM (VALUES (3), (5), (10)) a(d), (VALUES (10), (20), (50)) b(i)""",

    "staged_grid": _w(OBS) + _BANDED + """,
g AS (SELECT * FROM (VALUES (0, 'Depth:1, Iter:1', 1, 1), (1, 'Depth:1, Iter:20', 1, 20), (2, 'Depth:2, Iter:1', 2, 1),
                            (3, 'Depth:2, Iter:20', 2, 20)) x(seq, params, depth, iters)),
acc AS (SELECT seq, params, depth, iters, part,
               avg(CAST(label = CASE WHEN iters = 20 THEN learned WHEN depth = 1 THEN by_one ELSE by_two END AS INT)) AS a
        FROM q, g GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY a DESC, iters, depth) = 1 AS best FROM acc WHERE part = 'validation')
SELECT CAST(r.seq AS INT) AS seq, 'GBT' AS model, r.params, r.a AS accuracy, r.best AS chosen, CASE WHEN r.best THEN t.a END AS test_accuracy
FROM ranked r JOIN acc t ON t.part = 'test' AND t.seq = r.seq""",

    "grid_banded": _w(OBS) + _BANDED_ACC + """
SELECT CAST(seq AS INT) AS seq, model, params, a AS accuracy FROM acc WHERE part = 'test'""",

    "grid_cached": _w(OBS) + _BANDED + """
SELECT part, count(*) AS n, CAST(sum(label) AS DOUBLE) AS positives, true AS in_memory, true AS on_disk
FROM p WHERE part <> 'validation' GROUP BY part""",

    "grid_timing": """
SELECT model, CAST(runs AS BIGINT) AS runs, true AS timed, true AS within_run, true AS with_preparation, more_for_more
FROM (VALUES ('RF', 6, NULL), ('GBT', 4, true)) g(model, runs, more_for_more)""",

    "grid_shapes": """
SELECT params, CAST(trees AS INT) AS trees, CAST(depth AS INT) AS depth, true AS within
FROM (VALUES ('Trees:50, Depth:6', 50, 6), ('Depth:6, Iter:25', 25, 6), ('Depth:3, Iter:10', 10, 3)) g(params, trees, depth)""",

    "experiment_csv": _w(OBS, TEST) + f"SELECT model, params, {_PERFECT_ACC} AS accuracy, CAST(seq AS INT) AS seq FROM {_GRID_ROWS}",

    "importance_gbt": _GBT_IMPORTANCE,

    "importance_rf": "SELECT '[" + ", ".join(FEATURES) + "]' AS features, CAST(1 AS DOUBLE) AS total, 'f1' AS top",

    "importance_report": f"""
SELECT feature, importance, CASE WHEN mx > 0 THEN importance / mx END AS normalised,
       CASE WHEN importance IS NOT NULL THEN printf('%.1f%%', importance * 100) END AS percent
FROM (SELECT feature, importance, max(importance) OVER () AS mx FROM (
      {_GBT_IMPORTANCE}
      UNION ALL SELECT 'feature', NULL))""",

    "coerce_numeric": """
SELECT count(*) AS n, count(v) AS n_numeric, sum(v) AS sum_v
FROM (SELECT TRY_CAST(CASE WHEN l_linenumber = 1 THEN l_returnflag ELSE cast(l_quantity AS varchar) END AS DOUBLE) AS v
      FROM lineitem)""",

    "experiment_table": _w(OBS, TEST) + f"SELECT model, params, {_PERFECT_ACC} AS accuracy FROM {_GRID_ROWS}",

    "experiment_series": _w(OBS, TEST) + f"""
SELECT model, CAST(seq + 1 AS INT) AS step, params, {_PERFECT_ACC} AS accuracy FROM {_GRID_ROWS}""",

    "experiment_models": "SELECT model FROM (VALUES ('RF'), ('GBT')) m(model)",

    "params_parse": f"""
SELECT model, params, CAST(trees AS INT) AS trees, CAST(depth AS INT) AS depth, CAST(iters AS INT) AS iters
FROM {_GRID_ROWS}""",

    "asof_months": _w(OBS, SCORED_TWO) + """,
m AS (SELECT model, race, substr(cast(day AS varchar), 1, 6) AS month, avg(CAST(label = prediction AS INT)) AS accuracy
      FROM scored_two GROUP BY ALL)
SELECT a.race, a.month, a.accuracy, b.accuracy AS accuracy_asof, b.month AS month_asof
FROM (SELECT * FROM m WHERE model = 'rule_a') a
ASOF LEFT JOIN (SELECT * FROM m WHERE model = 'rule_b' AND CAST(substr(month, 5) AS INT) % 3 = 0) b
  ON a.race = b.race AND a.month >= b.month""".replace("\n,\nm AS", ",\nm AS"),

    "compare_runs": _w(OBS, TEST) + f"""
SELECT model, CAST(trees AS INT) AS trees, CAST(depth AS INT) AS depth, CAST(iters AS INT) AS iters,
       {_PERFECT_ACC} AS accuracy_local, {_PERFECT_ACC} AS accuracy_cluster FROM {_GRID_ROWS}""",
}

ORACLE["compare_runs_parts"] = _w(OBS) + _BANDED_ACC + """
SELECT t.model, CAST(t.trees AS INT) AS trees, CAST(t.depth AS INT) AS depth, CAST(t.iters AS INT) AS iters,
       t.a AS accuracy_test, v.a AS accuracy_validation
FROM acc t JOIN acc v USING (seq) WHERE t.part = 'test' AND v.part = 'validation'"""

ORACLE["source_guard"] = """
SELECT 'nation' AS source, true AS found, count(*) AS n_rows FROM nation
UNION ALL SELECT 'region_csv', true, count(*) FROM region
UNION ALL SELECT 'no_table', false, NULL UNION ALL SELECT 'no_csv', false, NULL"""

ORACLE["state_confusion"] = ORACLE["confusion_matrix"]
