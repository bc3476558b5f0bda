"""Queries: classification metrics over a scored table.

The scored table is ``lineitem``: score = a [0, 1] value from quantity and
discount (550 distinct values, many ties), label = returned (flag 'R'),
group = line status (plays model x split).  The score expression is written
identically in Spark and SQL so both engines compute the same doubles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import ordering as O
from .oracle import sql
from .registry import R, query, rnd
from .tables import table

BY = ["l_linestatus"]


def scored(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    score = ((F.col("l_quantity") - 1) + 50 * F.round(F.col("l_discount") * 100, 0)) / F.lit(549.0)
    return li.select("l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate",
                     score.alias("score"),
                     (F.col("l_returnflag") == "R").cast("int").alias("label"))


def d(x: float) -> str:
    """A double literal for DuckDB (plain literals would be DECIMAL)."""
    return f"CAST({x!r} AS DOUBLE)"


SCORED_SQL = f"""scored AS (
  SELECT l_orderkey, l_linenumber, l_linestatus, l_shipdate,
         ((l_quantity - 1) + 50 * round(l_discount * 100, 0)) / {d(549.0)} AS score,
         CAST(l_returnflag = 'R' AS INTEGER) AS label
  FROM lineitem)"""

CURVE_SQL = f"""{SCORED_SQL},
sc AS (SELECT l_linestatus, score, count(*) FILTER (WHERE label = 1) AS pos,
              count(*) FILTER (WHERE label <> 1) AS neg
       FROM scored WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY 1, 2),
cp AS (SELECT *,
  sum(pos) OVER (PARTITION BY l_linestatus ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
  sum(neg) OVER (PARTITION BY l_linestatus ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
  sum(pos) OVER (PARTITION BY l_linestatus) AS P,
  sum(neg) OVER (PARTITION BY l_linestatus) AS N
  FROM sc)"""


@query("confusion_metrics")
def confusion_metrics(spark, sf_dir):
    return M.binary_metrics(scored(spark, sf_dir), "score", "label", 0.5, BY, beta=2.0)


def _zdiv(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


sql("confusion_metrics", f"""
WITH {SCORED_SQL},
a AS (SELECT l_linestatus,
  count(*) FILTER (WHERE score >= {d(0.5)} AND label = 1) AS tp0,
  count(*) FILTER (WHERE score >= {d(0.5)} AND NOT label = 1) AS fp0,
  count(*) FILTER (WHERE NOT score >= {d(0.5)} AND NOT label = 1) AS tn0,
  count(*) FILTER (WHERE NOT score >= {d(0.5)} AND label = 1) AS fn0,
  count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_positive
  FROM scored GROUP BY 1),
z AS (SELECT *, NOT ((tp0 + fp0 + fn0) > 0 AND (tn0 + fp0 + fn0) > 0) AS one FROM a),
c AS (SELECT l_linestatus, n_rows, n_positive,
  CASE WHEN one THEN 0 ELSE tp0 END AS tp, CASE WHEN one THEN 0 ELSE fp0 END AS fp,
  CASE WHEN one THEN 0 ELSE tn0 END AS tn, CASE WHEN one THEN 0 ELSE fn0 END AS fn FROM z)
SELECT l_linestatus, {d(0.5)} AS threshold, n_rows, n_positive, tp, fp, tn, fn,
  round({_zdiv('tp', 'tp + fp')}, 4) AS precision,
  round({_zdiv('tp', 'tp + fn')}, 4) AS recall,
  round({_zdiv(f'{d(2.0)} * tp', f'{d(1.0)} * (tp + fn) + (tp + fp)')}, 4) AS f1,
  round({_zdiv(f'{d(5.0)} * tp', f'{d(4.0)} * (tp + fn) + (tp + fp)')}, 4) AS f_beta
FROM c
""")


@query("roc_auc")
def roc_auc(spark, sf_dir):
    out = M.roc_auc(scored(spark, sf_dir), "score", "label", BY)
    return out.select(*BY, rnd("auc"))


sql("roc_auc", f"""
WITH {CURVE_SQL}
SELECT l_linestatus, round(sum(pos * (N - fp) + 0.5 * pos * neg) / (CAST(P AS DOUBLE) * N), {R}) AS auc
FROM cp GROUP BY l_linestatus, P, N
""")


@query("avg_precision")
def avg_precision(spark, sf_dir):
    out = M.average_precision(scored(spark, sf_dir), "score", "label", BY)
    return out.select(*BY, rnd("avg_precision"))


sql("avg_precision", f"""
WITH {CURVE_SQL}
SELECT l_linestatus, round(sum(CAST(pos AS DOUBLE) / P * (CAST(tp AS DOUBLE) / (tp + fp))), {R}) AS avg_precision
FROM cp WHERE P > 0 GROUP BY l_linestatus
""")


@query("pr_curve")
def pr_curve(spark, sf_dir):
    out = M.pr_curve(scored(spark, sf_dir), "score", "label", BY)
    return out.select(*BY, "threshold", rnd("precision"), rnd("recall"))


sql("pr_curve", f"""
WITH {CURVE_SQL}
SELECT l_linestatus, score AS threshold,
  round({_zdiv('tp', 'tp + fp')}, {R}) AS precision,
  round(CASE WHEN P = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / P END, {R}) AS recall
FROM cp
""")


@query("pick_threshold")
def pick_threshold(spark, sf_dir):
    curve = M.pr_curve(scored(spark, sf_dir), "score", "label", BY)
    out = M.pick_threshold(curve, 0.80, BY)
    return out.select(*BY, "threshold", rnd("precision"), rnd("recall"), "meets_target")


sql("pick_threshold", f"""
WITH {CURVE_SQL},
pc AS (SELECT l_linestatus, score AS threshold, {_zdiv('tp', 'tp + fp')} AS precision,
              CASE WHEN P = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / P END AS recall FROM cp),
best AS (SELECT l_linestatus, threshold, precision, recall, row_number() OVER (
           PARTITION BY l_linestatus ORDER BY precision DESC, threshold ASC) AS rn
         FROM pc WHERE recall >= {d(0.8)}),
near AS (SELECT l_linestatus, threshold, precision, recall, row_number() OVER (
           PARTITION BY l_linestatus ORDER BY abs(recall - {d(0.8)}) ASC, threshold ASC) AS rn FROM pc),
g AS (SELECT DISTINCT l_linestatus FROM pc)
SELECT g.l_linestatus,
  coalesce(b.threshold, n.threshold) AS threshold,
  round(coalesce(b.precision, n.precision), {R}) AS precision,
  round(coalesce(b.recall, n.recall), {R}) AS recall,
  b.threshold IS NOT NULL AS meets_target
FROM g LEFT JOIN best b ON b.l_linestatus = g.l_linestatus AND b.rn = 1
       LEFT JOIN near n ON n.l_linestatus = g.l_linestatus AND n.rn = 1
""")


@query("thr_sensitivity")
def thr_sensitivity(spark, sf_dir):
    return M.sensitivity(scored(spark, sf_dir), "score", "label", 0.5, M.DELTAS, BY)


def _sens_sql() -> str:
    rows = []
    for dlt in M.DELTAS:
        t = min(max(0.5 + dlt, 0.0), 1.0)
        rows.append(f"""SELECT l_linestatus, {d(round(dlt, 4))} AS delta, {d(round(t, 4))} AS threshold,
  round({_zdiv(f'count(*) FILTER (WHERE score >= {d(t)} AND label = 1)', 'count(*) FILTER (WHERE label = 1)')}, 4) AS recall,
  round({_zdiv(f'count(*) FILTER (WHERE score >= {d(t)} AND label = 1)', f'count(*) FILTER (WHERE score >= {d(t)})')}, 4) AS precision
FROM scored GROUP BY l_linestatus""")
    return f"WITH {SCORED_SQL}\n" + "\nUNION ALL\n".join(rows)


sql("thr_sensitivity", _sens_sql())


@query("thr_sweep")
def thr_sweep(spark, sf_dir):
    out = M.sweep(scored(spark, sf_dir), "score", "label", *M.SWEEP, by=BY)
    return out.select(*BY, "i", "threshold", rnd("precision"), rnd("recall"))


_lo, _hi, _n = M.SWEEP
sql("thr_sweep", f"""
WITH {SCORED_SQL},
grid AS (SELECT i, CASE WHEN i = {_n - 1} THEN {d(_hi)}
                        ELSE CAST(i AS DOUBLE) * {d((_hi - _lo) / (_n - 1))} + {d(_lo)} END AS threshold
         FROM range(0, {_n}) t(i)),
g AS (SELECT DISTINCT l_linestatus FROM scored WHERE score IS NOT NULL),
c AS (SELECT g.l_linestatus, grid.i, grid.threshold,
        (SELECT count(*) FROM scored s WHERE s.l_linestatus = g.l_linestatus AND s.score >= grid.threshold AND s.label = 1) AS tp,
        (SELECT count(*) FROM scored s WHERE s.l_linestatus = g.l_linestatus AND s.score >= grid.threshold) AS pp,
        (SELECT count(*) FROM scored s WHERE s.l_linestatus = g.l_linestatus AND s.score IS NOT NULL AND s.label = 1) AS P
      FROM g, grid)
SELECT l_linestatus, CAST(i AS INTEGER) AS i, threshold,
  round(CASE WHEN pp = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / pp END, {R}) AS precision,
  round(CASE WHEN pp = 0 THEN 0.0 ELSE {_zdiv('tp', 'P')} END, {R}) AS recall
FROM c
""")


@query("feature_corr")
def feature_corr(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn(
        "label", (F.col("l_returnflag") == "R").cast("int"))
    out = M.label_correlation(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "label")
    return out.select("feature", rnd("r"), "rank")


def _corr_sql() -> str:
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    parts = []
    for i, f in enumerate(feats):
        parts.append(f"""SELECT '{f}' AS feature, {i} AS pos,
  CASE WHEN stddev_pop({f}) = 0 OR stddev_pop(label) = 0 THEN 0.0
       ELSE covar_pop({f}, label) / (stddev_pop({f}) * stddev_pop(label)) END AS r FROM li""")
    return ("WITH li AS (SELECT *, CAST(CAST(l_returnflag = 'R' AS INTEGER) AS DOUBLE) AS label FROM lineitem),\n"
            "c AS (" + "\nUNION ALL\n".join(parts) + ")\n"
            f"SELECT feature, round(r, {R}) AS r, row_number() OVER (ORDER BY abs(r) DESC, pos) AS rank FROM c")


sql("feature_corr", _corr_sql())


@query("score_histogram")
def score_histogram(spark, sf_dir):
    """10 fixed bins on [0, 1] per group, empty bins kept."""
    return M.histogram(scored(spark, sf_dir), "score", 0.0, 1.0, 10, BY)


def bin_sql(x: str, lo: str, hi: str, n: int) -> str:
    """SQL twin of ``functions.columns.numpy_bin``."""
    step = f"(({hi}) - ({lo})) / {d(float(n))}"
    b0 = f"CAST(floor(({x} - ({lo})) / ({step})) AS BIGINT)"
    adj = (f"({b0} - CASE WHEN ({lo}) + CAST({b0} AS DOUBLE) * ({step}) > {x} THEN 1 ELSE 0 END"
           f" + CASE WHEN ({lo}) + CAST({b0} + 1 AS DOUBLE) * ({step}) <= {x} THEN 1 ELSE 0 END)")
    return (f"CASE WHEN {x} IS NULL OR {x} < ({lo}) OR {x} > ({hi}) THEN NULL "
            f"WHEN ({hi}) = ({lo}) OR {x} = ({hi}) THEN {n - 1} "
            f"ELSE least(greatest({adj}, 0), {n - 1}) END")


sql("score_histogram", f"""
WITH {SCORED_SQL},
b AS (SELECT l_linestatus, CAST({bin_sql('score', d(0.0), d(1.0), 10)} AS INTEGER) AS bin FROM scored),
cnt AS (SELECT l_linestatus, bin, count(*) AS count FROM b WHERE bin IS NOT NULL GROUP BY 1, 2),
grid AS (SELECT g.l_linestatus, CAST(r.i AS INTEGER) AS bin
         FROM (SELECT DISTINCT l_linestatus FROM scored) g, range(0, 10) r(i))
SELECT grid.l_linestatus, grid.bin, coalesce(cnt.count, 0) AS count
FROM grid LEFT JOIN cnt USING (l_linestatus, bin)
""")


@query("nearest_point")
def nearest_point(spark, sf_dir):
    """Curve point nearest to the default threshold 0.5 (T5)."""
    curve = M.pr_curve(scored(spark, sf_dir), "score", "label", BY)
    out = O.nearest_point(curve, "threshold", 0.5, BY)
    return out.select(*BY, "threshold", rnd("precision"), rnd("recall"))


sql("nearest_point", f"""
WITH {CURVE_SQL},
pc AS (SELECT l_linestatus, score AS threshold, {_zdiv('tp', 'tp + fp')} AS precision,
              CASE WHEN P = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / P END AS recall FROM cp)
SELECT l_linestatus, threshold, round(precision, {R}) AS precision, round(recall, {R}) AS recall FROM (
  SELECT *, row_number() OVER (PARTITION BY l_linestatus ORDER BY abs(threshold - {d(0.5)}), threshold) AS rn FROM pc)
WHERE rn = 1
""")
