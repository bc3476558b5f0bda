"""Queries: drift (PSI, CSI, attribution, retrain decision), data quality,
index weights, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as D
from ..operators import index as IX
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators import split as SP
from .oracle import sql
from .q_metrics import SCORED_SQL, bin_sql, d, scored
from .registry import R, query, rnd
from .tables import table

CUT = "1998-01-01"
FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _halves(df, ts="l_shipdate"):
    return (df.where(F.col(ts) < F.lit(CUT).cast("timestamp")),
            df.where(F.col(ts) >= F.lit(CUT).cast("timestamp")))


def psi_sql(long_cte: str, bins: int, bounds, by: list[str], min_rows: int = 0,
            name: str = "psi") -> str:
    """SQL twin of ``drift.psi_long``: ``long_cte`` defines ``lg(by.., side, x)``."""
    byc = ", ".join(by)
    byp = (byc + ", ") if by else ""
    on = " AND ".join([f"g.{b} = c.{b}" for b in by] + ["g.side = c.side", "g.bin = c.bin"])
    if bounds is None:
        lims = f", lim AS (SELECT {byp}min(x) AS lo, max(x) AS hi FROM src GROUP BY ALL)"
        join = f" JOIN lim USING ({byc})" if by else ", lim"
        binx = bin_sql("x", "lo", "hi", bins)
    else:
        lims, join = "", ""
        binx = bin_sql("x", d(float(bounds[0])), d(float(bounds[1])), bins)
    guard = ""
    if min_rows:
        guard = (f", ok AS (SELECT {byc} FROM n0 GROUP BY {byc} "
                 f"HAVING min(len) >= {min_rows} AND count(*) = 2)")
        src = f"src AS (SELECT * FROM lg WHERE ({byc}) IN (SELECT ({byc}) FROM ok))"
        n = f"n AS (SELECT * FROM n0 WHERE ({byc}) IN (SELECT ({byc}) FROM ok))"
    else:
        src, n = "src AS (SELECT * FROM lg)", "n AS (SELECT * FROM n0)"
    return f"""{long_cte},
n0 AS (SELECT {byp}side, count(*) AS len FROM lg GROUP BY ALL){guard},
{src}, {n}{lims},
b AS (SELECT {byp}side, CAST({binx} AS INTEGER) AS bin FROM src{join}),
c AS (SELECT {byp}side, bin, count(*) AS cnt FROM b WHERE bin IS NOT NULL GROUP BY ALL),
g AS (SELECT n.*, CAST(r.i AS INTEGER) AS bin FROM n, range(0, {bins}) r(i)),
p AS (SELECT {', '.join('g.' + b for b in by) + ', ' if by else ''}g.side, g.bin,
        CASE WHEN coalesce(c.cnt, 0) = 0 THEN 1e-4 ELSE c.cnt / g.len END AS p
      FROM g LEFT JOIN c ON {on}),
w AS (SELECT {byp}bin, max(p) FILTER (WHERE side = 'e') AS e, max(p) FILTER (WHERE side = 'a') AS a
      FROM p GROUP BY ALL),
{name} AS (SELECT {byp}round(sum((a - e) * ln(a / e)), 4) AS psi FROM w {'GROUP BY ' + byc if by else ''})"""


def flag_sql(c: str) -> str:
    return (f"CASE WHEN {c} < {d(0.1)} THEN 'stable' WHEN {c} < {d(0.2)} THEN 'minor_shift' "
            f"ELSE 'significant_drift' END")


_SCORE_LONG = f"""WITH {SCORED_SQL},
lg AS (SELECT CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN 'e' ELSE 'a' END AS side, score AS x
       FROM scored WHERE l_shipdate IS NOT NULL)"""


# --------------------------------------------------------------------- PSI
@query("score_psi")
def score_psi(spark, sf_dir):
    """Score PSI on fixed [0, 1] bins, baseline before / current after a
    ship date (A19, A20, P24)."""
    base, cur = _halves(scored(spark, sf_dir))
    return D.psi(base, cur, "score", 10, (0.0, 1.0))


sql("score_psi", psi_sql(_SCORE_LONG, 10, (0.0, 1.0), []) +
    f"\nSELECT psi, {flag_sql('psi')} AS flag FROM psi")


@query("score_psi_range")
def score_psi_range(spark, sf_dir):
    """Score PSI with bins over the data range of both sides."""
    base, cur = _halves(scored(spark, sf_dir))
    return D.psi(base, cur, "score", 10, None)


sql("score_psi_range", psi_sql(_SCORE_LONG, 10, None, []) +
    f"\nSELECT psi, {flag_sql('psi')} AS flag FROM psi")


_FEAT_LONG = f"""WITH li AS (SELECT l_shipdate, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FEATS)} FROM lineitem),
lg AS (SELECT CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN 'e' ELSE 'a' END AS side, feature, x
       FROM (UNPIVOT li ON {', '.join(FEATS)} INTO NAME feature VALUE x)
       WHERE l_shipdate IS NOT NULL AND x IS NOT NULL)"""


@query("feature_csi")
def feature_csi(spark, sf_dir):
    """Per-feature CSI over data-range bins, min-support guard, alarms."""
    base, cur = _halves(table(spark, sf_dir, "lineitem"))
    return D.csi(base, cur, FEATS, 10, 10)


sql("feature_csi", psi_sql(_FEAT_LONG, 10, None, ["feature"], min_rows=10) +
    f"\nSELECT feature, psi AS csi, {flag_sql('psi')} AS flag, psi > {d(0.25)} AS alarm FROM psi")


# ------------------------------------------------------------ attribution
def _importances(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn(
        "label", (F.col("l_returnflag") == "R").cast("int"))
    base, cur = _halves(li)

    def imp(df):
        r = M.label_correlation(df, FEATS, "label")
        pos = F.array_position(F.array(*[F.lit(f) for f in FEATS]), F.col("feature"))
        return r.select("feature", F.round(F.abs("r"), 4).alias("importance"), pos.alias("pos"))
    return imp(base), imp(cur)


@query("attribution_drift")
def attribution_drift(spark, sf_dir):
    """Rank shift and magnitude change of feature importances between an
    early and a late period (W8, J12, M8); importance = |r| with the label."""
    b, c = _importances(spark, sf_dir)
    return D.attribution_drift(b, c, "feature", "importance", "pos")


def _imp_sql(side_pred: str, name: str) -> str:
    parts = [f"""SELECT '{f}' AS feature, {i + 1} AS pos,
  round(abs(CASE WHEN stddev_pop({f}) = 0 OR stddev_pop(label) = 0 THEN 0.0
       ELSE covar_pop({f}, label) / (stddev_pop({f}) * stddev_pop(label)) END), 4) AS importance
  FROM li WHERE {side_pred}""" for i, f in enumerate(FEATS)]
    body = "\nUNION ALL\n".join(parts)
    return (f"{name} AS (SELECT *, row_number() OVER (ORDER BY importance DESC, pos) AS rk "
            f"FROM ({body}))")


_ATTR_CTE = f"""li AS (SELECT *, CAST(CAST(l_returnflag = 'R' AS INTEGER) AS DOUBLE) AS label FROM lineitem),
{_imp_sql(f"l_shipdate < TIMESTAMP '{CUT}'", 'bi')},
{_imp_sql(f"l_shipdate >= TIMESTAMP '{CUT}'", 'ci')},
det AS (SELECT bi.feature, bi.importance AS baseline_value, bi.rk AS baseline_rank,
          ci.importance AS current_value, ci.rk AS current_rank,
          abs(ci.rk - bi.rk) AS rank_shift,
          round(abs(ci.importance - bi.importance) / (bi.importance + {d(1e-9)}) * 100, 1) AS magnitude_change_pct,
          abs(ci.rk - bi.rk) > 3 AS rank_alarm,
          abs(ci.importance - bi.importance) / (bi.importance + {d(1e-9)}) > {d(0.5)} AS magnitude_alarm
        FROM bi JOIN ci ON bi.feature = ci.feature)"""

sql("attribution_drift", f"""WITH {_ATTR_CTE}
SELECT feature, baseline_value, baseline_rank, current_value, current_rank, rank_shift,
       magnitude_change_pct, rank_alarm, magnitude_alarm FROM det""")


@query("attribution_summary")
def attribution_summary(spark, sf_dir):
    b, c = _importances(spark, sf_dir)
    return D.attribution_summary(D.attribution_drift(b, c, "feature", "importance", "pos"))


_ATTR_SUM = """summ AS (SELECT count(*) FILTER (WHERE rank_alarm OR magnitude_alarm) AS n_alarmed,
  arg_min(feature, baseline_rank) AS top_feature_baseline,
  arg_min(feature, current_rank) AS top_feature_current FROM det)"""

sql("attribution_summary", f"""WITH {_ATTR_CTE}, {_ATTR_SUM}
SELECT n_alarmed, top_feature_baseline, top_feature_current,
  top_feature_baseline <> top_feature_current AS top_feature_changed,
  n_alarmed = 0 AND NOT (top_feature_baseline <> top_feature_current) AS all_ok FROM summ""")


@query("retrain_decision")
def retrain_decision(spark, sf_dir):
    """Score PSI + attribution drift -> retrain / warn decision (M9)."""
    base, cur = _halves(scored(spark, sf_dir))
    p = D.psi(base, cur, "score", 10, (0.0, 1.0))
    b, c = _importances(spark, sf_dir)
    summ = D.attribution_summary(D.attribution_drift(b, c, "feature", "importance", "pos"))
    quality = dq_report(spark, sf_dir).where("check = 'overall'").select(F.col("passed").alias("all_pass"))
    return D.retrain_decision(p, summ, quality)


# ----------------------------------------------------------------- quality
RUN_DATE = "2024-02-10"


def _event_panel(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), "user_id", "value", "props", "event_type",
        (F.col("event_type") == "error").cast("int").alias("is_error"))


@query("dq_report")
def dq_report(spark, sf_dir):
    """Freshness, null rates, coverage, activity floors, overall."""
    ev = _event_panel(spark, sf_dir)
    out = Q.dq_report(ev, "date", "user_id", ["value", "props", "event_type"], RUN_DATE,
                      None, {"value": 0.5, "is_error": 0.01})
    return out.select("check", rnd("metric"), "threshold", "passed")


_DQ_CTE = f"""
e AS (SELECT CAST(ts AS DATE) AS date, user_id, value, props, event_type,
                  CAST(event_type = 'error' AS INTEGER) AS is_error FROM events),
lt AS (SELECT * FROM e WHERE date = (SELECT max(date) FROM e)),
exp AS (SELECT count(DISTINCT user_id) AS n FROM e),
rows AS (
  SELECT 'freshness' AS "check", CAST(DATE '{RUN_DATE}' - (SELECT max(date) FROM e) AS DOUBLE) AS metric,
         {d(21.0)} AS threshold, (DATE '{RUN_DATE}' - (SELECT max(date) FROM e)) <= 21 AS passed
  UNION ALL SELECT 'null_rate:value', avg(CAST(value IS NULL AS DOUBLE)), {d(0.05)}, coalesce(avg(CAST(value IS NULL AS DOUBLE)) <= 0.05, false) FROM lt
  UNION ALL SELECT 'null_rate:props', avg(CAST(props IS NULL AS DOUBLE)), {d(0.05)}, coalesce(avg(CAST(props IS NULL AS DOUBLE)) <= 0.05, false) FROM lt
  UNION ALL SELECT 'null_rate:event_type', avg(CAST(event_type IS NULL AS DOUBLE)), {d(0.05)}, coalesce(avg(CAST(event_type IS NULL AS DOUBLE)) <= 0.05, false) FROM lt
  UNION ALL SELECT 'coverage', CAST(count(DISTINCT user_id) AS DOUBLE), (SELECT n FROM exp) * {d(0.9)},
         count(DISTINCT user_id) >= (SELECT n FROM exp) * {d(0.9)} FROM lt
  UNION ALL SELECT 'activity:value', avg(value), {d(0.5)}, coalesce(avg(value) >= {d(0.5)}, false) FROM lt
  UNION ALL SELECT 'activity:is_error', avg(CAST(is_error AS DOUBLE)), {d(0.01)}, coalesce(avg(CAST(is_error AS DOUBLE)) >= {d(0.01)}, false) FROM lt)"""

# the decision's quality input is the report's overall row
sql("retrain_decision", psi_sql(_SCORE_LONG, 10, (0.0, 1.0), []) + f""",
{_ATTR_CTE}, {_ATTR_SUM},
ok AS (SELECT n_alarmed = 0 AND top_feature_baseline = top_feature_current AS stable FROM summ),
{_DQ_CTE},
dq AS (SELECT bool_and(passed) AS passed FROM rows)
SELECT psi, {flag_sql('psi')} AS psi_flag, ok.stable AS attribution_stable,
  psi > {d(0.2)} AND NOT ok.stable AS retrain_triggered,
  psi > {d(0.2)} AND ok.stable AS psi_warning,
  NOT dq.passed AS data_quality_warning
FROM psi, ok, dq""")

sql("dq_report", f"""
WITH {_DQ_CTE}
SELECT "check", round(metric, {R}) AS metric, threshold, passed FROM rows
UNION ALL SELECT 'overall', NULL, NULL, bool_and(passed) FROM rows
""")


@query("null_rates")
def null_rates(spark, sf_dir):
    """Null percentage report on documents left-joined with labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    lab = table(spark, sf_dir, "labels")
    return Q.null_report(docs.join(lab, "doc_id", "left"))


_NR_COLS = ["doc_id", "lang", "source", "n_chars", "text", "quality", "toxic"]
sql("null_rates", """
WITH j AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, d.text, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
r AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(avg(CAST({c} IS NULL AS DOUBLE)) * 100, 2) AS null_pct FROM j"
    for c in _NR_COLS) + """)
SELECT "column", null_pct, null_pct > 20.0 AS flagged FROM r
""")


@query("profile")
def profile(spark, sf_dir):
    """Rows, distinct keys and date range in one pass."""
    ev = table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    return Q.profile(ev, "date", ["user_id", "event_type", "date"])


sql("profile", """
SELECT count(*) AS n_rows, min(CAST(ts AS DATE)) AS min_date, max(CAST(ts AS DATE)) AS max_date,
  count(DISTINCT user_id) AS n_user_id, count(DISTINCT event_type) AS n_event_type,
  count(DISTINCT CAST(ts AS DATE)) AS n_date FROM events
""")


@query("constraint_violations")
def constraint_violations(spark, sf_dir):
    """NOT NULL / UNIQUE / CHECK IN violations on orders (K8)."""
    o = table(spark, sf_dir, "orders")
    return Q.check_constraints(o, ["o_orderkey", "o_custkey"], ["o_orderkey"],
                               {"o_orderstatus": ["F", "O"]})


sql("constraint_violations", """
SELECT 'not_null:o_orderkey' AS constraint, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM orders WHERE o_orderkey IS NULL HAVING count(*) > 0
UNION ALL SELECT 'not_null:o_custkey', NULL, count(*) FROM orders WHERE o_custkey IS NULL HAVING count(*) > 0
UNION ALL SELECT 'unique:o_orderkey', CAST(o_orderkey AS VARCHAR), count(*) FROM orders GROUP BY o_orderkey HAVING count(*) > 1
UNION ALL SELECT 'check_in:o_orderstatus', o_orderstatus, count(*) FROM orders
  WHERE NOT coalesce(o_orderstatus IN ('F', 'O'), false) GROUP BY o_orderstatus
""")


# ------------------------------------------------------------------- index
def _cust_inputs(spark, sf_dir):
    """Per customer: balance and exact order total.  Pinned (reliable
    checkpoint) because the PCA fit, the bounds and the final projection are
    separate jobs that would otherwise each re-aggregate the orders."""
    from ..session import cut_lineage
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    tot = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("orders_total"))
    return cut_lineage(cust.join(tot, "c_custkey", "left"))


@query("pca_weights")
def pca_weights(spark, sf_dir):
    """PC1 weights of (balance, order total) over customers with both."""
    return IX.pca_weights_frame(_cust_inputs(spark, sf_dir), ["c_acctbal", "orders_total"])


sql("pca_weights", """
WITH o AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS t FROM orders GROUP BY 1),
x AS (SELECT c.c_acctbal AS a, o.t AS t FROM customer c LEFT JOIN o ON c.c_custkey = o.o_custkey
      WHERE c.c_acctbal IS NOT NULL AND o.t IS NOT NULL)
SELECT 0.5::DOUBLE AS w_c_acctbal, 0.5::DOUBLE AS w_orders_total,
  round((1 + abs(corr(a, t))) / 2 * 100, 1) AS pc1_share_pct, count(*) AS n_rows,
  'PCA PC1 loadings, abs normalised' AS method FROM x
""")


@query("minmax_index")
def minmax_index(spark, sf_dir):
    """Global min-max of both inputs (nulls as 0) and the PCA-weighted
    composite index (P17, P18, A30)."""
    x = _cust_inputs(spark, sf_dir)
    w = IX.pca_weights(x, ["c_acctbal", "orders_total"])["weights"]
    n = IX.minmax(x, ["c_acctbal", "orders_total"])
    out = IX.composite_index(n, {"c_acctbal_norm": w["c_acctbal"],
                                 "orders_total_norm": w["orders_total"]})
    return out.select("c_custkey", rnd("c_acctbal_norm"), rnd("orders_total_norm"),
                      "vulnerability_index")


sql("minmax_index", f"""
WITH o AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS t FROM orders GROUP BY 1),
x AS (SELECT c.c_custkey, coalesce(c.c_acctbal, 0.0) AS a, coalesce(o.t, 0.0) AS t
      FROM customer c LEFT JOIN o ON c.c_custkey = o.o_custkey),
b AS (SELECT min(a) AS alo, max(a) AS ahi, min(t) AS tlo, max(t) AS thi FROM x),
n AS (SELECT c_custkey, (a - alo) / (ahi - alo + {d(1e-9)}) AS an, (t - tlo) / (thi - tlo + {d(1e-9)}) AS tn FROM x, b)
SELECT c_custkey, round(an, {R}) AS c_acctbal_norm, round(tn, {R}) AS orders_total_norm,
  round({d(0.5)} * an + {d(0.5)} * tn, 4) AS vulnerability_index FROM n
""")


# -------------------------------------------------------------- splits
SPLITS = SP.shifted_splits(-20)


@query("split_summary")
def split_summary(spark, sf_dir):
    """Orders tagged with overlapping temporal splits; rows, positives and
    rate per split (P28, A29).  The reference split table moved 20 years
    back to lie over the order dates."""
    o = table(spark, sf_dir, "orders").withColumn(
        "label", (F.col("o_orderstatus") == "F").cast("int"))
    return Q.split_summary(SP.assign_splits(o, "o_orderdate", SPLITS), "split", "label")


def _split_sql() -> str:
    parts = []
    for n, lo, hi in SPLITS:
        cond = ["o_orderdate IS NOT NULL"]
        if lo:
            cond.append(f"CAST(o_orderdate AS DATE) >= DATE '{lo}'")
        if hi:
            cond.append(f"CAST(o_orderdate AS DATE) <= DATE '{hi}'")
        parts.append(f"SELECT '{n}' AS split, CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders WHERE {' AND '.join(cond)}")
    return ("WITH s AS (" + "\nUNION ALL\n".join(parts) + ")\n"
            "SELECT split, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_pos, round(avg(label), 4) AS pos_rate "
            "FROM s GROUP BY split")


sql("split_summary", _split_sql())


@query("time_folds")
def time_folds(spark, sf_dir):
    """Expanding-window folds over the training-split order dates."""
    o = table(spark, sf_dir, "orders").withColumn(
        "label", (F.col("o_orderstatus") == "F").cast("int"))
    train = SP.split_rows(SP.assign_splits(o, "o_orderdate", SPLITS), "split", ["train"])
    return SP.fold_summary(SP.time_folds(train, "o_orderdate", 5), "o_orderdate", "label")


sql("time_folds", f"""
WITH t AS (SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_orderstatus = 'F' AS INTEGER) AS label
           FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '{SPLITS[0][2]}'),
dd AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i FROM (SELECT DISTINCT date FROM t)),
sz AS (SELECT count(*) // 6 AS size FROM dd),
r AS (SELECT t.date, t.label, CAST(floor(dd.i / sz.size) AS INTEGER) AS blk FROM t JOIN dd USING (date), sz),
f AS (SELECT CAST(fold AS INTEGER) AS fold, 'train' AS role, date, label FROM r, range(1, 6) g(fold) WHERE blk < fold
      UNION ALL
      SELECT CAST(fold AS INTEGER), 'val', date, label FROM r, range(1, 6) g(fold) WHERE blk = fold)
SELECT fold, role, count(*) AS n_rows, count(DISTINCT date) AS n_dates, min(date) AS min_date,
       max(date) AS max_date, CAST(sum(label) AS BIGINT) AS n_pos FROM f GROUP BY fold, role
""")
