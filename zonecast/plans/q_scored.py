"""Queries: stored models in the event stream, the shadow log of the same
events, scores on demand (X2-X6, J11, M4, M10, P19-P25).

Gold is one row per zone: its latest day's summed value and event count, and
its vulnerability (scaled mean value).  Two sets of stored models score it:

* boosted trees (calibrated) in production, a random forest as shadow, and
* two linear probability models, whose closed form SQL can repeat, so that the
  whole stream (counter, join, model, logs) has a SQL twin.

Both run through the same sink.  The events table is reduced once to one row
per zone and day; the stream reads it once more, as its source."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import candidates as CD
from ..operators import model_store as MS
from ..operators import panel as P
from ..operators import serving as SV
from ..session import cut_lineage, scratch_path
from ..streaming import cases as X
from ..streaming import scoring as SC
from .oracle import sql
from .q_stream import _events_stream
from .registry import R, query, rnd
from .tables import table

LABEL_DAYS, TRAIN_DAYS, CALIB_DAYS = 14, 16, 22
FEATURES = ["day_value", "day_events"]


def zone_days(spark, sf_dir):
    """Per zone and day: summed value, events, whether an error, and whether
    one follows within 14 days; pinned."""
    zd = P.zone_day(table(spark, sf_dir, "events"), F.to_date("ts"), "user_id", "value", F.col("event_type") == "error")
    w = Window.partitionBy("user_id").orderBy(F.datediff("date", F.lit("1970-01-01"))).rangeBetween(1, LABEL_DAYS)
    days = zd.select("date", "user_id", F.round("value_sum", 4).alias("day_value"), F.col("n_events").cast("double").alias("day_events"),
                     F.coalesce(F.max("hit").over(w), F.lit(0)).alias("label"))
    return cut_lineage(days)


def zone_gold(days):
    """One row per zone: the latest day's features and the vulnerability."""
    g = days.groupBy("user_id").agg(F.max_by(F.struct("day_value", "day_events"), "date").alias("f"),
                                    F.sum("day_value").alias("s"), F.sum("day_events").alias("n"))
    g = g.select("user_id", "f.*", F.try_divide("s", "n").alias("m"))
    b = g.agg(F.min("m").alias("lo"), F.max("m").alias("hi")).first()
    lo, hi = F.lit(b["lo"]).cast("double"), F.lit(b["hi"]).cast("double")
    vi = (F.col("m") - lo) / (hi - lo + F.lit(1e-9))
    return g.select("user_id", *FEATURES, F.round(vi, 4).alias("vulnerability_index"))


def _split(days):
    d0 = days.agg(F.min("date")).first()[0]
    off = F.datediff(F.col("date"), F.lit(d0).cast("date"))
    return days.where(off < TRAIN_DAYS), days.where((off >= TRAIN_DAYS) & (off < CALIB_DAYS))


def _stored(spark, root, name, model):
    """The model as the stream gets it: written, then loaded."""
    MS.save_model(spark, model, f"{root}/{name}")
    return MS.load_model(spark, f"{root}/{name}")


def tree_models(spark, days, root):
    train, calib = _split(days)
    prod = MS.train_model(train, FEATURES, "label", "gbt", "gbt-1", {"maxIter": 10, "maxDepth": 3, "stepSize": 0.1}, calib=calib)
    cand = MS.train_model(train, FEATURES, "label", "rf", "rf-2", {"maxIter": 15, "maxDepth": 4}, calib=calib)
    return _stored(spark, root, "production", prod), _stored(spark, root, "shadow", cand)


def linear_models(spark, days, root):
    train, _ = _split(days)
    prod = MS.train_model(train, FEATURES[:1], "label", "linear", "value-1", pos_weight=1.0)
    cand = MS.train_model(train, FEATURES[1:], "label", "linear", "events-2", pos_weight=1.0)
    return _stored(spark, root, "production", prod), _stored(spark, root, "shadow", cand)


ALERT = ["event_id", "user_id", "running_count", "vulnerability_index", "production_score", "alert_score", "risk_tier", "action"]


def run_stream(spark, sf_dir, models):
    """Stream the events through both models; the sink's folder, gold and the
    production model."""
    root = scratch_path(spark, f"scored-{uuid.uuid4().hex[:12]}")
    days = zone_days(spark, sf_dir)
    gold = SC.pin_gold(zone_gold(days), f"{root}/gold")
    production, shadow = models(spark, days, f"{root}/models")
    sink = SC.EventSink(
        f"{root}/stream", "user_id",
        enrich=lambda e: SC.with_alert_columns(SC.score_events(e, gold, "user_id", production, shadow)),
        logs={"alerts": lambda e: e.where("alert_triggered").select(*ALERT),
              "shadow": lambda e: SC.shadow_rows(e, ["event_id", "user_id", "ts"])})
    X.run_available(_events_stream(spark, sf_dir).writeStream.foreachBatch(sink), f"{root}/ckpt")
    return f"{root}/stream", gold, production


@query("stream_model_alerts")
def stream_model_alerts(spark, sf_dir):
    """Alerts of the stored, calibrated boosted trees in the stream, each with
    the shadow forest's score of the same event (X4, X5, J11, M4, M10)."""
    root, _, _ = run_stream(spark, sf_dir, tree_models)
    s = SC.read_log(spark, root, "shadow").select("event_id", "shadow_score", "agreement")
    return SC.read_log(spark, root, "alerts").join(s, "event_id").select(*ALERT[:4], rnd("production_score", 4), rnd("shadow_score", 4), *ALERT[5:], "agreement")


@query("stream_model_parity")
def stream_model_parity(spark, sf_dir):
    """Per zone: events that the stream scored, how many of them got exactly
    the batch score of the same stored model, and how many alerts and shadow
    rows fit their event (X4, X5, M10)."""
    root, gold, production = run_stream(spark, sf_dir, tree_models)
    batch = production.score(gold, "batch_score").select("user_id", "batch_score")
    e, a, s = (SC.read_log(spark, root, x) for x in ("events", "alerts", "shadow"))
    e = e.join(a.select("event_id", F.col("alert_score").alias("logged")), "event_id", "left") \
        .join(s.select("event_id", F.col("production_score").alias("shadowed"), F.col("running_count").alias("shadow_count")), "event_id", "left") \
        .join(batch, "user_id", "left")
    logged = F.when(F.col("alert_triggered"), F.col("logged").eqNullSafe(F.col("alert_score"))).otherwise(F.col("logged").isNull())
    shadowed = F.col("shadowed").eqNullSafe(F.col("production_score")) & F.col("shadow_count").eqNullSafe(F.col("running_count"))
    return e.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("production_score").eqNullSafe(F.col("batch_score"))).alias("n_equal"),
        F.count_if(logged).alias("n_alerts_right"), F.count_if(shadowed).alias("n_shadow_right"))


sql("stream_model_parity", """
SELECT user_id, count(*) AS n_events, count(*) AS n_equal, count(*) AS n_alerts_right, count(*) AS n_shadow_right FROM events GROUP BY user_id
""")


@query("stream_linear_alerts")
def stream_linear_alerts(spark, sf_dir):
    """The alert log of the stored linear model."""
    root, _, _ = run_stream(spark, sf_dir, linear_models)
    return SC.read_log(spark, root, "alerts").select(*ALERT[:4], rnd("production_score", 4), *ALERT[5:])


LINEAR_SQL = f"""
zd AS (SELECT CAST(ts AS DATE) AS date, user_id, round(sum(value), 4) AS v, CAST(count(*) AS DOUBLE) AS n,
         max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS hit FROM events WHERE ts IS NOT NULL GROUP BY ALL),
days AS (SELECT *, coalesce(max(hit) OVER (PARTITION BY user_id ORDER BY date
           RANGE BETWEEN INTERVAL 1 DAY FOLLOWING AND INTERVAL {LABEL_DAYS} DAY FOLLOWING), 0) AS label FROM zd),
fit AS (SELECT regr_slope(label, v) AS va, regr_intercept(label, v) AS vb, regr_slope(label, n) AS na, regr_intercept(label, n) AS nb
        FROM days WHERE date < (SELECT min(date) FROM days) + INTERVAL {TRAIN_DAYS} DAY),
z AS (SELECT user_id, arg_max(v, date) AS v, arg_max(n, date) AS n, sum(v) / sum(n) AS m FROM days GROUP BY user_id),
gold AS (SELECT user_id, greatest(0, least(1, vb + va * v)) AS production_score, greatest(0, least(1, nb + na * n)) AS shadow_score,
           round((m - (SELECT min(m) FROM z)) / ((SELECT max(m) FROM z) - (SELECT min(m) FROM z) + CAST(1e-9 AS DOUBLE)), 4) AS vulnerability_index
         FROM z, fit),
run AS (SELECT event_id, user_id, ts, floor((epoch(ts) - {SC.WEEK_OFFSET_S}) / {SC.WEEK_S}) AS wk FROM events),
scored AS (SELECT event_id, user_id, ts, wk, production_score, shadow_score, vulnerability_index,
             count(*) OVER (PARTITION BY user_id, wk ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running_count FROM run JOIN gold USING (user_id))"""
TIER_SQL = "CASE WHEN {0} >= 0.6 THEN 'High' WHEN {0} >= 0.3 THEN 'Medium' ELSE 'Low' END"
ACTION_SQL = """CASE WHEN production_score >= 0.6 THEN 'Deploy fogging crew this week'
  WHEN production_score >= 0.3 THEN 'Schedule inspection - monitor closely' ELSE 'Routine surveillance only' END"""

sql("stream_linear_alerts", f"""
WITH {LINEAR_SQL},
a AS (SELECT *, round(production_score * vulnerability_index * ln(1 + running_count), 4) AS alert_score FROM scored)
SELECT event_id, user_id, running_count, vulnerability_index, round(production_score, 4) AS production_score, alert_score,
  {TIER_SQL.format("production_score")} AS risk_tier, {ACTION_SQL} AS action
FROM a WHERE alert_score > CAST(0.6 AS DOUBLE)
""")


@query("stream_shadow_log")
def stream_shadow_log(spark, sf_dir):
    """The shadow log of every event: both models' scores of the same pass,
    tiers, agreement and version (M10, X5, P27)."""
    root, _, _ = run_stream(spark, sf_dir, linear_models)
    s = SC.read_log(spark, root, "shadow")
    return s.select("event_id", "user_id", "running_count", rnd("production_score", 4), rnd("shadow_score", 4),
                    "shadow_model_version", "production_tier", "shadow_tier", "agreement")


sql("stream_shadow_log", f"""
WITH {LINEAR_SQL}
SELECT event_id, user_id, running_count, round(production_score, 4) AS production_score, round(shadow_score, 4) AS shadow_score,
  'events-2' AS shadow_model_version, {TIER_SQL.format("production_score")} AS production_tier, {TIER_SQL.format("shadow_score")} AS shadow_tier,
  (production_score >= 0.6) = (shadow_score >= 0.6) AS agreement
FROM scored
""")


@query("shadow_log_summary")
def shadow_log_summary(spark, sf_dir):
    """Production against shadow over the last 7 days of the shadow log
    (A8, X7, M10)."""
    root, _, _ = run_stream(spark, sf_dir, linear_models)
    s = SC.read_log(spark, root, "shadow")
    out = SV.shadow_summary(s, "ts", ref="2024-01-31 00:00:00", days=7)
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


sql("shadow_log_summary", f"""
WITH {LINEAR_SQL},
t AS (SELECT *, {TIER_SQL.format("production_score")} AS pt, {TIER_SQL.format("shadow_score")} AS qt,
        (production_score >= 0.6) = (shadow_score >= 0.6) AS agreement, production_score AS p, shadow_score AS q FROM scored
      WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-31 00:00:00')
SELECT count(*) AS total_cases, round(avg(CASE WHEN agreement THEN 1.0 ELSE 0.0 END) * 100, 1) AS agreement_pct,
  round(avg(abs(p - q)), 4) AS avg_score_diff, round(max(abs(p - q)), 4) AS max_score_diff,
  count(*) FILTER (WHERE pt = 'High' AND qt <> 'High') AS prod_high_shadow_missed,
  count(*) FILTER (WHERE qt = 'High' AND pt <> 'High') AS shadow_high_prod_missed,
  min(ts) AS window_start, max(ts) AS window_end, least(count(*), 1) AS shadow_versions,
  coalesce(round(avg(CASE WHEN agreement THEN 1.0 ELSE 0.0 END) * 100, 1) >= 90.0, false) AS ready_to_promote
FROM t
""")


@query("score_keys")
def score_keys(spark, sf_dir):
    """Scores on demand for every zone (X6): the stored linear model on gold,
    case counts of the current week from the state of a running stream."""
    root = scratch_path(spark, f"keys-{uuid.uuid4().hex[:12]}")
    days = zone_days(spark, sf_dir)
    gold = SC.pin_gold(zone_gold(days), f"{root}/gold")
    production, _ = linear_models(spark, days, f"{root}/models")
    weekly = X.weekly_counts(_events_stream(spark, sf_dir), "user_id")
    X.run_available(weekly.writeStream.outputMode("update").foreachBatch(X.write_idempotent(f"{root}/out")), f"{root}/ckpt")
    state = SC.streamed_state(spark, f"{root}/ckpt", ["window.start", "user_id"])
    state = state.select("user_id", "start", F.col("sum").cast("long").alias("case_count"))
    week = state.agg(F.max("start")).first()[0]
    return SC.score_keys(state.where(F.col("start") == F.lit(week)), gold, "user_id", production)


sql("score_keys", f"""
WITH {LINEAR_SQL},
c AS (SELECT user_id, count(*) AS case_count FROM run WHERE wk = (SELECT max(wk) FROM run) GROUP BY user_id),
k AS (SELECT user_id, production_score, vulnerability_index, coalesce(case_count, 1) AS case_count FROM gold LEFT JOIN c USING (user_id)),
a AS (SELECT *, round(production_score * vulnerability_index * ln(1 + case_count), 4) AS alert_score FROM k)
SELECT user_id, round(production_score, 4) AS model_score, round(vulnerability_index, 4) AS vulnerability_index, case_count, alert_score,
  alert_score > CAST(0.6 AS DOUBLE) AS alert_triggered, {TIER_SQL.format("production_score")} AS risk_tier
FROM a
""")


# ------------------------------------------------------- candidates, compared
def linear_candidates(spark, sf_dir):
    """The two linear models on every zone day: splits by day, the validation
    days halved into calibration and threshold days; written once."""
    days = zone_days(spark, sf_dir)
    d0 = days.agg(F.min("date")).first()[0]
    off = F.datediff(F.col("date"), F.lit(d0).cast("date"))
    panel = days.withColumn("split", F.when(off < TRAIN_DAYS, "train").when(off < CALIB_DAYS, "val").when(off < CALIB_DAYS + 4, "test").otherwise("oot")) \
        .withColumn("picks", (off >= TRAIN_DAYS + 3) & (off < CALIB_DAYS))
    train = panel.where("split = 'train'")
    models = {"value": MS.train_model(train, FEATURES[:1], "label", "linear", "value-1", pos_weight=1.0),
              "events": MS.train_model(train, FEATURES[1:], "label", "linear", "events-1", pos_weight=1.0)}
    long = cut_lineage(CD.candidate_scores(panel, models, ["date", "user_id", "split", "picks", "label"]))
    return CD.evaluate_candidates(long, "label", "split", F.col("picks"), 0.80, "val")


@query("candidate_eval")
def candidate_eval(spark, sf_dir):
    """Every (model, split) of the closed-form candidates at the model's own
    threshold (M5, A10-A15)."""
    ev = linear_candidates(spark, sf_dir)
    return ev.select("model", "split", rnd("threshold"), "n_rows", "n_positive", "tp", "fp", "tn", "fn", "precision", "recall", "f1", "f_beta",
                     rnd("auc", 4), rnd("avg_precision", 4), "meets_target", "is_best")


def _zero_div(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"


CANDIDATE_SQL = f"""
{LINEAR_SQL},
o AS (SELECT date_diff('day', (SELECT min(date) FROM days), date) AS off, v, n, label FROM days),
p AS (SELECT CASE WHEN off < {TRAIN_DAYS} THEN 'train' WHEN off < {CALIB_DAYS} THEN 'val' WHEN off < {CALIB_DAYS + 4} THEN 'test' ELSE 'oot' END AS split,
        off >= {TRAIN_DAYS + 3} AND off < {CALIB_DAYS} AS picks, v, n, label FROM o),
l AS (SELECT 'value' AS model, 0 AS rank, split, picks, label, greatest(0, least(1, vb + va * v)) AS score FROM p, fit
      UNION ALL SELECT 'events', 1, split, picks, label, greatest(0, least(1, nb + na * n)) FROM p, fit),
pc AS (SELECT model, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM l WHERE picks GROUP BY ALL),
pr AS (SELECT model, score AS threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS P FROM pc
       WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
pt AS (SELECT model, threshold, {_zero_div("tp", "tp + fp")} AS precision, CASE WHEN P = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / P END AS recall FROM pr),
th AS (SELECT model, bool_or(recall >= 0.8) AS meets_target, coalesce(arg_min(threshold, (-precision, threshold)) FILTER (recall >= 0.8),
         arg_min(threshold, (abs(recall - 0.8), threshold))) AS threshold FROM pt GROUP BY model),
c0 AS (SELECT model, rank, split, threshold, meets_target, count(*) AS n_rows, count(*) FILTER (label = 1) AS n_positive,
         count(*) FILTER (score >= threshold AND label = 1) AS tp0, count(*) FILTER (score >= threshold AND label <> 1) AS fp0,
         count(*) FILTER (score < threshold AND label <> 1) AS tn0, count(*) FILTER (score < threshold AND label = 1) AS fn0
       FROM l JOIN th USING (model) GROUP BY ALL),
c1 AS (SELECT *, NOT ((tp0 + fp0 + fn0) > 0 AND (tn0 + fp0 + fn0) > 0) AS one FROM c0),
c AS (SELECT model, rank, split, threshold, meets_target, n_rows, n_positive, CASE WHEN one THEN 0 ELSE tp0 END AS tp, CASE WHEN one THEN 0 ELSE fp0 END AS fp,
        CASE WHEN one THEN 0 ELSE tn0 END AS tn, CASE WHEN one THEN 0 ELSE fn0 END AS fn FROM c1),
m AS (SELECT *, round({_zero_div("tp", "tp + fp")}, 4) AS precision, round({_zero_div("tp", "tp + fn")}, 4) AS recall,
        round({_zero_div("2.0 * tp", "1.0 * (tp + fn) + (tp + fp)")}, 4) AS f1, round({_zero_div("5.0 * tp", "4.0 * (tp + fn) + (tp + fp)")}, 4) AS f_beta FROM c),
sc AS (SELECT model, split, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM l GROUP BY ALL),
cp AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model, split) AS P, sum(neg) OVER (PARTITION BY model, split) AS N
       FROM sc WINDOW w AS (PARTITION BY model, split ORDER BY score DESC)),
r AS (SELECT model, split, sum(pos * (N - fp) + 0.5 * pos * neg) / nullif(CAST(P AS DOUBLE) * N, 0) AS auc,
        CASE WHEN P > 0 THEN sum(CAST(pos AS DOUBLE) / P * (CAST(tp AS DOUBLE) / (tp + fp))) END AS avg_precision FROM cp GROUP BY model, split, P, N),
best AS (SELECT arg_min(model, (-precision, rank)) AS best FROM m WHERE split = 'val')"""

sql("candidate_eval", f"""
WITH {CANDIDATE_SQL}
SELECT m.model, m.split, round(threshold, {R}) AS threshold, n_rows, n_positive, tp, fp, tn, fn, precision, recall, f1, f_beta,
  round(auc, 4) AS auc, round(avg_precision, 4) AS avg_precision, meets_target, m.model = best AS is_best
FROM m LEFT JOIN r ON r.model = m.model AND r.split = m.split, best
""")


@query("best_model")
def best_model(spark, sf_dir):
    """The chosen candidate: highest validation precision at the recall floor,
    the first on ties (T7)."""
    ev = CD.best_model(linear_candidates(spark, sf_dir), "split", "val")
    return ev.select("model", rnd("threshold"), "precision", "recall", "meets_target")


sql("best_model", f"""
WITH {CANDIDATE_SQL}
SELECT model, round(threshold, {R}) AS threshold, precision, recall, meets_target FROM m, best WHERE split = 'val' AND model = best
""")
