"""Queries: streaming over the landed ``events`` file.

Each query runs a real Structured Streaming plan with ``availableNow`` over
the table's folder (file source filtered to ``events.parquet``), writes
through an idempotent ``foreachBatch`` sink into a fresh folder under the
shared checkpoint directory, and returns the sink's table.  The batch SQL
twin checks that the stream computes the same result as a batch run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, scratch_path
from ..streaming import cases as X
from ..streaming import scoring as SC
from .oracle import sql
from .registry import query
from .tables import table

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def _events_stream(spark, sf_dir):
    s = X.case_stream(spark, sf_dir, EVENT_SCHEMA, "parquet", "ts", glob="events.parquet")
    return s


def _run(spark, name, stream_df, mode, key=None, only=None):
    run = f"{name}-{uuid.uuid4().hex[:12]}"
    out = scratch_path(spark, run + "/out")
    ckpt = scratch_path(spark, run + "/ckpt")
    w = stream_df.writeStream.outputMode(mode).foreachBatch(X.write_idempotent(out, only=only))
    X.run_available(w, ckpt)
    if key is not None:
        return X.upsert_view(spark, out, key)
    return spark.read.parquet(out).drop("batch_id")


@query("stream_week_counts")
def stream_week_counts(spark, sf_dir):
    """Case counts per zone and reset week from the event stream."""
    wk = X.weekly_counts(_events_stream(spark, sf_dir), "user_id")
    out = _run(spark, "week_counts", wk, "update", ["user_id", "week_start"])
    return out.select("user_id", F.col("week_start").cast("timestamp_ntz").alias("week_start"),
                      F.col("case_count").cast("long").alias("case_count"))


sql("stream_week_counts", """
SELECT user_id,
  TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor((epoch(ts) - 338400) / 604800) AS BIGINT) * 604800 + 338400) AS week_start,
  count(*) AS case_count
FROM events GROUP BY ALL
""")


@query("stream_running_counts")
def stream_running_counts(spark, sf_dir):
    """Per-zone running case count kept in the state store."""
    rc = X.running_counts(_events_stream(spark, sf_dir), "user_id")
    out = _run(spark, "running_counts", rc, "update", ["user_id"])
    return out.select("user_id", F.col("case_count").cast("long").alias("case_count"))


sql("stream_running_counts", "SELECT user_id, count(*) AS case_count FROM events GROUP BY user_id")


def _static_features(spark, sf_dir):
    """Per zone: min-max scaled mean event value as the vulnerability index,
    written once (micro-batches read the file); and the largest value."""
    ev = table(spark, sf_dir, "events")
    m = cut_lineage(ev.groupBy("user_id").agg(F.avg("value").alias("_m"), F.max("value").alias("_x")))
    b = m.agg(F.min("_m").alias("lo"), F.max("_m").alias("hi"), F.max("_x").alias("mx")).first()
    lo, hi, mx = (F.lit(x).cast("double") for x in b)
    vi = F.round((F.col("_m") - lo) / (hi - lo + F.lit(1e-9)), 4)
    path = scratch_path(spark, f"static-{uuid.uuid4().hex[:12]}")
    return SC.pin_gold(m.select("user_id", vi.alias("vulnerability_index")), path), mx


@query("stream_alerts")
def stream_alerts(spark, sf_dir):
    """Per event: stream-static join, score, alert score, strict threshold;
    only triggered alerts are written (X4, X5, J11, P20-P22)."""
    static, mx = _static_features(spark, sf_dir)
    s = _events_stream(spark, sf_dir)
    s = s.withColumn("score", F.try_divide("value", mx)) \
        .withColumn("case_count", F.coalesce(F.get_json_object("props", "$.k").try_cast("int"),
                                             F.lit(1)))
    a = X.alert_stream(s, static, "user_id", "score")
    a = a.select("event_id", "user_id", "case_count", "vulnerability_index", "alert_score",
                 "alert_triggered", "risk_tier", "action")
    return _run(spark, "alerts", a, "append", None, only="alert_triggered")


sql("stream_alerts", """
WITH m AS (SELECT user_id, avg(value) AS m FROM events GROUP BY user_id),
b AS (SELECT min(m) AS lo, max(m) AS hi FROM m),
st AS (SELECT user_id, round((m - lo) / (hi - lo + CAST(1e-9 AS DOUBLE)), 4) AS vi FROM m, b),
e AS (SELECT event_id, user_id, value / (SELECT max(value) FROM events) AS score,
             coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 1) AS case_count FROM events),
j AS (SELECT e.*, coalesce(st.vi, 0.5) AS vulnerability_index FROM e LEFT JOIN st USING (user_id)),
a AS (SELECT *, round(score * vulnerability_index * ln(1 + case_count), 4) AS alert_score FROM j)
SELECT event_id, user_id, case_count, vulnerability_index, alert_score,
  alert_score > CAST(0.6 AS DOUBLE) AS alert_triggered,
  CASE WHEN score >= 0.6 THEN 'High' WHEN score >= 0.3 THEN 'Medium' ELSE 'Low' END AS risk_tier,
  CASE WHEN score >= 0.6 THEN 'Deploy fogging crew this week'
       WHEN score >= 0.3 THEN 'Schedule inspection - monitor closely'
       ELSE 'Routine surveillance only' END AS action
FROM a WHERE alert_score > CAST(0.6 AS DOUBLE)
""")


@query("stream_running_alerts")
def stream_running_alerts(spark, sf_dir):
    """Per event: increment the zone's weekly counter, then score with the
    counter value (X2, X3, X4, J11): alert score from the running weekly
    count, static vulnerability, strict threshold; only alerts are written."""
    static, mx = _static_features(spark, sf_dir)
    root = scratch_path(spark, f"running-{uuid.uuid4().hex[:12]}")
    sink = SC.EventSink(
        f"{root}/stream", "user_id",
        enrich=lambda e: X.alert_stream(e.withColumn("score", F.try_divide("value", mx)), static, "user_id", "score", cases="running_count"),
        logs={"alerts": lambda e: e.where("alert_triggered")})
    X.run_available(_events_stream(spark, sf_dir).writeStream.foreachBatch(sink), f"{root}/ckpt")
    return SC.read_log(spark, f"{root}/stream", "alerts").select(
        "event_id", "user_id", "running_count", "vulnerability_index", "alert_score", "alert_triggered", "risk_tier")


sql("stream_running_alerts", """
WITH m AS (SELECT user_id, avg(value) AS m FROM events GROUP BY user_id),
b AS (SELECT min(m) AS lo, max(m) AS hi FROM m),
st AS (SELECT user_id, round((m - lo) / (hi - lo + CAST(1e-9 AS DOUBLE)), 4) AS vi FROM m, b),
e AS (SELECT event_id, user_id, ts, value / (SELECT max(value) FROM events) AS score,
             floor((epoch(ts) - 338400) / 604800) AS wk FROM events),
r AS (SELECT *, count(*) OVER (PARTITION BY user_id, wk ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count FROM e),
j AS (SELECT r.*, coalesce(st.vi, 0.5) AS vulnerability_index FROM r LEFT JOIN st USING (user_id)),
a AS (SELECT *, round(score * vulnerability_index * ln(1 + running_count), 4) AS alert_score FROM j)
SELECT event_id, user_id, running_count, vulnerability_index, alert_score,
  alert_score > CAST(0.6 AS DOUBLE) AS alert_triggered,
  CASE WHEN score >= 0.6 THEN 'High' WHEN score >= 0.3 THEN 'Medium' ELSE 'Low' END AS risk_tier
FROM a WHERE alert_score > CAST(0.6 AS DOUBLE)
""")


@query("stream_shadow_windows")
def stream_shadow_windows(spark, sf_dir):
    """Production vs shadow scores on the event stream, in sliding 7-day
    windows every day (X7): agreement % and absolute score differences."""
    mx = F.lit(table(spark, sf_dir, "events").agg(F.max("value")).first()[0]).cast("double")
    s = _events_stream(spark, sf_dir)
    p = F.try_divide("value", mx)
    sc = s.select(F.col("ts").alias("scored_at"), p.alias("production_score"),
                  F.sqrt(p).alias("shadow_score"))
    out = _run(spark, "shadow_windows", X.shadow_windows(sc), "update", ["window_start"])
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("total_cases").cast("long").alias("total_cases"),
                      F.round(F.col("_agree") / F.col("total_cases") * 100, 1).alias("agreement_pct"),
                      F.round(F.col("_diff_max"), 4).alias("max_score_diff"))


sql("stream_shadow_windows", """
WITH s AS (SELECT ts, value / (SELECT max(value) FROM events) AS p FROM events),
e AS (SELECT ts, p, sqrt(p) AS q, floor(epoch(ts) / 86400) AS dn FROM s),
w AS (SELECT (dn - o) AS start_day, p, q FROM e, range(0, 7) r(o))
SELECT TIMESTAMP '1970-01-01 00:00:00' + to_days(CAST(start_day AS INTEGER)) AS window_start,
  count(*) AS total_cases,
  round(sum(CASE WHEN (p >= 0.6) = (q >= 0.6) THEN 1 ELSE 0 END) / count(*) * 100, 1) AS agreement_pct,
  round(max(abs(p - q)), 4) AS max_score_diff
FROM w GROUP BY start_day
""")
