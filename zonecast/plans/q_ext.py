"""Queries: extensions documented (not coded) by the reference."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import conjunctive_alert, week_harmonics
from ..operators import clean as CL
from ..operators import panel as P
from .oracle import sql
from .q_serving import alert_scores
from .queries import forward_label
from .registry import R, query, rnd
from .tables import table


@query("prior_activity")
def prior_activity(spark, sf_dir):
    """Per zone and snapshot: any active snapshot in the prior 28 days
    and the number of active snapshots in the prior 365 days (D5)."""
    p = forward_label(spark, sf_dir)
    p = P.backward_window(p, "user_id", "date", "overlap", 28, "max", "prior_28d_any")
    p = P.backward_window(p, "user_id", "date", "overlap", 365, "sum", "prior_365d_count")
    return p.select("date", "user_id", "prior_28d_any", "prior_365d_count")


sql("prior_activity", """
WITH e AS (SELECT CAST(ts AS DATE) AS date, user_id, event_type FROM events),
spine AS (SELECT d.date, u.user_id FROM (SELECT DISTINCT date FROM e) d CROSS JOIN (SELECT DISTINCT user_id FROM events) u),
hits AS (SELECT DISTINCT date, user_id FROM e WHERE event_type = 'error'),
panel AS (SELECT s.date, s.user_id, CASE WHEN h.user_id IS NULL THEN 0 ELSE 1 END AS overlap
          FROM spine s LEFT JOIN hits h ON s.date = h.date AND s.user_id = h.user_id)
SELECT p.date, p.user_id,
  CAST(coalesce((SELECT max(q.overlap) FROM panel q WHERE q.user_id = p.user_id
                 AND q.date >= p.date - INTERVAL 28 DAY AND q.date < p.date), 0) AS BIGINT) AS prior_28d_any,
  CAST(coalesce((SELECT sum(q.overlap) FROM panel q WHERE q.user_id = p.user_id
                 AND q.date >= p.date - INTERVAL 365 DAY AND q.date < p.date), 0) AS BIGINT) AS prior_365d_count
FROM panel p
""")


@query("calendar_features")
def calendar_features(spark, sf_dir):
    """Week-of-year sine / cosine per order date."""
    d = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    s, c = week_harmonics("date")
    # "+ 0.0" turns a rounded negative zero into 0.0
    return d.select("date", (F.round(s, R) + F.lit(0.0)).alias("woy_sin"),
                    (F.round(c, R) + F.lit(0.0)).alias("woy_cos"))


sql("calendar_features", f"""
SELECT date,
  round(sin(CAST(2 * 3.141592653589793 AS DOUBLE) * CAST(weekofyear(date) AS DOUBLE) / CAST(52.0 AS DOUBLE)), {R}) + CAST(0.0 AS DOUBLE) AS woy_sin,
  round(cos(CAST(2 * 3.141592653589793 AS DOUBLE) * CAST(weekofyear(date) AS DOUBLE) / CAST(52.0 AS DOUBLE)), {R}) + CAST(0.0 AS DOUBLE) AS woy_cos
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
""")


@query("conjunctive_alerts")
def conjunctive_alerts(spark, sf_dir):
    """Zones with score > 0.5, vulnerability > 0.4 and at least 10 cases."""
    a = alert_scores(spark, sf_dir)
    z = table(spark, sf_dir, "customer").agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi")).first()
    sc = table(spark, sf_dir, "customer").select(
        "c_custkey", F.try_divide(F.col("c_acctbal") - F.lit(z["lo"]).cast("double"), (F.lit(z["hi"]) - F.lit(z["lo"])).cast("double")).alias("score"))
    j = a.join(sc, "c_custkey")
    return j.where(conjunctive_alert("score", "vulnerability_index", "case_count", 0.5, 0.4, 10)) \
        .select("c_custkey", "case_count", "vulnerability_index")


sql("conjunctive_alerts", """
WITH s AS (SELECT c_custkey, (c_acctbal - (SELECT min(c_acctbal) FROM customer)) /
                  ((SELECT max(c_acctbal) FROM customer) - (SELECT min(c_acctbal) FROM customer)) AS score FROM customer),
cs AS (SELECT o_custkey AS c_custkey, count(*) AS case_count FROM orders GROUP BY 1),
o AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS t FROM orders GROUP BY 1),
x AS (SELECT c.c_custkey, coalesce(c.c_acctbal, 0.0) AS a, coalesce(o.t, 0.0) AS t
      FROM customer c LEFT JOIN o ON c.c_custkey = o.o_custkey),
b AS (SELECT min(a) AS alo, max(a) AS ahi, min(t) AS tlo, max(t) AS thi FROM x),
v AS (SELECT c_custkey, round(CAST(0.5 AS DOUBLE) * ((a - alo) / (ahi - alo + CAST(1e-9 AS DOUBLE)))
        + CAST(0.5 AS DOUBLE) * ((t - tlo) / (thi - tlo + CAST(1e-9 AS DOUBLE))), 4) AS vi FROM x, b)
SELECT s.c_custkey, coalesce(cs.case_count, 1) AS case_count, coalesce(v.vi, 0.5) AS vulnerability_index
FROM s LEFT JOIN cs ON s.c_custkey = cs.c_custkey LEFT JOIN v ON s.c_custkey = v.c_custkey
WHERE s.score > CAST(0.5 AS DOUBLE) AND coalesce(v.vi, 0.5) > CAST(0.4 AS DOUBLE) AND coalesce(cs.case_count, 1) >= 10
""")


@query("impute_group_mean")
def impute_group_mean(spark, sf_dir):
    """Unlabelled documents get the mean quality of their language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    out = CL.impute_group_mean(docs.join(lab, "doc_id", "left"), "lang", "quality", "quality_filled")
    return out.select("doc_id", "lang", rnd("quality_filled"))


sql("impute_group_mean", f"""
WITH j AS (SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
m AS (SELECT lang, avg(quality) AS gm FROM j GROUP BY lang)
SELECT j.doc_id, j.lang, round(coalesce(CAST(j.quality AS DOUBLE), m.gm), {R}) AS quality_filled
FROM j LEFT JOIN m ON j.lang IS NOT DISTINCT FROM m.lang
""")
