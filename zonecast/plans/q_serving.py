"""Queries: tiers, top-k, ranking, alerts, shadow comparison, search,
score attachment.  Customers play the scored zones: score = balance scaled
to [0, 1] over the whole table (bounds read from a one-row aggregate)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import tier
from ..operators import clean as C
from ..operators import index as IX
from ..operators import joins as J
from ..operators import ordering as O
from ..operators import serving as SV
from .oracle import sql
from .q_metrics import d
from .registry import R, query, rnd
from .tables import table


def zone_scores(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    b = c.agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi")).first()
    lo, hi = F.lit(b["lo"]).cast("double"), F.lit(b["hi"]).cast("double")
    score = F.try_divide(F.col("c_acctbal") - lo, hi - lo)  # null if all balances are equal
    return c.select("c_custkey", "c_name", "c_nationkey", score.alias("score")) \
        .withColumn("risk_tier", tier("score"))


SCORES_SQL = """zs AS (
  SELECT c_custkey, c_name, c_nationkey,
         (c_acctbal - (SELECT min(c_acctbal) FROM customer)) /
         ((SELECT max(c_acctbal) FROM customer) - (SELECT min(c_acctbal) FROM customer)) AS score
  FROM customer),
z AS (SELECT *, CASE WHEN score >= 0.6 THEN 'High' WHEN score >= 0.3 THEN 'Medium' ELSE 'Low' END AS risk_tier FROM zs)"""


@query("tier_counts")
def tier_counts(spark, sf_dir):
    """Zones per risk tier."""
    return SV.tier_counts(zone_scores(spark, sf_dir))


sql("tier_counts", f"WITH {SCORES_SQL} SELECT risk_tier, count(*) AS n FROM z GROUP BY risk_tier")


@query("topk_high")
def topk_high(spark, sf_dir):
    """Top-20 High-tier zones by score."""
    top = O.top_k(zone_scores(spark, sf_dir), "score", 20, F.col("risk_tier") == "High", "c_custkey")
    return top.select("c_custkey", rnd("score"), "risk_tier")


sql("topk_high", f"""WITH {SCORES_SQL}
SELECT c_custkey, round(score, {R}) AS score, risk_tier FROM z WHERE risk_tier = 'High'
ORDER BY score DESC, c_custkey LIMIT 20""")


@query("topk_score")
def topk_score(spark, sf_dir):
    """Top-80 zones by score."""
    top = O.top_k(zone_scores(spark, sf_dir), "score", 80, None, "c_custkey")
    return top.select("c_custkey", rnd("score"))


sql("topk_score", f"""WITH {SCORES_SQL}
SELECT c_custkey, round(score, {R}) AS score FROM z ORDER BY score DESC, c_custkey LIMIT 80""")


@query("above_threshold")
def above_threshold(spark, sf_dir):
    """Zones at/above 0.5 and the count of High zones."""
    z = C.above(zone_scores(spark, sf_dir), "score", 0.5)
    return z.select("c_custkey", rnd("score"), "risk_tier")


sql("above_threshold", f"""WITH {SCORES_SQL}
SELECT c_custkey, round(score, {R}) AS score, risk_tier FROM z WHERE score >= {d(0.5)}""")


@query("ranked")
def ranked(spark, sf_dir):
    """Unique rank 1..n by score, key tiebreak, without a single-task
    window (W7)."""
    r = O.ranked(zone_scores(spark, sf_dir), "score", "c_custkey")
    return r.select("c_custkey", rnd("score"), "rank")


sql("ranked", f"""WITH {SCORES_SQL}
SELECT c_custkey, round(score, {R}) AS score,
  row_number() OVER (ORDER BY score DESC NULLS LAST, c_custkey) AS rank FROM z""")


@query("search_tier")
def search_tier(spark, sf_dir):
    """Cumulative tier filter (Medium = High + Medium) and name search (F8)."""
    return C.search(zone_scores(spark, sf_dir), "risk_tier", "Medium", "c_name", "#0000001") \
        .select("c_custkey", "c_name", "risk_tier")


sql("search_tier", f"""WITH {SCORES_SQL}
SELECT c_custkey, c_name, risk_tier FROM z
WHERE risk_tier IN ('High', 'Medium') AND contains(lower(c_name), '#0000001')""")


@query("alert_scores")
def alert_scores(spark, sf_dir):
    """Per zone: case count from orders (unknown -> default 1), composite
    vulnerability index, alert score, strict alert flag, tier action
    (P20-P22, P25, J1)."""
    z = zone_scores(spark, sf_dir)
    # one pass over orders: case count and order total per zone
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("case_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("orders_total"))
    x = z.select("c_custkey", "score", "risk_tier").join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_custkey") \
        .join(per, "c_custkey", "left")
    j = IX.composite_index(IX.minmax(x, ["c_acctbal", "orders_total"]),
                           {"c_acctbal_norm": 0.5, "orders_total_norm": 0.5})
    j = SV.with_defaults(j, SV.ONLINE_DEFAULTS)
    out = SV.with_action(SV.with_alert(j, "score", "vulnerability_index", "case_count"))
    return out.select("c_custkey", "risk_tier", "case_count", "vulnerability_index",
                      "alert_score", "alert_triggered", "action")


sql("alert_scores", f"""WITH {SCORES_SQL},
cs AS (SELECT o_custkey AS c_custkey, count(*) AS case_count FROM orders GROUP BY 1),
o AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS t FROM orders GROUP BY 1),
x AS (SELECT c.c_custkey, coalesce(c.c_acctbal, 0.0) AS a, coalesce(o.t, 0.0) AS t
      FROM customer c LEFT JOIN o ON c.c_custkey = o.o_custkey),
b AS (SELECT min(a) AS alo, max(a) AS ahi, min(t) AS tlo, max(t) AS thi FROM x),
v AS (SELECT c_custkey, round({d(0.5)} * ((a - alo) / (ahi - alo + {d(1e-9)})) + {d(0.5)} * ((t - tlo) / (thi - tlo + {d(1e-9)})), 4) AS vi FROM x, b),
j AS (SELECT z.c_custkey, z.risk_tier, z.score, coalesce(cs.case_count, 1) AS case_count,
             coalesce(v.vi, 0.5) AS vulnerability_index
      FROM z LEFT JOIN cs ON z.c_custkey = cs.c_custkey LEFT JOIN v ON z.c_custkey = v.c_custkey),
a AS (SELECT *, round(score * vulnerability_index * ln(1 + case_count), 4) AS alert_score FROM j)
SELECT c_custkey, risk_tier, case_count, vulnerability_index, alert_score,
  alert_score > {d(0.6)} AS alert_triggered,
  CASE risk_tier WHEN 'High' THEN 'Deploy fogging crew this week'
                 WHEN 'Medium' THEN 'Schedule inspection - monitor closely'
                 WHEN 'Low' THEN 'Routine surveillance only' END AS action
FROM a""")


def _shadow_src(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    prod = F.try_divide("value", F.lit(ev.agg(F.max("value")).first()[0]).cast("double"))
    s = ev.select(F.col("ts").cast("timestamp").alias("scored_at"), "user_id",
                  prod.alias("production_score"), F.sqrt(prod).alias("shadow_score"),
                  F.col("event_type").alias("shadow_model_version"))
    return SV.shadow_score(s, "production_score", "shadow_score")


@query("shadow_compare")
def shadow_compare(spark, sf_dir):
    """Production vs shadow scores over the trailing 7 days before a fixed
    reference time (M10, A8, X7, F9)."""
    out = SV.shadow_summary(_shadow_src(spark, sf_dir), "scored_at", ref="2024-01-31 00:00:00",
                            days=7)
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
        .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


sql("shadow_compare", f"""
WITH s AS (SELECT ts AS scored_at, value / (SELECT max(value) FROM events) AS p,
                  sqrt(value / (SELECT max(value) FROM events)) AS q, event_type AS v FROM events),
t AS (SELECT *, CASE WHEN p >= 0.6 THEN 'High' WHEN p >= 0.3 THEN 'Medium' ELSE 'Low' END AS pt,
                CASE WHEN q >= 0.6 THEN 'High' WHEN q >= 0.3 THEN 'Medium' ELSE 'Low' END AS qt,
                (p >= {d(0.6)}) = (q >= {d(0.6)}) AS agreement
      FROM s WHERE scored_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY AND scored_at <= TIMESTAMP '2024-01-31 00:00:00')
SELECT count(*) AS total_cases,
  round(avg(CASE WHEN agreement THEN 1.0 ELSE 0.0 END) * 100, 1) AS agreement_pct,
  round(avg(abs(p - q)), 4) AS avg_score_diff, round(max(abs(p - q)), 4) AS max_score_diff,
  count(*) FILTER (WHERE pt = 'High' AND qt <> 'High') AS prod_high_shadow_missed,
  count(*) FILTER (WHERE qt = 'High' AND pt <> 'High') AS shadow_high_prod_missed,
  min(scored_at) AS window_start, max(scored_at) AS window_end,
  count(DISTINCT v) AS shadow_versions,
  coalesce(round(avg(CASE WHEN agreement THEN 1.0 ELSE 0.0 END) * 100, 1) >= 90.0, false) AS ready_to_promote
FROM t""")


@query("attach_scores")
def attach_scores(spark, sf_dir):
    """Every nation keeps its row; nations without high-balance suppliers
    show 'no data' (J13)."""
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sc = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 9000) \
        .groupBy(F.col("s_nationkey").alias("n_nationkey")) \
        .agg((F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double")
              / F.count("s_acctbal")).alias("mean_balance"))
    return J.attach_scores(nat, sc, "n_nationkey", ["mean_balance"])


sql("attach_scores", """
WITH sc AS (SELECT s_nationkey,
                   CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(s_acctbal) AS mean_balance FROM supplier
            WHERE s_acctbal > 9000 GROUP BY 1)
SELECT n.n_nationkey, n.n_name, sc.mean_balance,
  CASE WHEN sc.mean_balance IS NULL THEN 'no data' ELSE 'scored' END AS status
FROM nation n LEFT JOIN sc ON n.n_nationkey = sc.s_nationkey""")
