"""Queries: operator variants with their own SQL twin (W4, A7, F9, F10,
P9, P10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import reshape as RS
from ..operators import series as S
from .oracle import sql
from .registry import R, query, rnd
from .tables import table


@query("ffill_only")
def ffill_only(spark, sf_dir):
    """Per-supplier daily mean quantity, calendar-complete per supplier,
    forward-filled at most 3 days (W4 alone; longer gaps stay null, and their days stay)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("date"), "l_quantity")
    daily = li.groupBy("l_suppkey", "date").agg(F.avg("l_quantity").alias("qty_mean"))
    full = S.fill_calendar(daily, "date", ["l_suppkey"])
    out = S.ffill_limit(full, "date", "qty_mean", 3, ["l_suppkey"], "qty_ffill")
    return out.select("l_suppkey", "date", rnd("qty_ffill"))


sql("ffill_only", f"""
WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
b AS (SELECT l_suppkey, min(date) AS lo, max(date) AS hi FROM d GROUP BY 1),
cal AS (SELECT l_suppkey, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
s AS (SELECT c.l_suppkey, c.date, d.qty FROM cal c LEFT JOIN d USING (l_suppkey, date)),
w AS (SELECT *,
  last_value(qty IGNORE NULLS) OVER (PARTITION BY l_suppkey ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  last_value(CASE WHEN qty IS NOT NULL THEN date END IGNORE NULLS) OVER (PARTITION BY l_suppkey ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pd
  FROM s)
SELECT l_suppkey, date, round(CASE WHEN qty IS NOT NULL THEN qty WHEN date - pd <= 3 THEN pv END, {R}) AS qty_ffill
FROM w
""")


@query("daily_stats")
def daily_stats(spark, sf_dir):
    """Daily mean / max / min / count of quantity per supplier."""
    li = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"),
                                                 "l_suppkey", "l_quantity")
    return RS.daily_stats(li, "date", "l_suppkey", "l_quantity")


sql("daily_stats", """
SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey, round(avg(l_quantity), 4) AS mean,
  round(max(l_quantity), 4) AS max, round(min(l_quantity), 4) AS min, count(l_quantity) AS count
FROM lineitem GROUP BY 1, 2
""")


@query("min_support_docs")
def min_support_docs(spark, sf_dir):
    """Documents whose (lang, source) group has at least 10 rows."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return C.min_support(d, ["lang", "source"], 10)


sql("min_support_docs", """
SELECT doc_id, lang, source FROM documents
WHERE (lang, source) IN (SELECT (lang, source) FROM documents GROUP BY lang, source HAVING count(*) >= 10)
""")


@query("trailing_events")
def trailing_events(spark, sf_dir):
    """Events in the 7 days before a fixed reference time."""
    ev = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    out = C.trailing(ev, "ts", 7, "2024-01-31 00:00:00")
    return out.select("event_id")


sql("trailing_events", """
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-31 00:00:00'
""")


@query("drop_columns")
def drop_columns(spark, sf_dir):
    """Drop columns by name substring, then select / rename."""
    li = C.drop_matching(table(spark, sf_dir, "lineitem"), ["tax", "disc", "flag", "status", "date"])
    return C.project(li, {"order_key": "l_orderkey", "line": "l_linenumber", "part": "l_partkey",
                          "supplier": "l_suppkey", "qty": "l_quantity", "price": "l_extendedprice"})


sql("drop_columns", """
SELECT l_orderkey AS order_key, l_linenumber AS line, l_partkey AS part, l_suppkey AS supplier,
  l_quantity AS qty, l_extendedprice AS price FROM lineitem
""")
