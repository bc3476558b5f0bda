"""Queries: series fill, cleaning, de-duplication, names, joins, set ops,
reshape (with their DuckDB oracle SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import canonical
from ..operators import clean as C
from ..operators import joins as J
from ..operators import reshape as RS
from ..operators import series as S
from .oracle import sql
from .registry import R, query, rnd
from .tables import table


# ------------------------------------------------------------ series fill
@query("series_fill")
def series_fill(spark, sf_dir):
    """Per-supplier daily mean quantity, reindexed to a full calendar per
    supplier, forward-filled 3 days then linearly interpolated (U9, W4, W5)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("date"), "l_quantity")
    daily = li.groupBy("l_suppkey", "date").agg(F.avg("l_quantity").alias("qty_mean"))
    out = S.fill_series(daily, "date", "qty_mean", ["l_suppkey"], 3, "qty_mean", "qty_filled")
    return out.select("l_suppkey", "date", rnd("qty_mean"), rnd("qty_filled"))


sql("series_fill", f"""
WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS qty
           FROM lineitem GROUP BY 1, 2),
b AS (SELECT l_suppkey, min(date) AS lo, max(date) AS hi FROM d GROUP BY 1),
cal AS (SELECT l_suppkey, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
s AS (SELECT c.l_suppkey, c.date, d.qty FROM cal c LEFT JOIN d USING (l_suppkey, date)),
w AS (SELECT *,
  last_value(qty IGNORE NULLS) OVER (PARTITION BY l_suppkey ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  last_value(CASE WHEN qty IS NOT NULL THEN date END IGNORE NULLS) OVER (PARTITION BY l_suppkey ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pd,
  first_value(qty IGNORE NULLS) OVER (PARTITION BY l_suppkey ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
  first_value(CASE WHEN qty IS NOT NULL THEN date END IGNORE NULLS) OVER (PARTITION BY l_suppkey ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nd
  FROM s)
SELECT l_suppkey, date, round(qty, {R}) AS qty_mean,
  round(CASE WHEN qty IS NOT NULL THEN qty
             WHEN pd IS NULL THEN NULL
             WHEN (date - pd) <= 3 THEN pv
             WHEN nd IS NULL THEN pv
             ELSE pv + (nv - pv) * ((date - pd) - 3) / ((nd - pd) - 3) END, {R}) AS qty_filled
FROM w
""")


# ------------------------------------------------------------ clean audit
def lineitem_rules():
    return [
        ("quantity_positive", F.col("l_quantity").isNotNull() & (F.col("l_quantity") > 0)),
        ("discount_in_box", F.col("l_discount").between(0.02, 0.08)),
        ("tax_in_box", F.col("l_tax").between(0.0, 0.06)),
    ]


@query("clean_audit")
def clean_audit(spark, sf_dir):
    """Rule chain with per-rule drop counts."""
    _, audit = C.clean_rules(table(spark, sf_dir, "lineitem"), lineitem_rules())
    return audit


sql("clean_audit", """
SELECT CASE WHEN NOT coalesce(l_quantity IS NOT NULL AND l_quantity > 0, false) THEN 'quantity_positive'
            WHEN NOT coalesce(l_discount BETWEEN 0.02 AND 0.08, false) THEN 'discount_in_box'
            WHEN NOT coalesce(l_tax BETWEEN 0.0 AND 0.06, false) THEN 'tax_in_box'
            ELSE 'kept' END AS rule,
       count(*) AS n_rows
FROM lineitem GROUP BY 1
""")


@query("clean_kept")
def clean_kept(spark, sf_dir):
    """Rows surviving the rule chain, sorted before write."""
    kept, _ = C.clean_rules(table(spark, sf_dir, "lineitem"), lineitem_rules())
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax") \
        .sortWithinPartitions("l_orderkey", "l_linenumber")


sql("clean_kept", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
WHERE l_quantity IS NOT NULL AND l_quantity > 0 AND l_discount BETWEEN 0.02 AND 0.08
  AND l_tax BETWEEN 0.0 AND 0.06
""")


# -------------------------------------------------------------- dedup / names
@query("dedup_first")
def dedup_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    return C.dedup_first(docs, ["lang", "source", "n_chars"], ["doc_id"])


sql("dedup_first", """
SELECT doc_id, lang, source, n_chars, text FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, n_chars ORDER BY doc_id) AS rn
  FROM documents) WHERE rn = 1
""")


@query("canonical_names")
def canonical_names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", "p_name", canonical("p_name").alias("name_canon"))


sql("canonical_names", r"""
SELECT p_partkey, p_name,
  trim(regexp_replace(regexp_replace(upper(trim(p_name)), '[^\w\s\-]', '', 'g'), '\s+', ' ', 'g')) AS name_canon
FROM part
""")


@query("canonical_sources")
def canonical_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", canonical("source").alias("source_canon"))


sql("canonical_sources", r"""
SELECT doc_id,
  trim(regexp_replace(regexp_replace(upper(trim(source)), '[^\w\s\-]', '', 'g'), '\s+', ' ', 'g')) AS source_canon
FROM documents
""")


@query("keyword_exclusion")
def keyword_exclusion(spark, sf_dir):
    """Substring keyword exclusion (F6) on upper-cased part types."""
    part = table(spark, sf_dir, "part")
    keep = C.excludes_keywords(F.upper(F.col("p_type")), ("BRASS", "STEEL"))
    return part.where(keep).select("p_partkey", "p_type")


sql("keyword_exclusion", """
SELECT p_partkey, p_type FROM part
WHERE NOT coalesce(contains(upper(p_type), 'BRASS') OR contains(upper(p_type), 'STEEL'), false)
""")


# ----------------------------------------------------------------- joins
@query("dim_lookup")
def dim_lookup(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    joined, _ = J.lookup(sup, nat, "s_nationkey", "n_name")
    return joined.select("s_suppkey", "s_name", "n_name")


sql("dim_lookup", """
SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
""")


@query("dim_unmatched")
def dim_unmatched(spark, sf_dir):
    """Unmatched-key count after a left lookup (A34): orders whose customer
    has no row in a customer subset keyed by segment."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    cust = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING") \
        .select("c_custkey", "c_mktsegment")
    _, unmatched = J.lookup(orders, cust, "c_custkey", "c_mktsegment")
    return unmatched


sql("dim_unmatched", """
SELECT count(*) FILTER (WHERE c.c_mktsegment IS NULL) AS n_unmatched
FROM orders o LEFT JOIN (SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING') c
  ON o.o_custkey = c.c_custkey
""")


@query("anti_resume")
def anti_resume(spark, sf_dir):
    """Order dates with no shipment on that day yet."""
    od = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    done = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return J.anti_done(od, done, "date")


sql("anti_resume", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders
WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_shipdate IS NOT NULL)
""")


@query("semi_dates")
def semi_dates(spark, sf_dir):
    """Orders of BUILDING customers."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    keys = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING") \
        .select(F.col("c_custkey").alias("o_custkey"))
    return J.semi(orders, keys, "o_custkey")


sql("semi_dates", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")


@query("outer_metrics")
def outer_metrics(spark, sf_dir):
    """Per (date, user): mean click value full-outer sum purchase value."""
    ev = table(spark, sf_dir, "events").select(F.to_date("ts").alias("date"), "user_id",
                                               "event_type", "value")
    clicks = ev.where(F.col("event_type") == "click").groupBy("date", "user_id") \
        .agg(F.avg("value").alias("click_mean"))
    buys = ev.where(F.col("event_type") == "purchase").groupBy("date", "user_id") \
        .agg(F.sum("value").alias("purchase_sum"))
    out = J.merge_metrics([clicks, buys], ["date", "user_id"])
    return out.select("date", "user_id", rnd("click_mean"), rnd("purchase_sum"))


sql("outer_metrics", f"""
WITH e AS (SELECT CAST(ts AS DATE) AS date, user_id, event_type, value FROM events),
c AS (SELECT date, user_id, avg(value) AS click_mean FROM e WHERE event_type = 'click' GROUP BY 1, 2),
b AS (SELECT date, user_id, sum(value) AS purchase_sum FROM e WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT coalesce(c.date, b.date) AS date, coalesce(c.user_id, b.user_id) AS user_id,
  round(c.click_mean, {R}) AS click_mean, round(b.purchase_sum, {R}) AS purchase_sum
FROM c FULL OUTER JOIN b ON c.date = b.date AND c.user_id = b.user_id
""")


# ------------------------------------------------------------- set ops
@query("set_compare")
def set_compare(spark, sf_dir):
    """Nation keys of customers vs suppliers."""
    return J.compare_keys(table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier"),
                          "c_nationkey", "s_nationkey", "nationkey")


sql("set_compare", """
WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_nationkey IS NOT NULL),
b AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_nationkey IS NOT NULL)
SELECT coalesce(a.k, b.k) AS nationkey,
  CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both'
       WHEN a.k IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM a FULL OUTER JOIN b ON a.k = b.k
""")


@query("union_latest")
def union_latest(spark, sf_dir):
    """Union of two id->name lists, later list wins for a repeated id (U2):
    nation names, then region names, keyed by the key text."""
    a = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"),
                                              F.col("n_name").alias("name"))
    b = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("id"),
                                              F.col("r_name").alias("name"))
    return J.union_latest(a, b, "id", "name")


sql("union_latest", """
WITH u AS (SELECT trim(CAST(n_nationkey AS VARCHAR)) AS id, trim(n_name) AS name, 0 AS src FROM nation
           UNION ALL
           SELECT trim(CAST(r_regionkey AS VARCHAR)), trim(r_name), 1 FROM region)
SELECT id, arg_max(name, src) AS name FROM u WHERE id IS NOT NULL AND id <> '' GROUP BY id
""")


@query("union_loose")
def union_loose(spark, sf_dir):
    """Union of sources with different columns, then a daily mean."""
    a = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"),
                                              F.col("o_totalprice").alias("amount"))
    b = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"),
                                                F.col("l_extendedprice").alias("amount"),
                                                F.col("l_quantity"))
    u = J.union_loose([a, b])
    # Prices carry 2 decimals and quantities are whole: summing them exactly
    # (DECIMAL / integral doubles) makes each mean one correctly rounded
    # division, independent of the summation order across partitions, so no
    # output rounding is needed (rounding would reintroduce tie differences).
    exact_mean = F.sum(F.col("amount").cast("decimal(18,2)")).cast("double") / F.count("amount")
    return u.groupBy("date").agg(exact_mean.alias("amount_mean"),
                                 F.avg("l_quantity").alias("qty_mean"))


sql("union_loose", f"""
WITH u AS (SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS amount, NULL::DOUBLE AS l_quantity FROM orders
           UNION ALL BY NAME
           SELECT CAST(l_shipdate AS DATE) AS date, l_extendedprice AS amount, l_quantity FROM lineitem)
SELECT date, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) AS amount_mean,
  avg(l_quantity) AS qty_mean FROM u GROUP BY date
""")


# --------------------------------------------------------------- reshape
FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("unpivot_features")
def unpivot_features(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return RS.unpivot_features(li, ["l_orderkey", "l_linenumber"], FEATS)


sql("unpivot_features", """
SELECT l_orderkey, l_linenumber, feature, value FROM (
  UNPIVOT (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity,
                  CAST(l_extendedprice AS DOUBLE) AS l_extendedprice, CAST(l_discount AS DOUBLE) AS l_discount,
                  CAST(l_tax AS DOUBLE) AS l_tax FROM lineitem)
  ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE value)
""")


@query("pivot_daily")
def pivot_daily(spark, sf_dir):
    """User x event-type mean value, 0 fill."""
    ev = table(spark, sf_dir, "events")
    out = RS.pivot_mean(ev, "user_id", "event_type", "value", ["click", "error", "purchase", "signup", "view"])
    return out.select("user_id", *[rnd(c) for c in out.columns if c != "user_id"])


sql("pivot_daily", f"""
SELECT user_id,
  round(coalesce(avg(value) FILTER (WHERE event_type = 'click'), 0), {R}) AS click,
  round(coalesce(avg(value) FILTER (WHERE event_type = 'error'), 0), {R}) AS error,
  round(coalesce(avg(value) FILTER (WHERE event_type = 'purchase'), 0), {R}) AS purchase,
  round(coalesce(avg(value) FILTER (WHERE event_type = 'signup'), 0), {R}) AS signup,
  round(coalesce(avg(value) FILTER (WHERE event_type = 'view'), 0), {R}) AS view
FROM events GROUP BY user_id
""")


@query("payload_flatten")
def payload_flatten(spark, sf_dir):
    """JSON props -> (key, value) rows -> daily roll-up per (date, type, key):
    sum for purchases, mean otherwise (S13, U12, A6)."""
    ev = RS.json_map(table(spark, sf_dir, "events"), "props")
    flat = ev.select(F.to_date("ts").alias("date"), "event_type",
                     F.explode("props_map").alias("key", "v"))
    return RS.rollup_readings(flat, "date", "key", "event_type", "v", ("purchase",), 4)


sql("payload_flatten", """
WITH f AS (SELECT CAST(ts AS DATE) AS date, event_type, 'k' AS key,
                  CAST(json_extract(props, '$.k') AS DOUBLE) AS v FROM events)
SELECT date, key, event_type,
  round(CASE WHEN event_type IN ('purchase') THEN sum(v) ELSE avg(v) END, 4) AS value
FROM f GROUP BY date, key, event_type
""")


@query("month_gaps")
def month_gaps(spark, sf_dir):
    """Monthly order counts with empty months kept."""
    return S.month_gaps(table(spark, sf_dir, "orders"), "o_orderdate")


sql("month_gaps", """
WITH c AS (SELECT last_day(CAST(o_orderdate AS DATE)) AS month, count(*) AS n FROM orders
           WHERE o_orderdate IS NOT NULL GROUP BY 1),
cal AS (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(month)),
                                                   date_trunc('month', max(month)), INTERVAL 1 MONTH)) AS DATE)) AS month FROM c)
SELECT cal.month, CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows, coalesce(c.n, 0) = 0 AS is_gap
FROM cal LEFT JOIN c USING (month)
""")
