"""Queries: the silver steps one by one, each with its SQL twin (F1-F5, P4,
P7-P15, P23, J4, G2-G5, D1, S4, S5, K5, T4, W9).  ``gold_table`` chains them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import density, norm, text, ymd_date
from ..operators import gold as GD
from ..operators import joins as J
from ..operators import ordering as O
from ..operators import panel as P
from ..operators import serving as SV
from ..operators import spatial as G
from ..session import scratch_path
from ..sources import readers as RD
from ..sources import sinks as SK
from .oracle import ORACLE, sql
from .q_drift import _ATTR_CTE, _importances, dq_report
from .q_gold import LAT0, LON0, SPAN_LAT, SPAN_LON, bronze_inputs
from .registry import R, query, rnd
from .tables import table


def _folder(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


# ------------------------------------------------------------ cluster snapshots
def bronze_clusters(spark, sf_dir):
    """The gold chain's snapshots with every fault that silver removes: another
    folder, unreadable dates, no cases, places outside the box, repeats."""
    clusters, *_ = bronze_inputs(spark, sf_dir)
    k = F.col("total_cases")
    return clusters.withColumn("source_folder", F.when(k % 11 == 0, F.lit("incorrect")).otherwise(F.col("source_folder"))) \
        .withColumn("date", F.when(k % 13 == 0, F.lit("2024-02-31")).otherwise(F.col("date"))) \
        .withColumn("cases", F.when(k % 7 == 0, F.lit(0)).otherwise(F.col("cases"))) \
        .withColumn("latitude", F.when(k % 17 == 0, F.lit(2.0)).otherwise(F.col("latitude"))) \
        .withColumn("location", F.concat(F.lit(" "), F.initcap("location"), F.lit(" ")))


_CLUSTERS_SQL = f"""
c AS (SELECT CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS date, CAST(e.user_id AS DOUBLE) AS cluster_id,
        ' ' || upper(event_type[1]) || event_type[2:] || ' ' AS location,
        CASE WHEN event_id % 17 = 0 THEN 2.0 ELSE CAST({LAT0} AS DOUBLE) + (CAST(v.embedding[2] AS DOUBLE) + 0.5) * CAST({SPAN_LAT} AS DOUBLE) END AS latitude,
        CAST({LON0} AS DOUBLE) + (CAST(v.embedding[1] AS DOUBLE) + 0.5) * CAST({SPAN_LON} AS DOUBLE) AS longitude,
        CASE WHEN event_id % 7 = 0 THEN 0 ELSE 1 + CAST(value > 100 AS INTEGER) END AS cases,
        CASE WHEN event_type <> 'error' THEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS recent_cases,
        event_id AS total_cases, CASE WHEN event_id % 11 = 0 THEN 'incorrect' ELSE 'csv' END AS source_folder
      FROM events e LEFT JOIN embeddings v ON v.vec_id = e.user_id),
t AS (SELECT *, CASE WHEN source_folder <> 'csv' THEN 'folder' WHEN date IS NULL THEN 'no_date'
        WHEN NOT coalesce(latitude BETWEEN 1.15 AND 1.48 AND longitude BETWEEN 103.6 AND 104.1, false) THEN 'outside_bbox'
        WHEN NOT cases > 0 THEN 'no_cases' ELSE 'kept' END AS rule FROM c)"""


@query("silver_clusters")
def silver_clusters(spark, sf_dir):
    """Cleaned, de-duplicated cluster rows."""
    out, _ = GD.silver_clusters(bronze_clusters(spark, sf_dir))
    return out.select("date", "cluster_id", "location", rnd("latitude"), rnd("longitude"), F.col("cases").cast("long").alias("cases"),
                      F.col("recent_cases").cast("long").alias("recent_cases"), "total_cases")


sql("silver_clusters", f"""
WITH {_CLUSTERS_SQL},
o AS (SELECT *, row_number() OVER (PARTITION BY date, cluster_id, location
        ORDER BY latitude NULLS FIRST, longitude NULLS FIRST, cases, recent_cases NULLS FIRST, total_cases) AS no FROM t WHERE rule = 'kept')
SELECT date, cluster_id, lower(trim(location)) AS location, round(latitude, {R}) AS latitude, round(longitude, {R}) AS longitude,
  CAST(cases AS BIGINT) AS cases, CAST(recent_cases AS BIGINT) AS recent_cases, total_cases FROM o WHERE no = 1
""")


@query("silver_audit")
def silver_audit(spark, sf_dir):
    """Rows per rule, the first failing rule counts."""
    return GD.silver_clusters(bronze_clusters(spark, sf_dir))[1]


sql("silver_audit", f"WITH {_CLUSTERS_SQL} SELECT rule, count(*) AS n_rows FROM t GROUP BY rule")


# -------------------------------------------------------------------- weather
@query("silver_weather")
def silver_weather(spark, sf_dir):
    """National rainfall: sparse columns dropped, clipped at 300, daily mean,
    full calendar, three days filled forward, the rest interpolated (P9, P11,
    A3, U9, W4, W5).  Days 5 to 12 and 20 to 22 of a month have no readings."""
    _, weather, *_ = bronze_inputs(spark, sf_dir)
    day = F.dayofmonth(F.to_date("date"))
    rain = weather.where(~day.between(5, 12) & ~day.between(20, 22)).withColumn("rainfall_mm", F.col("rainfall_mm") * 20)
    return GD.silver_weather(rain).select("date", rnd("rainfall_mean_mm"))


sql("silver_weather", f"""
WITH r AS (SELECT CAST(ts AS DATE) AS date, least(value / 10 * 20, 300.0) AS x FROM events
           WHERE NOT day(ts) BETWEEN 5 AND 12 AND NOT day(ts) BETWEEN 20 AND 22),
d AS (SELECT date, avg(x) AS x FROM r WHERE date IS NOT NULL GROUP BY date),
cal AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM d), (SELECT max(date) FROM d), INTERVAL 1 DAY)) AS DATE) AS date),
f AS (SELECT cal.date, d.x, max(d.date) OVER (ORDER BY cal.date) AS pd, min(d.date) OVER (ORDER BY cal.date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nd
      FROM cal LEFT JOIN d ON d.date = cal.date),
g AS (SELECT f.date, f.x, p.x AS px, n.x AS nx, f.date - pd AS gap, nd - pd AS span FROM f JOIN d p ON p.date = pd JOIN d n ON n.date = nd)
SELECT date, round(CASE WHEN x IS NOT NULL THEN x WHEN gap <= 3 THEN px ELSE px + (nx - px) * (gap - 3) / (span - 3) END, {R}) AS rainfall_mean_mm FROM g
""")


@query("long_lags")
def long_lags(spark, sf_dir):
    """28 and 7 row means of temperature and humidity stand-ins per day."""
    li = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"), "l_discount", "l_tax").where("date IS NOT NULL")
    daily = li.groupBy("date").agg(F.avg("l_discount").alias("temp"), F.avg("l_tax").alias("humidity"))
    out = P.rolling_mean_rows(daily, "date", "temp", {"temp_28d": 28, "temp_7d": 7})
    out = P.rolling_mean_rows(out, "date", "humidity", {"humidity_28d": 28, "humidity_7d": 7})
    # ten digits: means of cents end in a 5 after six digits too often
    return out.select("date", *[rnd(c, 10) for c in ("temp_28d", "temp_7d", "humidity_28d", "humidity_7d")])


sql("long_lags", f"""
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_discount) AS t, avg(l_tax) AS h FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1)
SELECT date, {", ".join(f"round(avg({c}) OVER (ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 10) AS {name}_{n}d"
                        for c, name in (("t", "temp"), ("h", "humidity")) for n in (28, 7))} FROM d
""")


# ------------------------------------------------------- population and zones
_CENSUS_SQL = """cen AS (SELECT n_name, n_nationkey, count(c_custkey) AS total, count(*) FILTER (c_acctbal > 5000) AS age_65_69,
        count(*) FILTER (c_acctbal > 9000) AS age_90_over
      FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_custkey % 3 = 0 AND n_nationkey % 6 <> 5 GROUP BY n_name, n_nationkey)"""


def bronze_census(spark, sf_dir):
    """Census rows with names to clean, text numbers and zones without people."""
    nat = table(spark, sf_dir, "nation")
    cust = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0")
    n = nat.join(cust, (F.col("c_nationkey") == F.col("n_nationkey")) & (F.col("n_nationkey") % 6 != 5), "left")
    c = n.groupBy("n_name", "n_nationkey").agg(F.count("c_custkey").alias("total"), F.count_if(F.col("c_acctbal") > 5000).alias("age_65_69"),
                                               F.count_if(F.col("c_acctbal") > 9000).alias("age_90_over"))
    return c.select(F.concat(F.lit("  "), F.lower(F.substring("n_name", 1, 3)), F.substring("n_name", 4, 50), F.lit("*! ")).alias("subzone"),
                    F.lit("nation ").alias("planning_area"), F.when(F.col("total") > 0, F.col("total").cast("string")).otherwise(F.lit("-")).alias("total"),
                    F.col("age_65_69").cast("string").alias("age_65_69"), F.col("age_90_over").cast("string").alias("age_90_over"))


@query("silver_population")
def silver_population(spark, sf_dir):
    """Canonical names, positive totals, elderly sum and share."""
    out = GD.silver_population(bronze_census(spark, sf_dir))
    return out.select("subzone", "planning_area", *[F.col(c).cast("long").alias(c) for c in ("total", "age_65_69", "elderly_pop")], "elderly_pct")


sql("silver_population", f"""
WITH {_CENSUS_SQL}
SELECT upper(n_name) AS subzone, 'NATION' AS planning_area, total, age_65_69, age_65_69 + age_90_over AS elderly_pop,
  round(CAST(age_65_69 + age_90_over AS DOUBLE) / total, 4) AS elderly_pct FROM cen WHERE total > 0
""")


@query("zone_density")
def zone_density(spark, sf_dir):
    """Zones with their people, joined by name, and the density: null without
    people or area (J4, P15, F6)."""
    *_, zones = bronze_inputs(spark, sf_dir)
    area = GD.silver_subzones(zones).groupBy("subzone_name").agg(F.sum("area_km2").alias("area"))
    pop = GD.silver_population(bronze_census(spark, sf_dir)).select(F.col("subzone").alias("subzone_name"), F.col("total").cast("long").alias("population"))
    flat = area.withColumn("area", F.when(F.length("subzone_name") % 4 == 0, 0.0).otherwise(F.round("area", 3)))
    out = J.add_attrs(flat, pop, "subzone_name")
    return out.select("subzone_name", rnd("area", 3), "population", F.round(density("population", "area"), 2).alias("density"))


def svy21_sql(lat: str, lon: str) -> tuple[str, str]:
    """DuckDB SQL of the projection: northing and easting, by Redfearn's series
    as published for this grid."""
    s = G.SVY21
    e2 = 2 * s["f"] - s["f"] ** 2
    import math
    arc = (1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256, 3 / 8 * (e2 + e2 ** 2 / 4 + 15 * e2 ** 3 / 128), 15 / 256 * (e2 ** 2 + 3 * e2 ** 3 / 4), 35 * e2 ** 3 / 3072)
    phi = math.radians(s["lat0"])
    m0 = s["a"] * (arc[0] * phi - arc[1] * math.sin(2 * phi) + arc[2] * math.sin(4 * phi) - arc[3] * math.sin(6 * phi))

    def n(x):
        return f"CAST({x!r} AS DOUBLE)"

    p = f"radians({lat})"
    m = f"({n(s['a'])} * ({n(arc[0])} * {p} - {n(arc[1])} * sin(2 * {p}) + {n(arc[2])} * sin(4 * {p}) - {n(arc[3])} * sin(6 * {p})))"
    q = f"(1 - {n(e2)} * sin({p}) * sin({p}))"
    rho, v = f"({n(s['a'] * (1 - e2))} / pow({q}, 1.5))", f"({n(s['a'])} / sqrt({q}))"
    psi, t2, c2 = f"({v} / {rho})", f"(tan({p}) * tan({p}))", f"(cos({p}) * cos({p}))"
    w = f"(radians({lon}) - {n(math.radians(s['lon0']))})"
    north = (f"{n(s['false_n'])} + {m} - {n(m0)} + {v} * sin({p}) * cos({p}) * (pow({w}, 2) / 2 + pow({w}, 4) / 24 * {c2} * (4 * pow({psi}, 2) + {psi} - {t2})"
             f" + pow({w}, 6) / 720 * {c2} * {c2} * (8 * pow({psi}, 4) * (11 - 24 * {t2}) - 28 * pow({psi}, 3) * (1 - 6 * {t2}) + pow({psi}, 2) * (1 - 32 * {t2}) - 2 * {psi} * {t2} + {t2} * {t2})"
             f" + pow({w}, 8) / 40320 * {c2} * {c2} * {c2} * (1385 - 3111 * {t2} + 543 * {t2} * {t2} - pow({t2}, 3)))")
    east = (f"{n(s['false_e'])} + {v} * {w} * cos({p}) * (1 + pow({w}, 2) / 6 * {c2} * ({psi} - {t2})"
            f" + pow({w}, 4) / 120 * {c2} * {c2} * (4 * pow({psi}, 3) * (1 - 6 * {t2}) + pow({psi}, 2) * (1 + 8 * {t2}) - 2 * {psi} * {t2} + {t2} * {t2})"
             f" + pow({w}, 6) / 5040 * pow({c2}, 3) * (61 - 479 * {t2} + 179 * {t2} * {t2} - pow({t2}, 3)))")
    return north, east


def ring_area_sql(rings: str) -> str:
    """DuckDB SQL: CTEs up to ``area`` (id, km2), from ``rings`` (id, i, lon,
    lat), each a closed ring's points."""
    north, east = svy21_sql("lat", "lon")
    return f"""{rings},
prj AS (SELECT id, i, {east} AS x, {north} AS y FROM ring),
nxt AS (SELECT id, x, y, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM prj WINDOW w AS (PARTITION BY id ORDER BY i)),
area AS (SELECT id, abs(sum(x * y2 - x2 * y)) / 2 / 1e6 AS km2 FROM nxt WHERE x2 IS NOT NULL GROUP BY id)"""


_NATION_RING = f"""ring AS (SELECT n_name AS id, i, CAST({LON0} AS DOUBLE) + (n_nationkey % 5 + CASE WHEN i IN (1, 2) THEN 1 ELSE 0 END) * CAST({SPAN_LON / 5} AS DOUBLE) AS lon,
        CAST({LAT0} AS DOUBLE) + (n_nationkey // 5 + CASE WHEN i IN (2, 3) THEN 1 ELSE 0 END) * CAST({SPAN_LAT / 5} AS DOUBLE) AS lat
      FROM nation, range(0, 5) r(i))"""

sql("zone_density", f"""
WITH {ring_area_sql(_NATION_RING)}, {_CENSUS_SQL},
z AS (SELECT id, CASE WHEN length(id) % 4 = 0 THEN 0.0 ELSE round(km2, 3) END AS area FROM area)
SELECT id AS subzone_name, area, CASE WHEN total > 0 THEN total END AS population,
  round(CASE WHEN total > 0 THEN total END / nullif(area, 0), 2) AS density FROM z JOIN cen ON n_name = id
""")


# the measured polygons of ``zone_area_km2``: a vertex per pair of components; closed, of 4 points or more
_EMB_RING = """ring AS (SELECT vec_id AS id, i, 103.8 + CAST(embedding[(i % n) * 2 + 1] AS DOUBLE) * 0.2 AS lon, 1.35 + CAST(embedding[(i % n) * 2 + 2] AS DOUBLE) * 0.2 AS lat
      FROM (SELECT vec_id, embedding, len(embedding) // 2 AS n, unnest(range(0, len(embedding) // 2 + 1)) AS i FROM embeddings))"""
sql("zone_area_km2", f"""
WITH {ring_area_sql(_EMB_RING)}
SELECT id AS vec_id, round(km2, 4) AS area_km2, true AS valid, CAST(NULL AS VARCHAR) AS invalid_reason FROM area
""")


@query("polygon_screening")
def polygon_screening(spark, sf_dir):
    """Rings that are closed, open, flat or too short, told apart."""
    nat = table(spark, sf_dir, "nation")
    x = F.col("n_nationkey").cast("double")
    kind = F.col("n_nationkey") % 4

    def p(a, b):
        return F.array(x + a, F.lit(float(b)))

    ring = F.when(kind == 0, F.array(p(0, 0), p(1, 0), p(1, 1), p(0, 0))).when(kind == 1, F.array(p(0, 0), p(1, 0), p(1, 1), p(0, 1))) \
        .when(kind == 2, F.array(p(0, 0), p(1, 0), p(2, 0), p(0, 0))).otherwise(F.array(p(0, 0), p(1, 0), p(0, 0)))
    return G.screen_polygons(nat.select("n_nationkey", F.array(ring).alias("geometry"))).select("n_nationkey", "valid", "invalid_reason")


sql("polygon_screening", """
SELECT n_nationkey, n_nationkey % 4 = 0 AS valid, CASE n_nationkey % 4 WHEN 1 THEN 'open_ring' WHEN 2 THEN 'zero_area' WHEN 3 THEN 'too_few_points' END AS invalid_reason FROM nation
""")


@query("centroid_near")
def centroid_near(spark, sf_dir):
    """Places within 0.03 degrees of each zone's centroid; zones are L-shaped,
    so that the centroid isn't the box's middle (G5, J14)."""
    *_, zones = bronze_inputs(spark, sf_dir)
    a, b, c = (F.col("geometry")[0][k] for k in range(3))
    w, h = b[0] - a[0], c[1] - b[1]
    shape = F.array(F.array(a[0], a[1]), F.array(b[0], b[1]), F.array(b[0], b[1] + h / 2), F.array(a[0] + w / 2, a[1] + h / 2),
                    F.array(a[0] + w / 2, c[1]), F.array(a[0], c[1]), F.array(a[0], a[1]))
    centre = zones.select("subzone_name", F.array(shape).alias("geometry")).select("subzone_name", G.polygon_centroid(F.col("geometry")).alias("c"))
    centre = centre.select("subzone_name", F.col("c.x").alias("cx"), F.col("c.y").alias("cy"))
    emb = table(spark, sf_dir, "embeddings").select((F.lit(LON0) + (F.col("embedding")[0].cast("double") + 0.5) * SPAN_LON).alias("x"),
                                                    (F.lit(LAT0) + (F.col("embedding")[1].cast("double") + 0.5) * SPAN_LAT).alias("y"))
    near = G.near_count(emb, centre, "x", "y", "cx", "cy", "subzone_name", 0.03, "n_near")
    return near.join(centre, "subzone_name").select("subzone_name", rnd("cx"), rnd("cy"), "n_near")


# an L of three of a box's four quarters: its centroid is 5/12 along both sides
sql("centroid_near", f"""
WITH z AS (SELECT n_name, CAST({LON0} AS DOUBLE) + (n_nationkey % 5 + 5.0 / 12) * CAST({SPAN_LON / 5} AS DOUBLE) AS cx,
             CAST({LAT0} AS DOUBLE) + (n_nationkey // 5 + 5.0 / 12) * CAST({SPAN_LAT / 5} AS DOUBLE) AS cy FROM nation),
e AS (SELECT CAST({LON0} AS DOUBLE) + (CAST(embedding[1] AS DOUBLE) + 0.5) * CAST({SPAN_LON} AS DOUBLE) AS x,
        CAST({LAT0} AS DOUBLE) + (CAST(embedding[2] AS DOUBLE) + 0.5) * CAST({SPAN_LAT} AS DOUBLE) AS y FROM embeddings)
SELECT n_name AS subzone_name, round(cx, {R}) AS cx, round(cy, {R}) AS cy,
  (SELECT count(*) FROM e WHERE (x - cx) * (x - cx) + (y - cy) * (y - cy) <= 0.03 * 0.03) AS n_near FROM z
""")


# ------------------------------------------------------------ small operators
@query("headered_csv")
def headered_csv(spark, sf_dir):
    """A headered CSV with padded names, read with a schema and a pushed
    filter, its header cleaned (S4, S5, K1)."""
    path = _folder(spark, "headered")
    SK.write_layer(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(" cust key "), F.col("c_acctbal").alias("Balance "), F.col("c_mktsegment").alias(" seg")), path, "csv")
    df = RD.read_table(spark, path, "` cust key ` bigint, `Balance ` double, ` seg` string", "csv", F.col("Balance ") > 0)
    return RD.clean_header(df, {"cust key": "c_custkey", "Balance": "c_acctbal", "seg": "c_mktsegment"})


sql("headered_csv", "SELECT c_custkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 0")


@query("dates_of_parts")
def dates_of_parts(spark, sf_dir):
    """Dates from year, month and day numbers, null where there is no such day;
    names upper-cased and trimmed (P4, P8, P30)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey"), F.col("l_suppkey"), F.col("l_returnflag"))
    d = ymd_date(F.lit(2023) + F.col("l_linenumber") % 2, F.col("l_partkey") % 14, F.col("l_suppkey") % 33)
    return li.select("l_orderkey", "l_linenumber", d.alias("day"), norm(F.concat(F.lit(" "), F.lower("l_returnflag"), F.lit("  ")), "upper").alias("mode"), text("l_partkey").alias("part"))


sql("dates_of_parts", """
SELECT l_orderkey, l_linenumber, TRY_CAST(printf('%04d-%02d-%02d', 2023 + l_linenumber % 2, l_partkey % 14, l_suppkey % 33) AS DATE) AS day,
  upper(l_returnflag) AS mode, CAST(l_partkey AS VARCHAR) AS part FROM lineitem
""")


@query("fresh_vulnerability")
def fresh_vulnerability(spark, sf_dir):
    """Zones' balances replaced by fresher values where there are any."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("double").alias("level"))
    fresh = table(spark, sf_dir, "orders").where("o_custkey % 3 = 0").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(F.col("o_totalprice").cast("double")).alias("level"))
    return SV.override(c, fresh, "c_custkey", "level").select("c_custkey", rnd("level"))


sql("fresh_vulnerability", f"""
WITH f AS (SELECT o_custkey, max(CAST(o_totalprice AS DOUBLE)) AS level FROM orders WHERE o_custkey % 3 = 0 GROUP BY 1)
SELECT c_custkey, round(coalesce(level, CAST(c_acctbal AS DOUBLE)), {R}) AS level FROM customer LEFT JOIN f ON o_custkey = c_custkey
""")


@query("top_importances")
def top_importances(spark, sf_dir):
    """The eight features with the greatest importance (T4)."""
    base, _ = _importances(spark, sf_dir)
    return O.top_k(base, "importance", 8, None, "pos").select("feature", "importance")


sql("top_importances", f"WITH {_ATTR_CTE} SELECT feature, importance FROM bi ORDER BY importance DESC, pos LIMIT 8")


@query("json_report")
def json_report(spark, sf_dir):
    """The quality report written as JSON and read back."""
    path = _folder(spark, "report-json")
    SK.write_layer(dq_report(spark, sf_dir), path, "json")
    return spark.read.schema("check string, metric double, threshold double, passed boolean").json(path)


ORACLE["json_report"] = ORACLE["dq_report"]


@query("best_so_far")
def best_so_far(spark, sf_dir):
    """The best day's value so far, per event type."""
    d = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.max("value").alias("value"))
    return O.running_best(d, "day", "value", by=["event_type"])


sql("best_so_far", """
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, max(value) AS value FROM events GROUP BY ALL)
SELECT *, max(value) OVER (PARTITION BY event_type ORDER BY day) AS best_so_far FROM d
""")

