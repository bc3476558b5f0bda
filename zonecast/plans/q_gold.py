"""Query: the whole bronze -> silver -> gold chain on inputs derived from
the driver tables (rows-only check; the pieces have SQL twins elsewhere).

* cluster snapshots: every event, located at its user's embedding (first two
  components mapped into the valid latitude/longitude box);
* station readings: the events again (event type = station, value / 10 =
  rainfall), so readings and snapshots share the calendar;
* census: customers per nation (total) and per nation with a high balance
  (the elderly band);
* zones: one grid square per nation over the same box (5 x 5 grid)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gold as GD
from .registry import query, rnd
from .tables import table

LAT0, LON0, SPAN_LAT, SPAN_LON = 1.20, 103.65, 0.25, 0.40


def bronze_inputs(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    emb = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("user_id"),
        (F.lit(LAT0) + (F.col("embedding")[1].cast("double") + 0.5) * SPAN_LAT).alias("latitude"),
        (F.lit(LON0) + (F.col("embedding")[0].cast("double") + 0.5) * SPAN_LON).alias("longitude"))
    clusters = ev.join(emb, "user_id", "left").select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("user_id").cast("int").alias("cluster_id"),
        F.col("event_type").alias("location"), "latitude", "longitude",
        (1 + (F.col("value") > 100).cast("int")).alias("cases"),
        F.when(F.col("event_type") == "error", F.lit(None))
        .otherwise(F.get_json_object("props", "$.k").try_cast("int")).alias("recent_cases"),
        F.col("event_id").alias("total_cases"), F.lit("events").alias("source_file"),
        F.lit(GD.RELIABLE_FOLDER).alias("source_folder"))
    weather = ev.select(F.date_format("ts", "yyyy-MM-dd").alias("date"),
                        F.col("event_type").alias("station_id"),
                        (F.col("value") / 10).alias("rainfall_mm"), F.col("value").alias("temp_mean_c"))
    nat = table(spark, sf_dir, "nation")
    cust = table(spark, sf_dir, "customer")
    pop = cust.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("c_acctbal") > 5000).alias("age_65_69")) \
        .join(nat, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select(F.col("n_name").alias("subzone"), F.lit("NATION").alias("planning_area"),
                "total", "age_65_69")
    i, j = F.col("n_nationkey") % 5, F.floor(F.col("n_nationkey") / 5)
    x0 = F.lit(LON0) + i * (SPAN_LON / 5)
    y0 = F.lit(LAT0) + j * (SPAN_LAT / 5)
    dx, dy = F.lit(SPAN_LON / 5), F.lit(SPAN_LAT / 5)
    ring = F.array(F.array(x0, y0), F.array(x0 + dx, y0), F.array(x0 + dx, y0 + dy),
                   F.array(x0, y0 + dy), F.array(x0, y0))
    zones = nat.select(F.col("n_name").alias("subzone_name"), F.lit("NATION").alias("planning_area"),
                       F.array(ring).alias("geometry"))
    return clusters, weather, pop, zones


@query("gold_table")
def gold_table(spark, sf_dir):
    clusters, weather, pop, zones = bronze_inputs(spark, sf_dir)
    cl, _ = GD.silver_clusters(clusters)
    gold, _ = GD.gold_features(cl, GD.silver_weather(weather), GD.silver_population(pop),
                               GD.silver_subzones(zones), cell=SPAN_LAT / 5, proximity=True)
    return gold.select(*[rnd(c, 6) if t == "double" else F.col(c) for c, t in gold.dtypes])
