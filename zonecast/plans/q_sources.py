"""Queries: sources and sinks landed from the driver tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import text as text_of
from ..operators import clean as CL
from ..operators import reshape as RS
from ..operators import spatial as G
from ..session import scratch_path
from ..sources import readers as RD
from ..sources import sinks as SK
from .oracle import sql
from .registry import R, query, rnd
from .tables import table

V2 = ("data STRUCT<stations: ARRAY<STRUCT<id: STRING, name: STRING>>, "
      "readings: ARRAY<STRUCT<timestamp: STRING, data: ARRAY<STRUCT<stationId: STRING, value: DOUBLE>>>>>")
FILE_READINGS = 200_000  # of a station's readings, in a file
V1 = ("metadata STRUCT<stations: ARRAY<STRUCT<id: STRING, name: STRING, location: STRUCT<latitude: DOUBLE, longitude: DOUBLE>>>>, "
      "items ARRAY<STRUCT<timestamp: STRING, readings: ARRAY<STRUCT<station_id: STRING, value: DOUBLE>>>>")


def _folder(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _event_station(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("timestamp"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("id"),
        F.when(F.col("user_id") % 3 != 0, F.concat(F.lit("user "), F.col("user_id").cast("string"))).alias("name"),
        "user_id", "value")


@query("payload_readings")
def payload_readings(spark, sf_dir):
    """v2 station payloads, one JSON document per event, landed and read back
    with an explicit schema, then flattened (S13).  Every third station is
    missing in its document's list."""
    e = _event_station(spark, sf_dir)
    station = F.struct(F.when(F.col("name").isNotNull(), F.col("id")).otherwise(F.lit("other")).alias("id"), "name")
    reading = F.struct("timestamp", F.array(F.struct(F.col("id").alias("stationId"), "value")).alias("data"))
    path = _folder(spark, "payload-v2")
    e.select(F.to_json(F.struct(F.struct(F.array(station).alias("stations"), F.array(reading).alias("readings")).alias("data")))
             .alias("value")).write.text(path)
    out = RS.flatten_readings(spark.read.schema(V2).json(path))
    return out.select("reading_ts", "station_id", "station_name", rnd("value"))


sql("payload_readings", f"""
SELECT CAST(event_id AS VARCHAR) AS reading_ts, 'U' || user_id AS station_id,
  CASE WHEN user_id % 3 <> 0 THEN 'user ' || user_id END AS station_name, round(value, {R}) AS value FROM events""")


@query("payload_readings_v1")
def payload_readings_v1(spark, sf_dir):
    """v1 station payloads with locations, landed, read back, flattened."""
    e = _event_station(spark, sf_dir)
    place = F.struct((F.col("user_id") / 8).alias("latitude"), (F.col("user_id") / 4).alias("longitude"))
    station = F.struct("id", "name", place.alias("location"))
    item = F.struct("timestamp", F.array(F.struct(F.col("id").alias("station_id"), "value")).alias("readings"))
    path = _folder(spark, "payload-v1")
    e.select(F.to_json(F.struct(F.struct(F.array(station).alias("stations")).alias("metadata"), F.array(item).alias("items")))
             .alias("value")).write.text(path)
    out = RS.flatten_readings_v1(spark.read.schema(V1).json(path))
    return out.select("reading_ts", "station_id", "station_name", "latitude", "longitude", rnd("value"))


sql("payload_readings_v1", f"""
SELECT CAST(event_id AS VARCHAR) AS reading_ts, 'U' || user_id AS station_id,
  CASE WHEN user_id % 3 <> 0 THEN 'user ' || user_id END AS station_name,
  user_id / 8.0::DOUBLE AS latitude, user_id / 4.0::DOUBLE AS longitude, round(value, {R}) AS value FROM events""")


@query("geojson_roundtrip")
def geojson_roundtrip(spark, sf_dir):
    """Zone boxes as GeoJSON Features written and read back, one row per part,
    with their area (S7, S8, K3, G3)."""
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").cast("double").alias("k"))
    x, y = F.col("k") / 2, F.col("k") / 4
    ring = F.array(F.array(x, y), F.array(x + 2, y), F.array(x + 2, y + 3), F.array(x, y + 3), F.array(x, y))
    path = _folder(spark, "geojson")
    SK.write_features(c.select("name", F.array(ring).alias("geometry")), path, ["name"], "geometry")
    back = RD.read_polygons(spark, path, {"name": "zone"}, lines=True)
    return back.select("zone", "geometry_type", F.col("part").cast("int").alias("part"),
                       F.size(F.col("geometry")[0]).cast("int").alias("points"),
                       F.round(G.polygon_area(F.col("geometry")), R).alias("area"),
                       F.col("geometry")[0][0][0].alias("west"))


sql("geojson_roundtrip", """
SELECT c_name AS zone, 'Polygon' AS geometry_type, 0 AS part, 5 AS points, 6.0::DOUBLE AS area, c_custkey / 2.0::DOUBLE AS west
FROM customer""")


@query("append_log")
def append_log(spark, sf_dir):
    """Two runs append their rows to an operational log with the load time;
    the log holds both (K4, K6)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = _folder(spark, "log")
    SK.append_log(o, path)
    SK.append_log(o.where(F.col("o_orderstatus") == "F"), path)
    log = spark.read.parquet(path)
    return log.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("logged_at").isNotNull()).alias("timed"))


sql("append_log", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END::BIGINT AS n, true AS timed FROM orders""")


# -------------------------------------------- row positions, reports, encodings
@query("first_in_file")
def first_in_file(spark, sf_dir):
    """Snapshot files of several splits: of each (zone, type) the first row of
    the file stays, whatever its values (W10, S1, S3).  Files hold some users'
    events, a user's all in one file and the latest first; there are as many
    files as the size asks for, not one per user."""
    path = _folder(spark, "positions")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("user_id").alias("zone"))
    ev.repartition("zone").sortWithinPartitions("zone", F.col("event_id").desc()).write.csv(path)
    schema = "event_id bigint, user_id bigint, event_type string, zone bigint"
    df = RD.with_row_position(RD.with_provenance(spark.read.schema(schema).csv(path)))
    out = CL.dedup_first(df, ["user_id", "event_type"], ["source_file", "source_block", "source_row"])
    return out.select("user_id", "event_type", "event_id")


sql("first_in_file", "SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY user_id, event_type")


@query("layout_report")
def layout_report(spark, sf_dir):
    """Census-like reports, one per market segment: twelve lead lines, a
    section header per region, indented nations, a footer; read back with
    line numbers and the section carried down (S6, W6)."""
    path = _folder(spark, "report")
    nat = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cust = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("seg"), "c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    rows = cust.join(nat, F.col("c_nationkey") == F.col("n_nationkey")).select("seg", "r_name", "n_name", "n")
    zeros = ",0" * (len(RD.AGE_GROUPS) - 1)

    def line(text, *order):
        return F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], text.alias("line"))

    body = rows.select("seg", line(F.concat(F.lit("  "), "n_name", F.lit(","), "n", F.lit(zeros)), F.lit(1), F.col("r_name"), F.lit(1), F.col("n_name")).alias("x"))
    head = rows.groupBy("seg", "r_name").agg(F.sum("n").alias("n")).select(
        "seg", line(F.concat("r_name", F.lit(" - Total,"), "n", F.lit(zeros)), F.lit(1), F.col("r_name"), F.lit(0), F.lit("")).alias("x"))
    lead = rows.select("seg").distinct().select("seg", F.explode(F.sequence(F.lit(0), F.lit(RD.REPORT_SKIP - 1))).alias("i")).select(
        "seg", line(F.concat(F.lit("meta "), "i"), F.lit(0), F.format_string("%02d", "i"), F.lit(0), F.lit("")).alias("x"))
    foot = rows.select("seg").distinct().select("seg", line(F.lit("Values are shown in numbers,,"), F.lit(2), F.lit(""), F.lit(0), F.lit("")).alias("x"))
    every = body.unionByName(head).unionByName(lead).unionByName(foot)
    every.repartition("seg").sortWithinPartitions("seg", "x").select("seg", "x.line").write.partitionBy("seg").text(path)
    rep = RD.carry_header(RD.read_layout_report(spark, path))
    seg = F.regexp_extract(F.url_decode("file"), "seg=([^/]+)/", 1)
    return rep.select(seg.alias("segment"), "planning_area", "name", F.col("total").cast("long").alias("total"), F.col("idx").cast("long").alias("line"))


sql("layout_report", """
WITH c AS (SELECT c_mktsegment AS segment, r_name AS planning_area, n_name AS name, count(*) AS total
           FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT segment, planning_area, name, total,
  11 + dense_rank() OVER (PARTITION BY segment ORDER BY planning_area) + row_number() OVER (PARTITION BY segment ORDER BY planning_area, name) AS line
FROM c
""")


@query("station_files")
def station_files(spark, sf_dir):
    """Station files whose headers differ from file to file (S15, S5, P3):
    events as readings, per type one station; half of the stations have their
    columns in another order and one more column.  A station has a file per
    some FILE_READINGS readings."""
    path = _folder(spark, "stations")
    ev = table(spark, sf_dir, "events").where("ts IS NOT NULL").select(
        F.col("event_type").alias("station"), "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofmonth("ts").alias("d"),
        F.when(F.col("value") > 100, F.lit("—")).otherwise(F.col("value").cast("string")).alias("rain"), F.col("user_id").alias("temp"))
    # one row per station
    files = ev.groupBy(F.col("station").alias("_station")).agg(F.floor(F.count(F.lit(1)) / FILE_READINGS).alias("_last"))
    number = F.pmod(F.xxhash64("event_id", "y", "m", "d", "rain", "temp"), F.col("_last") + 1)
    ev = ev.join(files, F.col("station").eqNullSafe(F.col("_station"))).withColumn("file", number)
    odd = F.length("station") % 2 == 1
    text = F.when(odd, F.concat_ws(",", F.lit("x"), "temp", "d", "m", "y", "rain")).otherwise(F.concat_ws(",", "y", "m", "d", "rain", "temp"))
    header = F.when(odd, F.lit("Station,Mean Temperature (°C), Day ,Month,Year,Daily Rainfall Total (mm)")).otherwise(
        F.lit("Year,Month,Day,Daily Rainfall Total (mm),Mean Temperature (°C)"))
    lines = ev.select("station", "file", F.col("event_id").alias("o"), text.alias("line")).unionByName(
        ev.select("station", "file").distinct().select("station", "file", F.lit(-1).cast("long").alias("o"), header.alias("line")))
    lines.repartition("station", "file").sortWithinPartitions("station", "file", "o").select("station", "file", "line") \
        .write.partitionBy("station", "file").text(path)
    out = RD.read_station_csv(spark, path, station_pattern="station=([^/]+)/")
    return out.groupBy("station_id", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("n"), F.count("rainfall_mm").alias("n_rain"), F.round(F.sum("rainfall_mm"), 4).alias("rain"), F.sum("temp_mean_c").alias("temp"))


sql("station_files", """
SELECT event_type AS station_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, count(*) AS n,
  count(*) FILTER (value <= 100) AS n_rain, round(sum(value) FILTER (value <= 100), 4) AS rain, CAST(sum(user_id) AS DOUBLE) AS temp
FROM events WHERE ts IS NOT NULL GROUP BY ALL
""")


@query("mixed_encodings")
def mixed_encodings(spark, sf_dir):
    """Customer names in UTF-8 files and in windows-1252 files, read back with
    the encoding decided per file (S1, S2, S3, P8)."""
    path = _folder(spark, "encodings")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    utf8 = c.where("c_custkey % 2 = 0").select("c_custkey", F.concat("c_name", F.lit(" é – €")).alias("name"))
    # byte 0x96 is a dash and 0x80 a euro sign in windows-1252; ISO-8859-1 writes those bytes for these two characters
    other = c.where("c_custkey % 2 = 1").select("c_custkey", F.concat("c_name", F.lit(" é \x96 \x80")).alias("name"))
    utf8.write.csv(f"{path}/a")
    other.write.option("encoding", "ISO-8859-1").csv(f"{path}/b")
    df = RD.read_snapshots(spark, [f"{path}/a", f"{path}/b"], ("custkey", "name"), "*.csv")
    return df.select(F.col("custkey").cast("long").alias("c_custkey"), text_of("name").alias("name"), "source_folder")


sql("mixed_encodings", """
SELECT c_custkey, c_name || ' é – €' AS name, CASE WHEN c_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS source_folder FROM customer
""")
