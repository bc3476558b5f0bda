"""Queries: file sources and sinks round trips on data derived from the
driver tables (K1, S1, S3, P1, P2, P5, P6, K7).

``snapshot_roundtrip`` lands the events as headerless snapshot-layout CSV
files (9 positional columns, YYMMDD dates, -1 sentinel, padded names) in a
fresh folder under the shared checkpoint directory, then reads them back
with the snapshot reader and cleaner."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import readers as RD
from ..sources import sinks as SK
from .oracle import sql
from .registry import query
from .tables import table


def _land_snapshots(spark, sf_dir) -> str:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    rows = ev.select(
        F.round("value").cast("int").cast("string").alias("cases"),
        F.concat(F.lit("  "), F.upper("event_type"), F.lit(" ")).alias("location"),
        F.col("value").cast("string").alias("latitude"),
        F.col("user_id").cast("string").alias("longitude"),
        F.col("user_id").cast("string").alias("cluster_id"),
        F.when(F.col("event_type") == "error", F.lit("-1")).otherwise(k).alias("recent_cases"),
        F.col("event_id").cast("string").alias("total_cases"),
        F.date_format("ts", "yyMMdd").cast("int").cast("string").alias("date_raw"),
        F.month("ts").cast("string").alias("month_num"))
    path = scratch_path(spark, f"snapshots-{uuid.uuid4().hex[:12]}/snapshots")
    SK.write_layer(rows, path, fmt="csv", header=False)
    return path


@query("snapshot_roundtrip")
def snapshot_roundtrip(spark, sf_dir):
    path = _land_snapshots(spark, sf_dir)
    raw = RD.read_snapshots(spark, [path], RD.SNAPSHOT_COLUMNS, "*.csv", encoding="UTF-8")
    return RD.clean_snapshot_rows(raw).drop("source_file")


sql("snapshot_roundtrip", """
SELECT CAST(ts AS DATE) AS date, CAST(month(ts) AS DOUBLE) AS month_num,
  CAST(user_id AS DOUBLE) AS cluster_id,
  CASE WHEN event_type = 'error' THEN NULL
       ELSE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS recent_cases,
  CAST(event_id AS DOUBLE) AS total_cases, CAST(CAST(round(value) AS INTEGER) AS DOUBLE) AS cases,
  lower(event_type) AS location, value AS latitude, CAST(user_id AS DOUBLE) AS longitude,
  'snapshots' AS source_folder
FROM events
""")


@query("insert_absent")
def insert_absent(spark, sf_dir):
    """Insert-if-absent on a key (K7): the orders of the first half of the
    calendar are stored, then all orders are offered; only new keys land."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    path = scratch_path(spark, f"orders-{uuid.uuid4().hex[:12]}")
    SK.write_layer(o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")), path)
    SK.insert_absent(o, path, ["o_orderkey"])
    return spark.read.parquet(path)


sql("insert_absent", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")


@query("gold_partitioned")
def gold_partitioned(spark, sf_dir):
    """Write the panel partitioned by date (K2) and read back the second
    half of the calendar; the date filter prunes partitions at the scan (S9,
    S10) instead of reading every file."""
    from .queries import risk_panel
    path = scratch_path(spark, f"gold-{uuid.uuid4().hex[:12]}")
    # date partitions for pruning; REBALANCE clusters rows by date for few
    # files per folder while AQE splits a hot date over several writers;
    # zones sorted inside each file so row-group statistics prune zone lookups
    SK.write_layer(risk_panel(spark, sf_dir).hint("rebalance", "date"), path,
                   partition_by=["date"], sort_within=["user_id"])
    return RD.read_table(spark, path, where=F.col("date") >= F.lit("2024-01-15").cast("date"))


def _gold_partitioned_sql() -> str:
    from .oracle import ORACLE
    return f"SELECT * FROM ({ORACLE['risk_panel']}) g WHERE date >= DATE '2024-01-15'"


sql("gold_partitioned", _gold_partitioned_sql())
