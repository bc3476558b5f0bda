"""Cases that the driver tables don't have: edge days, null dates, late
reference times, wide headers, large groups, unreadable targets."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from zonecast import session
from zonecast.operators import clean, gold, panel, series
from zonecast.sources import readers, sinks
from zonecast.streaming import cases, scoring

D = dt.date


def test_fill_series_keeps_edge_days(spark):
    rows = [("a", D(2024, 1, 1), None), ("a", D(2024, 1, 2), 1.0), ("a", D(2024, 1, 5), 4.0), ("a", D(2024, 1, 8), None),
            ("b", D(2024, 1, 1), None), ("b", D(2024, 1, 3), None), ("b", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = [(r.k, r.d.day, r.v) for r in series.fill_series(df, "d", "v", by=["k"], raw="raw", out="v").orderBy("k", "d").collect()]
    assert got == [("a", 1, None), ("a", 2, 1.0), ("a", 3, 1.0), ("a", 4, 1.0), ("a", 5, 4.0), ("a", 6, 4.0), ("a", 7, 4.0), ("a", 8, 4.0),
                   ("b", 1, None), ("b", 2, None), ("b", 3, None)]


def test_rows_without_date_belong_to_no_day(spark):
    df = spark.createDataFrame([(None, 100.0), (D(2024, 1, 1), 1.0), (D(2024, 1, 2), 3.0)], "d date, v double")
    daily = panel.daily_sum(df, "d", "v", "s")
    got = panel.rolling_mean_rows(daily, "d", "s", {"m": 14}).orderBy("d").collect()
    assert [(r.d, r.m) for r in got] == [(D(2024, 1, 1), 1.0), (D(2024, 1, 2), 2.0)]
    assert panel.daily_distinct(df, "d", "v", "n").count() == panel.daily_mean(df, "d", "v", "m").count() == 2


def test_trailing_ends_at_the_reference(spark):
    df = spark.sql("SELECT timestamp'2024-01-30' AS ts UNION ALL SELECT timestamp'2024-02-28' UNION ALL SELECT timestamp'2024-01-01'")
    assert [r.ts.day for r in clean.trailing(df, "ts", 7, "2024-01-31 00:00:00").collect()] == [30]


def test_malformed_dates_are_dropped(spark):
    rows = [("2024-01-01", "1.35", "103.8", "2", "1", "a", "f", gold.RELIABLE_FOLDER), ("garbage", "1.35", "103.8", "2", "1", "b", "f", gold.RELIABLE_FOLDER)]
    df = spark.createDataFrame(rows, "date string, latitude string, longitude string, cases string, cluster_id string, location string, source_file string, source_folder string")
    kept, _ = gold.silver_clusters(df)
    assert [r.location for r in kept.collect()] == ["a"]


def test_station_csv_of_sixty_columns(spark, tmp_path):
    names = [f"x{i}" for i in range(57)] + ["Year", "Month", "Day"]
    (tmp_path / "DAILYDATA_S24_202401.csv").write_text(",".join(names) + "\n" + ",".join(["0"] * 57 + ["2024", "1", "2"]) + "\n")
    header = {"Year": "year", "Month": "month", "Day": "day"}
    got = readers.read_station_csv(spark, str(tmp_path), header_map=header).collect()
    assert [(r.station_id, r.year, r.month, r.day) for r in got] == [("S24", 2024, 1, 2)]


def test_insert_absent_raises_on_unreadable_target(spark, tmp_path):
    new = spark.createDataFrame([(1, "a")], "k int, v string")
    path = str(tmp_path / "t")
    assert sinks.insert_absent(new, path, ["k"]) == 1
    assert sinks.insert_absent(new, path, ["k"]) == 0
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet|schema"):
        sinks.insert_absent(new, str(broken), ["k"])


def test_running_counter_over_many_arrow_batches(spark, tmp_path):
    events = [(i, 1, dt.datetime(2024, 1, 2) + dt.timedelta(seconds=i)) for i in range(3000)]
    random.Random(1).shuffle(events)
    src = str(tmp_path / "in")
    spark.createDataFrame(events, "event_id long, zone long, ts timestamp").coalesce(1).write.parquet(src)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        stream = spark.readStream.schema("event_id long, zone long, ts timestamp").parquet(src).withColumn("case_count", F.lit(1))
        cases.run_available(stream.writeStream.foreachBatch(scoring.EventSink(str(tmp_path / "run"), "zone")), str(tmp_path / "ck"))
        got = scoring.read_log(spark, str(tmp_path / "run"), "events").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.event_id, r.running_count) for r in got) == [(i, i + 1) for i in range(3000)]


def test_checkpoint_folder_is_not_made_up_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
