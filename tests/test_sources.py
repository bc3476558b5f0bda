"""File sources and sinks on small hand-made files (test fixtures only)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from zonecast.operators import gold as GD
from zonecast.operators import reshape as RS
from zonecast.sources import readers as RD
from zonecast.sources import sinks as SK


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="zc-src-")


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_snapshot_reader_encodings_provenance_and_cleaning(spark, tmp):
    write(f"{tmp}/a/150703-clusters.csv",
          "4, Bishan Street 22 ,1.358,103.845,1,24,83,150703,7\n2,x,1.3,103.8,2,-1,5,150703,7\n")
    write(f"{tmp}/b/50704-clusters.txt", "1,Café Road,1.31,103.81,3, ,9,50704,7\n",
          encoding="latin-1")
    write(f"{tmp}/b/empty-clusters.csv", "")
    write(f"{tmp}/b/notes.csv", "ignored\n")
    raw = RD.read_snapshots(spark, [f"{tmp}/a", f"{tmp}/b"])
    rows = {r["cluster_id"]: r for r in RD.clean_snapshot_rows(raw).collect()}
    assert len(rows) == 3
    assert rows[1.0]["location"] == "bishan street 22" and rows[1.0]["source_folder"] == "a"
    assert rows[2.0]["recent_cases"] is None                    # -1 sentinel
    assert rows[3.0]["location"] == "café road"                 # ISO-8859-1 fallback
    assert rows[3.0]["recent_cases"] is None                    # " " token
    assert str(rows[3.0]["date"]) == "2005-07-04"               # lost leading zero
    assert rows[3.0]["source_file"] == "50704-clusters.txt"


def test_layout_report_and_header_carry(spark, tmp):
    lead = "\n".join(f"meta line {i}" for i in range(12))
    body = [
        "Ang Mo Kio - Total,100," + ",".join(["1"] * 19),
        "  Cheng San,60," + ",".join(["2"] * 19),
        "",
        "  Yio Chu Kang,40," + ",".join(["3"] * 19),
        "Bedok,50," + ",".join(["4"] * 19),
        "  Total Kaki,50," + ",".join(["5"] * 19),
        "Total,150," + ",".join(["6"] * 19),
    ]
    foot = "Values are shown in numbers,,\nFootnote,,"
    write(f"{tmp}/pop.csv", lead + "\n" + "\n".join(body) + "\n" + foot + "\n")
    rep = RD.read_layout_report(spark, f"{tmp}/pop.csv")
    assert rep.count() == 6                                     # blank line skipped, footer cut
    out = {r["name"]: r["planning_area"] for r in RD.carry_header(rep).collect()}
    assert out == {"Cheng San": "Ang Mo Kio", "Yio Chu Kang": "Ang Mo Kio",
                   "Total Kaki": "Bedok", "Total": "Bedok"}


def test_station_csv_with_differing_headers(spark, tmp):
    write(f"{tmp}/DAILYDATA_S24_201901.csv",
          "Station,Year,Month,Day,Daily Rainfall Total (mm),Mean Temperature (°C)\n"
          "Changi,2019,1,1,0.4,27.1\nChangi,2019,1,2,—,27.5\nChangi,,1,3,1.0,26\n")
    write(f"{tmp}/DAILYDATA_S50_201901.csv",
          "Station, Year , Month , Day ,Mean Temperature (°C),Daily Rainfall Total (mm)\n"
          "Clementi,2019,1,1,26.0,-\n")
    df = RD.read_station_csv(spark, [f"{tmp}/DAILYDATA_S24_201901.csv", f"{tmp}/DAILYDATA_S50_201901.csv"])
    rows = {(r["station_id"], r["day"]): r for r in df.collect()}
    assert set(rows) == {("S24", 1), ("S24", 2), ("S50", 1)}   # row without a year dropped
    assert rows[("S24", 1)]["rainfall_mm"] == 0.4 and rows[("S24", 2)]["rainfall_mm"] is None
    assert rows[("S50", 1)]["temp_mean_c"] == 26.0 and rows[("S50", 1)]["rainfall_mm"] is None
    assert rows[("S50", 1)]["wind_mean_kmh"] is None           # column absent in both files


def test_geojson_polygons(spark, tmp):
    sq = [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"SUBZONE_N": "A", "PLN_AREA_N": "P"},
         "geometry": {"type": "Polygon", "coordinates": sq}},
        {"type": "Feature", "properties": {"SUBZONE_N": "B", "PLN_AREA_N": "P"},
         "geometry": {"type": "MultiPolygon", "coordinates": [sq, sq]}}]}
    write(f"{tmp}/zones.geojson", json.dumps(fc))
    df = RD.read_polygons(spark, f"{tmp}/zones.geojson", {"SUBZONE_N": "subzone_name",
                                                          "PLN_AREA_N": "planning_area"})
    got = sorted((r["subzone_name"], r["part"]) for r in df.collect())
    assert got == [("A", 0), ("B", 0), ("B", 1)]
    assert df.first()["geometry"][0][2] == [1.0, 1.0]


def test_payload_flatten_v2_and_v1(spark, tmp):
    v2 = {"data": {"stations": [{"id": "S1", "name": "One"}, {"id": "S2", "name": "Two"}],
                   "readings": [{"timestamp": "2024-01-01T00:05:00", "data": [
                       {"stationId": "S1", "value": 0.2}, {"stationId": "S2", "value": 0.0}]}]}}
    write(f"{tmp}/v2/p.json", json.dumps(v2) + "\n")
    flat = RS.flatten_readings(spark.read.json(f"{tmp}/v2"))
    assert sorted((r["station_id"], r["station_name"], r["value"]) for r in flat.collect()) == \
        [("S1", "One", 0.2), ("S2", "Two", 0.0)]
    v1 = {"metadata": {"stations": [{"id": "S1", "name": "One",
                                     "location": {"latitude": 1.3, "longitude": 103.8}}]},
          "items": [{"timestamp": "t", "readings": [{"station_id": "S1", "value": 5}]}]}
    write(f"{tmp}/v1/p.json", json.dumps(v1) + "\n")
    r = RS.flatten_readings_v1(spark.read.json(f"{tmp}/v1")).first()
    assert (r["station_id"], r["latitude"], r["value"]) == ("S1", 1.3, 5.0)
    day = RS.rollup_readings(flat.withColumn("d", F.lit("2024-01-01")).withColumn("m", F.lit("rainfall")),
                             "d", "station_id", "m", "value")
    assert sorted(x["value"] for x in day.collect()) == [0.0, 0.2]


def test_sinks_append_and_insert_absent(spark, tmp):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    SK.append_log(a, f"{tmp}/log")
    SK.append_log(a, f"{tmp}/log")
    assert spark.read.parquet(f"{tmp}/log").count() == 4
    SK.write_layer(a, f"{tmp}/t")
    new = spark.createDataFrame([(2, "z"), (3, "w"), (3, "dup")], "k int, v string")
    assert SK.insert_absent(new, f"{tmp}/t", ["k"]) == 1
    assert sorted(r["k"] for r in spark.read.parquet(f"{tmp}/t").collect()) == [1, 2, 3]


def test_glob_fallback(spark, tmp):
    write(f"{tmp}/old/150703.csv", "1,a,1.3,103.8,1,1,1,150703,1\n")
    write(f"{tmp}/new/150703-clusters.csv", "1,a,1.3,103.8,1,1,1,150703,1\n")
    globs = ["*-clusters.csv", "*.csv"]
    assert RD.first_matching_glob(spark, [f"{tmp}/new"], globs) == "*-clusters.csv"
    assert RD.first_matching_glob(spark, [f"{tmp}/old"], globs) == "*.csv"
    g = RD.first_matching_glob(spark, [f"{tmp}/old"], globs)
    assert RD.read_snapshots(spark, [f"{tmp}/old"], RD.SNAPSHOT_COLUMNS_OLD, g).count() == 1


def test_json_report_write(spark, tmp):
    rep = spark.createDataFrame([("freshness", 3.0, True)], "check string, metric double, passed boolean")
    SK.write_layer(rep, f"{tmp}/report", fmt="json")
    back = spark.read.json(f"{tmp}/report").first()
    assert back["check"] == "freshness" and back["passed"] is True


def test_a_file_of_several_splits_keeps_its_row_order(spark, tmp):
    lead = [f"meta {i}" for i in range(12)]
    body = []
    for k in range(40):
        body += [f"Area {k} - Total,{k}," + ",".join(["1"] * 19), ""]
        body += [f"  Place {k}-{j},{j}," + ",".join(["2"] * 19) for j in range(7)]
    write(f"{tmp}/pop.csv", "\n".join([*lead, *body, "Values are shown,,"]) + "\n")
    snap = [f"{9 - i % 10},Road {i % 5},1.3,103.8,{i % 7},{i},9,150703,7" for i in range(300)]
    write(f"{tmp}/s/csv/150703-clusters.csv", "\n".join(snap) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700"), spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rep = RD.read_layout_report(spark, f"{tmp}/pop.csv")
        assert spark.read.text(f"{tmp}/pop.csv").rdd.getNumPartitions() > 10
        rows = rep.collect()
        assert sorted(r["idx"] for r in rows) == list(range(12, 12 + 40 * 8))
        got = {r["name"]: r["planning_area"] for r in RD.carry_header(rep).collect()}
        assert got == {f"Place {k}-{j}": f"Area {k}" for k in range(40) for j in range(7)}
        raw = RD.read_snapshots(spark, [f"{tmp}/s/csv"], positions=True)
        bronze = RD.clean_snapshot_rows(raw).withColumn("date", F.col("date").cast("string"))
        kept, _ = GD.silver_clusters(bronze)
        first = {}
        for line in snap:  # the first row of the file stays, not the least
            c = line.split(",")
            if int(c[0]) > 0:
                first.setdefault((int(c[4]), c[1].lower()), (int(c[0]), float(c[5])))
        assert {(int(r["cluster_id"]), r["location"]): (r["cases"], r["recent_cases"]) for r in kept.collect()} == first
        assert any(v[0] != 1 for v in first.values())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes"), spark.conf.unset("spark.sql.files.openCostInBytes")


def test_encodings_are_decided_per_file_and_problems_listed(spark, tmp):
    row = "4,{},1.358,103.845,{},24,83,150703,7\n"
    write(f"{tmp}/a/1-clusters.csv", row.format("Caf\u00e9 \u2013 \u6f22 \u20ac", 1) + row.format("plain", 2))
    write(f"{tmp}/a/2-clusters.csv", row.format("Caf\u00e9 \u2013 \u20ac \u0178", 3) + row.format("plain", 4), encoding="cp1252")
    write(f"{tmp}/a/3-clusters.csv", row.format("x", 5) + "1,2\n" + '4,"a,b",1,2,6,3,4,150703,7\n')
    write(f"{tmp}/a/4-clusters.csv", "")
    raw = {r["cluster_id"]: r["location"] for r in RD.read_snapshots(spark, [f"{tmp}/a"]).collect()}
    assert raw == {"1": "Caf\u00e9 \u2013 \u6f22 \u20ac", "2": "plain", "3": "Caf\u00e9 \u2013 \u20ac \u0178", "4": "plain", "5": "x", None: "2", "6": "a,b"}
    problems = {(r["source_file"], r["problem"]): r["n_rows"] for r in RD.snapshot_problems(spark, [f"{tmp}/a"]).collect()}
    assert problems == {("4-clusters.csv", "empty file"): 0, ("3-clusters.csv", "malformed row"): 1}
    assert len(RD.C1_CHARS) == len(RD.CP1252_CHARS) == 27
    assert RD.first_matching_glob(spark, [f"{tmp}/none", f"{tmp}/a"], ["*.txt", "*-clusters.csv"]) == "*-clusters.csv"
    assert RD.first_matching_glob(spark, [f"{tmp}/none"], ["*.csv"]) is None


def test_station_lines_stay_in_the_tasks_that_scan_them(spark, tmp):
    write(f"{tmp}/DAILYDATA_A_1.csv", "\n  \nYear,Month,Day,\"Rain, all\",Daily Rainfall Total (mm)\n"
          + "".join(f"2019,1,{i % 28 + 1},\"x, y\",{i}\n" for i in range(600)))
    write(f"{tmp}/DAILYDATA_B_1.csv", "Day,Month,Year,Daily Rainfall Total (mm)\n" + "".join(f"{i % 28 + 1},2,2019,{i}\n" for i in range(900))
          + "Day,Month,Year,Daily Rainfall Total (mm)\n3,2,2019,-\n4,2,2019\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = RD.read_station_csv(spark, tmp)
        assert df.rdd.getNumPartitions() > 4
        got = {r["station_id"]: r for r in df.groupBy("station_id").agg(
            F.count(F.lit(1)).alias("n"), F.count("rainfall_mm").alias("k"), F.sum("rainfall_mm").alias("s"), F.max("month").alias("m")).collect()}
        plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert tuple(got["A"])[1:] == (600, 600, 599 * 300.0, 1) and tuple(got["B"])[1:] == (902, 900, 899 * 450.0, 2)
    assert "Window" not in plan and "Sort" not in plan  # no task holds a file's or a split's lines


def test_first_in_file_writes_files_by_size_not_by_user(spark, tmp):
    import glob

    from zonecast.plans.queries import REGISTRY
    from zonecast.session import scratch_path

    rows = [(i, None if i % 150 == 149 else i % 150, ("a", "b", None)[i % 3]) for i in range(900)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string").write.parquet(f"{tmp}/events.parquet")
    files = scratch_path(spark, "positions-*/**/*.csv")
    local = files.removeprefix("file:")
    before = set(glob.glob(local, recursive=True))
    got = {(r.user_id, r.event_type): r.event_id for r in REGISTRY["first_in_file"](spark, tmp).collect()}
    want = {}
    for event_id, user_id, kind in rows:
        want[user_id, kind] = max(event_id, want.get((user_id, kind), -1))
    assert got == want
    assert 1 <= len(set(glob.glob(local, recursive=True)) - before) < 150  # one per user before


def test_station_files_of_several_files_a_station(spark, tmp, monkeypatch):
    from collections import Counter

    from zonecast.plans import q_sources as Q

    monkeypatch.setattr(Q, "FILE_READINGS", 10)
    rows = [(i, f"2024-01-{1 + i % 3:02d} 10:00:00" if i % 50 else None, i % 4, ("view", "click", "error")[i % 7 % 3], float(i % 120)) for i in range(300)]
    spark.createDataFrame(rows * 2, "event_id bigint, ts string, user_id bigint, event_type string, value double") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp}/events.parquet")
    out = Q.station_files(spark, tmp)
    n, rain, temp = Counter(), Counter(), Counter()
    for _, ts, user, kind, value in rows * 2:
        if ts:
            k = kind, int(ts[8:10])
            n[k], rain[k], temp[k] = n[k] + 1, rain[k] + (value if value <= 100 else 0), temp[k] + user
    assert {(r.station_id, r.day): (r.n, r.rain, r.temp) for r in out.collect()} == {k: (n[k], rain[k], temp[k]) for k in n}
    assert max(Counter(f.split("station=")[1].split("/")[0] for f in _station_files(spark)).values()) > 5


def _station_files(spark):
    import glob
    import os

    from zonecast.session import scratch_path

    last = max(glob.glob(scratch_path(spark, "stations-*").removeprefix("file:")), key=os.path.getmtime)
    return glob.glob(f"{last}/station=*/file=*/*.txt")
