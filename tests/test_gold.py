"""Bronze -> silver -> gold on hand-made frames in the reference's model."""

import datetime as dt

import pytest

from zonecast.operators import gold as GD


def D(s):
    return dt.date.fromisoformat(s)


@pytest.fixture()
def inputs(spark):
    bronze = spark.createDataFrame([
        ("2019-01-01", 1, "Blk 1 ", 1.305, 103.805, 3, 2, 10, "a.csv", "csv"),
        ("2019-01-01", 1, "Blk 1 ", 1.305, 103.805, 3, 2, 10, "b.csv", "csv"),   # duplicate
        ("2019-01-08", 2, "BLK 2", 1.315, 103.815, 1, None, 5, "c.csv", "csv"),
        ("2019-01-15", 3, "x", 1.305, 103.805, 0, 1, 1, "d.csv", "csv"),          # no cases
        ("2019-01-15", 4, "y", 2.0, 103.805, 2, 1, 1, "d.csv", "csv"),            # outside box
        ("2019-01-15", 5, "z", 1.305, 103.815, 2, 4, 4, "e.csv", "incorrect"),    # other folder
        ("2019-01-22", 6, "w", 1.315, 103.805, 2, 4, 4, "f.csv", "csv"),
    ], "date string, cluster_id int, location string, latitude double, longitude double, cases int, "
       "recent_cases int, total_cases int, source_file string, source_folder string")
    weather = spark.createDataFrame(
        [("2019-01-01", "S1", 10.0, 27.0), ("2019-01-01", "S2", 20.0, 28.0), ("2019-01-02", "S1", 400.0, 1.0),
         ("2019-01-06", "S1", 0.0, 1.0), ("2019-01-22", "S1", 5.0, 1.0)],
        "date string, station_id string, rainfall_mm double, temp_mean_c double")
    pop = spark.createDataFrame([("Zone A", "P", 1000, 100, 50), ("zone b!", "P", 500, 10, None),
                                 ("Empty", "P", 0, 0, 0)],
                                "subzone string, planning_area string, total int, age_65_69 int, age_70_74 int")
    sq = lambda x0, y0: [[[x0, y0], [x0 + 0.01, y0], [x0 + 0.01, y0 + 0.01], [x0, y0 + 0.01], [x0, y0]]]
    polys = spark.createDataFrame([("zone a", "p", sq(103.80, 1.30)), ("Zone B", "p", sq(103.81, 1.31)),
                                   ("Pulau Sea", "p", sq(103.9, 1.4))],
                                  "subzone_name string, planning_area string, geometry array<array<array<double>>>")
    return bronze, weather, pop, polys


def test_silver_steps(spark, inputs):
    bronze, weather, pop, polys = inputs
    cl, audit = GD.silver_clusters(bronze)
    a = {r["rule"]: r["n_rows"] for r in audit.collect()}
    assert a == {"kept": 4, "no_cases": 1, "outside_bbox": 1, "folder": 1}
    rows = cl.orderBy("date").collect()
    assert len(rows) == 3 and rows[0]["location"] == "blk 1" and rows[0]["source_file"] == "a.csv"
    w = {r["date"]: r["rainfall_mean_mm"] for r in GD.silver_weather(weather).collect()}
    assert len(w) == 22 and w[D("2019-01-01")] == 15.0 and w[D("2019-01-02")] == 300.0
    assert w[D("2019-01-05")] == 300.0 and w[D("2019-01-06")] == 0.0          # 3-day fill, then valid
    # 01-06 -> 01-22: filled for 3 days, then linear from (01-09, 0) to (01-22, 5)
    assert w[D("2019-01-09")] == 0.0 and w[D("2019-01-10")] == pytest.approx(5.0 / 13)
    assert w[D("2019-01-12")] == pytest.approx(5.0 * 3 / 13)
    p = {r["subzone"]: r for r in GD.silver_population(pop).collect()}
    assert set(p) == {"ZONE A", "ZONE B"} and p["ZONE A"]["elderly_pct"] == 0.15
    assert p["ZONE B"]["elderly_pop"] == 10
    z = GD.silver_subzones(polys).collect()
    assert sorted(r["subzone_name"] for r in z) == ["ZONE A", "ZONE B"]
    assert z[0]["area_km2"] == pytest.approx(1.23, rel=0.02)                  # 0.01 deg square


def test_gold_table(spark, inputs):
    bronze, weather, pop, polys = inputs
    cl, _ = GD.silver_clusters(bronze)
    gold, weights = GD.gold_features(cl, GD.silver_weather(weather), GD.silver_population(pop),
                                     GD.silver_subzones(polys))
    assert tuple(gold.columns) == GD.GOLD_COLUMNS
    rows = {(r["date"], r["subzone_name"]): r for r in gold.collect()}
    assert len(rows) == 3 * 2                                                   # 3 snapshot dates x 2 zones
    a1 = rows[(D("2019-01-01"), "ZONE A")]
    assert a1["active_cluster_overlap"] == 1 and a1["label"] == 0               # next hit in A is 01-22 (21 d)
    b1 = rows[(D("2019-01-01"), "ZONE B")]
    assert b1["active_cluster_overlap"] == 0 and b1["label"] == 1               # B hit on 01-08
    assert rows[(D("2019-01-22"), "ZONE A")]["label"] == 0                      # last snapshot
    assert a1["rainfall_lag1w"] == 15.0 and a1["cluster_count_rolling2w"] == 1.0
    assert weights["weights"] == {"elderly_pct": 0.5, "population_density": 0.5} or weights["n_rows"] == 0
    assert a1["population"] == 1000 and a1["cluster_proximity"] == 0


def test_gold_proximity_count(spark, inputs):
    bronze, weather, pop, polys = inputs
    cl, _ = GD.silver_clusters(bronze)
    gold, _ = GD.gold_features(cl, GD.silver_weather(weather), GD.silver_population(pop),
                               GD.silver_subzones(polys), proximity=True)
    rows = {(r["date"], r["subzone_name"]): r["cluster_proximity_2km"] for r in gold.collect()}
    # 01-01: one point at the centre of zone A (B's centre is ~1.6 km away diagonally)
    assert rows[(D("2019-01-01"), "ZONE A")] == 1 and rows[(D("2019-01-01"), "ZONE B")] == 1
    # 01-22: the point (1.315, 103.805) is 1.1 km from both centres
    assert rows[(D("2019-01-22"), "ZONE A")] == 1
    assert gold.columns[-1] == "cluster_proximity_2km"
