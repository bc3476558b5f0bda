"""Hand-made frames for the behaviours a name or docstring hides
(FIXTURES Part C), plus formula checks against published report numbers."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from zonecast.functions import columns as C
from zonecast.operators import clean as CL
from zonecast.operators import drift as D
from zonecast.operators import index as IX
from zonecast.operators import metrics as M
from zonecast.operators import ordering as O
from zonecast.operators import panel as P
from zonecast.operators import series as S
from zonecast.operators import spatial as G
from zonecast.operators import split as SP


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


# 1. rolls with nulls, fewer rows than the window
def test_rolling_mean_skips_nulls_and_min_periods_1(spark):
    df = spark.createDataFrame([(day(0), 1.0), (day(1), None), (day(2), 3.0), (day(3), 5.0)],
                               "date date, v double")
    out = P.rolling_mean_rows(df, "date", "v", {"m3": 3}).orderBy("date").collect()
    assert [r["m3"] for r in out] == [1.0, 1.0, 2.0, 4.0]
    lg = P.rolling_mean_rows(df, "date", "v", {"m2": 2}, log1p=True).orderBy("date").collect()
    assert lg[3]["m2"] == pytest.approx(math.log1p(4.0))


# 2. forward label: gaps of 14 and 15 days, last snapshot
def test_forward_label_window(spark):
    rows = [("z", day(0), 0), ("z", day(14), 1), ("z", day(29), 1), ("y", day(0), 0), ("y", day(15), 1)]
    df = spark.createDataFrame(rows, "zone string, date date, f int")
    got = {(r["zone"], r["date"]): r["label"]
           for r in P.forward_label(df, "zone", "date", "f", 14).collect()}
    assert got[("z", day(0))] == 1      # 14 days ahead is inside (T, T+14]
    assert got[("z", day(14))] == 0     # 15 days ahead is outside
    assert got[("z", day(29))] == 0     # last snapshot: 0, not null
    assert got[("y", day(0))] == 0


# 3. ffill limit 3 + interpolation (W4, W5); values from pandas
def test_interpolate_matches_pandas_example(spark):
    vals = [None, 1.0, None, None, None, None, None, 6.0, None]
    df = spark.createDataFrame([(day(i), v) for i, v in enumerate(vals)], "date date, v double")
    out = S.interpolate(df, "date", "v", 3).orderBy("date").collect()
    got = [None if r["v"] is None else round(r["v"], 3) for r in out]
    assert got == [None, 1.0, 1.0, 1.0, 1.0, 2.667, 4.333, 6.0, 6.0]
    ff = S.ffill_limit(df, "date", "v", 3, out="f").orderBy("date").collect()
    assert [r["f"] for r in ff] == [None, 1.0, 1.0, 1.0, 1.0, None, None, 6.0, 6.0]


def test_fill_calendar_per_key(spark):
    df = spark.createDataFrame([("a", day(0), 1.0), ("a", day(3), 2.0), ("b", day(1), 5.0)],
                               "k string, date date, v double")
    out = S.fill_calendar(df, "date", ["k"])
    assert out.where("k = 'a'").count() == 4 and out.where("k = 'b'").count() == 1


# 4. latest row with a null column (A5): last non-null per column
def test_latest_nonnull_per_column(spark):
    df = spark.createDataFrame([(1, day(0), 10.0, "x"), (1, day(1), None, "y")],
                               "k int, date date, a double, b string")
    r = P.latest_nonnull(df, "k", "date", ["a", "b"]).first()
    assert r["a"] == 10.0 and r["b"] == "y"


# 5. ties, one class, empty bins, min = max
def test_auc_with_ties_and_single_class(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.9, 1), (0.1, 0)], "s double, y int")
    auc = M.roc_auc(df, "s", "y").first()["auc"]
    assert auc == pytest.approx(0.875)           # sklearn roc_auc_score gives 0.875
    ap = M.average_precision(df, "s", "y").first()["avg_precision"]
    assert ap == pytest.approx(0.5 * 1.0 + 0.5 * (2 / 3))
    one = spark.createDataFrame([(0.3, 1), (0.7, 1)], "s double, y int")
    assert M.roc_auc(one, "s", "y").first()["auc"] is None


def test_pick_threshold_prefers_lowest_threshold_on_ties(spark):
    curve = spark.createDataFrame([(0.2, 0.5, 1.0), (0.4, 0.5, 0.9), (0.6, 0.9, 0.5)],
                                  "threshold double, precision double, recall double")
    r = M.pick_threshold(curve, 0.8).first()
    assert r["threshold"] == 0.2 and r["meets_target"]
    r2 = M.pick_threshold(curve, 0.95).first()   # only 0.2 reaches 0.95? no: recall 1.0 >= 0.95
    assert r2["threshold"] == 0.2
    r3 = M.pick_threshold(curve.where("recall < 0.95"), 0.95).first()
    assert r3["threshold"] == 0.4 and not r3["meets_target"]


def test_histogram_numpy_edges_and_top_edge(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (1.0,), (1.5,), (0.29999999999999999,)], "x double")
    h = {r["bin"]: r["count"] for r in M.histogram(df, "x", 0.0, 1.0, 10).collect()}
    # numpy: edge 3 is 0.30000000000000004, so 0.3 falls in bin 2; 1.0 in the last bin; 1.5 dropped
    assert h[2] == 2 and h[9] == 1 and h[0] == 1 and sum(h.values()) == 4


def test_psi_empty_bins_and_equal_sets(spark):
    a = spark.createDataFrame([(0.05,), (0.15,), (0.95,)], "score double")
    r = D.psi(a, a, "score").first()
    assert r["psi"] == 0.0 and r["flag"] == "stable"
    b = spark.createDataFrame([(0.05,), (0.05,), (0.05,)], "score double")
    p = D.psi(a, b, "score").first()["psi"]
    e = [1 / 3, 1 / 3, 1 / 3]
    act = [1.0, 1e-4, 1e-4]
    ref = sum((x - y) * math.log(x / y) for x, y in zip(act, e))
    assert p == pytest.approx(round(ref, 4))
    same = spark.createDataFrame([(2.0,)] * 12, "score double")
    assert D.psi(same, same, "score", bounds=None).first()["psi"] == 0.0


# 6. point on vertex, on edge, in hole, outside; concave ring
def test_point_in_polygon_edges_holes_concave(spark):
    square_hole = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]],
                   [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 2.0], [1.0, 1.0]]]
    concave = [[[10.0, 0.0], [14.0, 0.0], [14.0, 1.0], [11.0, 1.0], [11.0, 4.0], [10.0, 4.0],
                [10.0, 0.0]]]
    polys = spark.createDataFrame([(1, square_hole), (2, concave)],
                                  "zid int, geometry array<array<array<double>>>")
    pts = spark.createDataFrame([
        ("inside", 3.0, 3.0), ("vertex", 0.0, 0.0), ("edge", 4.0, 2.0), ("hole", 1.5, 1.5),
        ("outside", 5.0, 5.0), ("notch", 12.0, 2.0), ("arm", 10.5, 3.0), ("foot", 13.0, 0.5)],
        "name string, x double, y double")
    got = {(r["name"], r["zid"]) for r in G.points_in_polygons(pts, polys, "x", "y", "geometry", 1.0)
           .select("name", "zid").collect()}
    assert got == {("inside", 1), ("arm", 2), ("foot", 2)}


def test_area_centroid_and_screen(spark):
    sq = [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]],
          [[0.5, 0.5], [1.0, 0.5], [1.0, 1.0], [0.5, 1.0], [0.5, 0.5]]]
    bad = [[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]]
    df = spark.createDataFrame([(1, sq), (2, bad)], "id int, geometry array<array<array<double>>>")
    r = df.select(G.polygon_area(F.col("geometry")).alias("a"),
                  G.polygon_centroid(F.col("geometry")).alias("c")).first()
    assert r["a"] == pytest.approx(4.0 - 0.25)
    assert r["c"]["x"] == pytest.approx(1.0) and r["c"]["y"] == pytest.approx(1.0)
    v = {x["id"]: x["valid"] for x in G.screen_polygons(df).collect()}
    assert v == {1: True, 2: False}


def test_svy21_origin_maps_to_false_offsets(spark):
    df = spark.createDataFrame([(G.SVY21["lat0"], G.SVY21["lon0"])], "lat double, lon double")
    n, e = G.svy21(F.col("lat"), F.col("lon"))
    r = df.select(n.alias("n"), e.alias("e")).first()
    assert r["n"] == pytest.approx(G.SVY21["false_n"], abs=1e-3)
    assert r["e"] == pytest.approx(G.SVY21["false_e"], abs=1e-3)
    # 0.01 degree north of the origin is about 1.1 km
    df2 = spark.createDataFrame([(G.SVY21["lat0"] + 0.01, G.SVY21["lon0"])], "lat double, lon double")
    n2, _ = G.svy21(F.col("lat"), F.col("lon"))
    assert df2.select(n2).first()[0] - G.SVY21["false_n"] == pytest.approx(1105.8, abs=2.0)


def test_near_count_blocking_matches_brute_force(spark):
    import random
    rnd = random.Random(3)
    pts = [(rnd.uniform(0, 1), rnd.uniform(0, 1)) for _ in range(400)]
    cen = [(i, rnd.uniform(0, 1), rnd.uniform(0, 1)) for i in range(7)]
    p = spark.createDataFrame(pts, "x double, y double")
    c = spark.createDataFrame(cen, "k int, cx double, cy double")
    got = {r["k"]: r["n_near"] for r in G.near_count(p, c, "x", "y", "cx", "cy", "k", 0.1).collect()}
    want = {k: sum((x - cx) ** 2 + (y - cy) ** 2 <= 0.01 for x, y in pts) for k, cx, cy in cen}
    assert got == want


# 8. null under a clip (P11); constant feature
def test_clip_keeps_null_and_constant_feature_corr(spark):
    df = spark.createDataFrame([(None, 1.0, 1), (500.0, 1.0, 0), (10.0, 1.0, 1)],
                               "x double, c double, y int")
    vals = [r[0] for r in df.select(C.clip_upper("x", 300)).collect()]
    assert vals == [None, 300.0, 10.0]
    r = {x["feature"]: x["r"] for x in M.label_correlation(df.fillna(0), ["x", "c"], "y").collect()}
    assert r["c"] == 0.0


# 9. date_raw: leading zero lost, 0, letters
def test_parse_yymmdd(spark):
    df = spark.createDataFrame([("150703",), ("50703",), ("0",), ("abc",), ("151340",)], "d string")
    got = [r[0] for r in df.select(C.parse_yymmdd("d")).collect()]
    assert got == [dt.date(2015, 7, 3), dt.date(2005, 7, 3), None, None, None]


def test_canonical_and_keywords(spark):
    df = spark.createDataFrame([("  Ang Mo-Kio (Central)!  ",), (None,), ("Pasir Port",)], "n string")
    got = [r[0] for r in df.select(C.canonical("n")).collect()]
    assert got == ["ANG MO-KIO CENTRAL", None, "PASIR PORT"]
    keep = [r[0] for r in df.select(CL.excludes_keywords(F.upper("n"))).collect()]
    assert keep == [True, True, False]


def test_dedup_first_and_rules_audit(spark):
    df = spark.createDataFrame([(3, "a", 1.0), (1, "a", 2.0), (2, None, 3.0), (4, None, 4.0)],
                               "id int, k string, v double")
    kept = {r["k"]: r["id"] for r in CL.dedup_first(df, ["k"], ["id"]).collect()}
    assert kept == {"a": 1, None: 2}
    _, audit = CL.clean_rules(df, [("has_key", F.col("k").isNotNull()), ("small", F.col("v") < 2)])
    a = {r["rule"]: r["n_rows"] for r in audit.collect()}
    assert a == {"has_key": 2, "small": 1, "kept": 1}


# formula checks from the published evaluation report
def test_metric_formulas_against_report(spark):
    rows = [(1.0, 1)] * 1899 + [(1.0, 0)] * 2251 + [(0.0, 0)] * 2596 + [(0.0, 1)] * 104
    df = spark.createDataFrame(rows, "s double, y int")
    r = M.binary_metrics(df, "s", "y", 0.5).first()
    assert (r["tp"], r["fp"], r["tn"], r["fn"]) == (1899, 2251, 2596, 104)
    assert r["recall"] == 0.9481 and r["precision"] == 0.4576 and r["f1"] == 0.6173


def test_single_class_confusion_is_zero(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1)], "s double, y int")
    r = M.binary_metrics(df, "s", "y", 0.5).first()
    assert (r["tp"], r["fp"], r["tn"], r["fn"]) == (0, 0, 0, 0)


def test_sweep_no_positive_predictions(spark):
    df = spark.createDataFrame([(0.005, 1), (0.5, 0), (0.995, 1)], "s double, y int")
    out = {r["i"]: r for r in M.sweep(df, "s", "y").collect()}
    assert len(out) == 200
    assert out[0]["precision"] == pytest.approx(0.5) and out[0]["recall"] == pytest.approx(0.5)
    assert out[199]["precision"] == 1.0 and out[199]["recall"] == pytest.approx(0.5)


def test_pca_weights_two_inputs_are_equal(spark):
    import random
    rnd = random.Random(1)
    rows = [(x, 2 * x + rnd.gauss(0, 1)) for x in [rnd.gauss(0, 1) for _ in range(50)]]
    df = spark.createDataFrame(rows, "a double, b double")
    res = IX.pca_weights(df, ["a", "b"])
    assert res["weights"] == {"a": 0.5, "b": 0.5}
    r = df.select(F.corr("a", "b")).first()[0]
    assert res["pc1_share_pct"] == pytest.approx(round((1 + abs(r)) / 2 * 100, 1), abs=0.11)
    few = IX.pca_weights(df.limit(5), ["a", "b"])
    assert few["method"] == "fallback equal weights"


def test_global_rank_and_prefix_sums(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 7).alias("s"))
    r = O.ranked(df, "s", "id").orderBy("rank").collect()
    assert [x["rank"] for x in r] == list(range(1, 1001))
    assert r[0]["s"] == 6 and r[0]["id"] == 6
    ps = O.prefix_sums(df.withColumn("one", F.lit(1)), [F.col("id")], ["one"])
    assert all(x["one_cum"] == x["id"] + 1 for x in ps.collect())


def test_splits_overlap_and_folds(spark):
    df = spark.createDataFrame([(dt.date(2019, 2, 1),), (dt.date(2019, 5, 1),), (dt.date(2018, 1, 1),)],
                               "date date")
    tags = sorted((r["date"].month, r["split"]) for r in SP.assign_splits(df, "date").collect())
    assert (2, "val") in tags and (2, "val_calib") in tags and (5, "val_thresh") in tags
    days = spark.createDataFrame([(day(i),) for i in range(13)], "date date")
    f = SP.fold_summary(SP.time_folds(days, "date", 5), "date")
    got = {(r["fold"], r["role"]): r["n_dates"] for r in f.collect()}
    # 13 dates -> fold size 2: fold i trains on 2i dates, validates on 2
    assert got[(1, "train")] == 2 and got[(5, "train")] == 10 and got[(5, "val")] == 2


def test_attribution_drift_alarms(spark):
    b = spark.createDataFrame([("f1", 0.5, 1), ("f2", 0.3, 2), ("f3", 0.1, 3)],
                              "feature string, importance double, pos int")
    c = spark.createDataFrame([("f1", 0.1, 1), ("f2", 0.3, 2), ("f3", 0.6, 3)],
                              "feature string, importance double, pos int")
    det = D.attribution_drift(b, c, "feature", "importance", "pos")
    s = D.attribution_summary(det).first()
    assert s["top_feature_baseline"] == "f1" and s["top_feature_current"] == "f3"
    assert s["top_feature_changed"] and not s["all_ok"]


def test_tier_alert_and_agreement(spark):
    df = spark.createDataFrame([(0.6, 1.0, 1), (0.3, 0.5, 0), (0.29, 1.0, 100)],
                               "s double, v double, n int")
    r = df.select(C.tier("s").alias("t"), C.alert_score("s", "v", "n").alias("a"),
                  C.agree("s", "v").alias("g")).collect()
    assert [x["t"] for x in r] == ["High", "Medium", "Low"]
    assert r[0]["a"] == round(0.6 * 1.0 * math.log(2), 4)
    assert [x["g"] for x in r] == [True, True, False]   # both below 0.6 agree


def test_projection_helpers(spark):
    df = spark.createDataFrame([(10, 2, None, 1.0, 5.0), (0, 1, 1, None, 2.0)],
                               "total int, age_65_69 int, age_70_74 int, temp_mean double, wind double")
    sh = CL.share(df, ["age_65_69", "age_70_74", "age_90_over"], "total", "elderly_pop", "elderly_pct")
    r = sh.orderBy(F.desc("total")).collect()
    assert r[0]["elderly_pop"] == 2 and r[0]["elderly_pct"] == 0.2
    assert r[1]["elderly_pct"] is None                       # zero total -> null, not an error
    assert CL.drop_matching(df, ["temp", "wind"]).columns == ["total", "age_65_69", "age_70_74"]
    assert CL.fill_zero(df, ["age_70_74"]).where("age_70_74 IS NULL").count() == 0
    assert CL.project(df, {"t": "total", "w2": F.col("wind") * 2}).columns == ["t", "w2"]


def test_defaults_override_and_dedup_keep_last(spark):
    from zonecast.operators import joins as J
    from zonecast.operators import serving as SV
    base = spark.createDataFrame([("a", None, 0.0), ("b", 3, None)], "k string, case_count int, vulnerability_index double")
    d = {r["k"]: r for r in SV.with_defaults(base, SV.ONLINE_DEFAULTS).collect()}
    assert d["a"]["case_count"] == 1 and d["a"]["vulnerability_index"] == 0.0   # stored 0 stays 0
    assert d["b"]["vulnerability_index"] == 0.5
    fresh = spark.createDataFrame([("b", 0.9)], "k string, vulnerability_index double")
    o = {r["k"]: r["vulnerability_index"] for r in SV.override(base, fresh, "k", "vulnerability_index").collect()}
    assert o == {"a": 0.0, "b": 0.9}
    a = spark.createDataFrame([(" S1 ", "Old"), ("S2", "Two")], "id string, name string")
    b = spark.createDataFrame([("S1", " New ")], "id string, name string")
    u = {r["id"]: r["name"] for r in J.union_latest(a, b, "id", "name").collect()}
    assert u == {"S1": "New", "S2": "Two"}


def test_fill_series_generator_matches_interpolate(spark):
    df = spark.createDataFrame([("a", day(1), 1.0), ("a", day(7), 6.0), ("b", day(0), 2.0)],
                               "k string, date date, v double")
    out = S.fill_series(df, "date", "v", ["k"], 3, "raw", "f").orderBy("k", "date").collect()
    a = [round(r["f"], 3) for r in out if r["k"] == "a"]
    assert a == [1.0, 1.0, 1.0, 1.0, 2.667, 4.333, 6.0]
    assert [r["raw"] for r in out if r["k"] == "a"][:2] == [1.0, None]
    assert [(r["date"], r["f"]) for r in out if r["k"] == "b"] == [(day(0), 2.0)]


def test_hot_score_is_split_across_range_partitions(spark):
    # a third of all rows share one score: ranking must not put them in one task
    n = 3000
    df = spark.range(0, n).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0.5))
                                  .otherwise(F.col("id") / n).alias("s"))
    parts = df.repartitionByRange(8, F.col("s").desc(), F.col("id")) \
        .groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in parts) < n / 4
    r = O.ranked(df, "s", "id")
    got = [x["id"] for x in r.orderBy("rank").collect()]
    want = [i for i, _ in sorted(((i, (0.5 if i % 3 == 0 else i / n)) for i in range(n)),
                                 key=lambda t: (-t[1], t[0]))]
    assert got == want


def test_cluster_conf_sizes_from_volume():
    from zonecast.session import cluster_conf
    big = cluster_conf(100 * 10 ** 12, cores=8000)
    n = int(big["spark.sql.shuffle.partitions"])
    assert 150_000 < n < 250_000                 # ~25 TB shuffled / 128 MB
    small = cluster_conf(10 ** 6, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_auto_cell_from_polygon_sizes(spark):
    sq = lambda x0, s: [[[x0, 0.0], [x0 + s, 0.0], [x0 + s, s], [x0, s], [x0, 0.0]]]
    polys = spark.createDataFrame([(1, sq(0.0, 1.0)), (2, sq(5.0, 2.0)), (3, sq(9.0, 1.0))],
                                  "zid int, geometry array<array<array<double>>>")
    assert G.auto_cell(polys) == 1.0
    pts = spark.createDataFrame([(0.5, 0.5), (6.0, 1.0), (9.5, 0.5), (20.0, 0.5)], "x double, y double")
    got = sorted(r["zid"] for r in G.points_in_polygons(pts, polys, "x", "y").collect())
    assert got == [1, 2, 3]


def test_drift_alarm_row_and_describe(spark):
    import json as _json
    from zonecast.operators import quality as Q
    psi = spark.createDataFrame([(0.31, "significant_drift")], "psi double, flag string")
    csi = spark.createDataFrame([("b", 0.5, "significant_drift"), ("a", 0.05, "stable")],
                                "feature string, csi double, flag string")
    r = D.drift_alarm(psi, csi).first()
    assert _json.loads(r["csi_json"]) == {"a": {"csi": 0.05, "flag": "stable"},
                                          "b": {"csi": 0.5, "flag": "significant_drift"}}
    assert r["psi_flag"] == "significant_drift"
    d = {x["summary"]: x["v"] for x in Q.describe(spark.createDataFrame([(1.0,), (3.0,)], "v double"), ["v"]).collect()}
    assert d["count"] == "2" and float(d["mean"]) == 2.0


def test_overlap_and_label_single_pass(spark):
    spine = spark.createDataFrame([(day(0), "z", 1.5), (day(7), "z", 2.5), (day(14), "z", 3.5),
                                   (day(0), "y", 0.0)], "date date, zone string, feat double")
    hits = spark.createDataFrame([(day(7), "z"), (day(7), "z"), (day(3), "q")], "date date, zone string")
    out = {(r["zone"], r["date"]): (r["feat"], r["active_cluster_overlap"], r["label"])
           for r in P.overlap_and_label(spine, hits, "zone").collect()}
    assert out == {("z", day(0)): (1.5, 0, 1), ("z", day(7)): (2.5, 1, 0), ("z", day(14)): (3.5, 0, 0),
                   ("y", day(0)): (0.0, 0, 0)}


def test_date_and_text_coercions(spark):
    from zonecast.operators import reshape as RS
    from zonecast.sources import readers as RD
    df = spark.createDataFrame([("2019", "2", "29", "2019-03-01", None), ("2020", "2", "29", "bad", 5),
                                ("x", "1", "1", None, 7)], "y string, m string, d string, s string, n int")
    r = df.select(C.ymd_date("y", "m", "d").alias("ymd"), C.to_date_or_null("s").alias("dt"),
                  C.text("n").alias("t")).collect()
    assert [x["ymd"] for x in r] == [None, dt.date(2020, 2, 29), None]      # 2019-02-29 is not a date
    assert [x["dt"] for x in r] == [dt.date(2019, 3, 1), None, None]
    assert [x["t"] for x in r] == [None, "5", "7"]                           # null stays null, not 'nan'
    m = df.select(RS.literal_map({"S24": "Changi"})[F.lit("S24")].alias("v")).first()["v"]
    assert m == "Changi"
    hdr = spark.createDataFrame([(1, 2)], "` Year ` int, `Day  ` int")
    assert RD.clean_header(hdr, {"Year": "year"}).columns == ["year", "Day"]


def test_keep_last_and_inner_by(spark):
    from zonecast.operators import joins as J
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, t int, v string")
    last = {r["k"]: r["v"] for r in J.keep_last(df, ["k"], F.col("t")).collect()}
    assert last == {"a": "y", "b": "z"}
    other = spark.createDataFrame([("a", 10)], "k string, w int")
    assert J.inner_by(df, other, "k").count() == 2
