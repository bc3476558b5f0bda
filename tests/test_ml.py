"""Spark ML operators on synthetic frames with known answers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from zonecast.operators import ml as ML
from zonecast.operators import split as SP
from zonecast.plans import q_ml


def test_platt_recovers_a_known_sigmoid(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(4000):
        s = rnd.random()
        p = 1 / (1 + math.exp(-(6 * s - 3)))
        rows.append((s, 1 if rnd.random() < p else 0))
    df = spark.createDataFrame(rows, "score double, label int")
    ab = ML.calibrate(df, "score", "label").first()
    # Platt parametrisation p = 1 / (1 + exp(a s + b)): a ~ -6, b ~ 3
    assert ab["a"] == pytest.approx(-6, abs=0.8) and ab["b"] == pytest.approx(3, abs=0.5)
    cal = ML.apply_calibration(df, "score", spark.createDataFrame([ab]))
    lo, hi = cal.agg(F.min("score_cal"), F.max("score_cal")).first()
    assert 0 < lo < 0.1 and 0.9 < hi < 1


def test_weighted_gbt_search_and_importance(spark):
    rnd = random.Random(3)
    rows = [(i // 20, rnd.random(), rnd.random()) for i in range(600)]
    df = spark.createDataFrame(rows, "d int, x double, noise double") \
        .withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d"))) \
        .withColumn("label", (F.col("x") > 0.7).cast("int"))
    model = ML.fit_classifier(df, ["x", "noise"], "label", "gbt", {"maxIter": 5, "maxDepth": 2})
    scored = ML.predict_scores(model, df, ["x", "noise"])
    assert scored.where("(score >= 0.5) != (label = 1)").count() < 30
    imp = {r["feature"]: r["importance"] for r in
           ML.permutation_importance(model, df, ["x", "noise"], "label", ["d", "x"]).collect()}
    assert imp["x"] > 0.2 and abs(imp["noise"]) < 0.05
    folds = SP.time_folds(df, "date", 3)
    res = ML.search_params(df, ["x", "noise"], "label", folds,
                           {"maxIter": ("int", 2, 4), "maxDepth": ("int", 1, 3), "pos_weight": ("float", 1.0, 3.0)},
                           2, "gbt")
    assert res.count() == 2 and res.where("mean_f2 > 0.5").count() >= 1
    assert ML.draw_params({"a": ("int", 1, 3)}, 3, 1) == ML.draw_params({"a": ("int", 1, 3)}, 3, 1)


def test_promotion_gate_reads_a_later_slice_and_computed_importances(spark, monkeypatch):
    ev = [("calib", 0.9, 0.9), ("test", 0.9, 0.9), ("oot", 0.5, 0.6)]
    monkeypatch.setattr(q_ml, "model_eval", lambda *_: spark.createDataFrame(ev, "split string, recall double, auc double"))
    imp = [("a", None), ("b", None)]
    monkeypatch.setattr(q_ml, "perm_importance", lambda *_: spark.createDataFrame(imp, "feature string, importance double"))
    r = q_ml.promotion_gate(spark, "").first()
    assert r["recall_oot"] == 0.5 and not r["oot_drop_pass"] and not r["importance_pass"] and not r["promote"]
    days = [(f"2024-01-{d:02d}",) for d in range(1, 31)]
    monkeypatch.setattr(q_ml, "risk_panel", lambda *_: spark.createDataFrame(days, "date string").withColumn("date", F.to_date("date")))
    spans = {x.split: (str(x.lo), str(x.hi)) for x in q_ml.model_table(spark, "").groupBy("split").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect()}
    assert spans["calib"] < spans["test"] < spans["oot"]


def test_search_reads_pinned_folds(spark, monkeypatch):
    df = spark.range(120).select(F.expr("date_add(date '2024-01-01', cast(id % 12 as int))").alias("date"),
                                 (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 > 3).cast("int").alias("label"))
    plans, fit = [], ML.fit_classifier

    def seen(train, *rest):
        plans.append(train._jdf.queryExecution().optimizedPlan().toString())
        return fit(train, *rest)

    monkeypatch.setattr(ML, "fit_classifier", seen)
    res = ML.search_params(df, ["x"], "label", SP.time_folds(df, "date", 2), {"maxIter": ("int", 2, 3)}, 2, "gbt")
    assert res.count() == 2 and len(plans) == 4
    assert not any("Generate" in p or "Join" in p or "Range" in p for p in plans)  # no fit works the folds out again
