"""Candidates compared, tree attributions, permutation importance in one job."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from zonecast.operators import attribution as A
from zonecast.operators import candidates as CD
from zonecast.operators import ml as ML
from zonecast.operators import model_store as MS


def panel(spark, n=400):
    r = random.Random(21)
    rows = []
    for i in range(n):
        x, y = round(r.random(), 1), r.random()
        rows.append((i, ["train", "val", "test"][i * 3 // n], x, y if i % 17 else None, int(x + .3 * r.random() > .6)))
    return spark.createDataFrame(rows, "id int, split string, x double, y double, label int")


def auc(rows):
    pos, neg = [s for s, l in rows if l], [s for s, l in rows if not l]
    return sum((p > n) + .5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None


def average_precision(rows):
    p = sum(l for _, l in rows)
    out = 0.0
    for t in sorted({s for s, _ in rows}, reverse=True):
        above = [l for s, l in rows if s >= t]
        out += sum(l for s, l in rows if s == t) / p * sum(above) / len(above)
    return out


def test_every_candidate_on_every_split(spark):
    df = panel(spark)
    train = df.where("split = 'train'")
    models = {"x": MS.train_model(train, ["x"], "label", "linear", "x-1", pos_weight=1.0),
              "gbt": MS.train_model(train, ["x", "y"], "label", "gbt", "g-1", {"maxIter": 3, "maxDepth": 2}, calib=df.where("split = 'val'")),
              "same": MS.train_model(train, ["x"], "label", "linear", "x-2", pos_weight=1.0)}
    long = CD.candidate_scores(df, models, ["id", "split", "label"])
    assert long.count() == 3 * df.count()
    rows = [r.asDict() for r in long.collect()]
    ev = {(r["model"], r["split"]): r for r in CD.evaluate_candidates(long, "label", "split", F.col("split") == "val").collect()}
    assert len(ev) == 9
    best = None
    for model in models:
        val = [(r["score"], r["label"]) for r in rows if r["model"] == model and r["split"] == "val"]
        p = sum(l for _, l in val)
        options = []
        for t in sorted({s for s, _ in val}):
            hit = [l for s, l in val if s >= t]
            if sum(hit) / p >= .8:
                options.append((-sum(hit) / len(hit), t))
        threshold = min(options)[1]
        for split in ("train", "val", "test"):
            mine = [(r["score"], r["label"]) for r in rows if r["model"] == model and r["split"] == split]
            e = ev[model, split]
            assert e["threshold"] == threshold
            assert e["tp"] == sum(l for s, l in mine if s >= threshold) and e["fp"] == sum(1 - l for s, l in mine if s >= threshold)
            assert e["auc"] == pytest.approx(auc(mine)) and e["avg_precision"] == pytest.approx(average_precision(mine))
        score = ev[model, "val"]["precision"]
        if best is None or score > best[0]:
            best = score, model
    assert {m for (m, _), e in ev.items() if e["is_best"]} == {best[1]} != {"same"}


def test_single_class_split_has_no_area(spark):
    df = panel(spark)
    models = {"x": MS.train_model(df, ["x"], "label", "linear", "x-1", pos_weight=1.0)}
    odd = df.withColumn("split", F.when(F.col("label") == 1, "ones").otherwise("zeros"))
    ev = {r["split"]: r for r in CD.evaluate_candidates(CD.candidate_scores(odd, models, ["split", "label"]), "label", "split", F.lit(True)).collect()}
    assert ev["ones"]["auc"] is None and ev["zeros"]["auc"] is None and ev["zeros"]["avg_precision"] is None and ev["ones"]["avg_precision"] == pytest.approx(1.0)


@pytest.mark.parametrize("family,params", [("gbt", {"maxIter": 6, "maxDepth": 4}), ("rf", {"maxIter": 7, "maxDepth": 5}), ("gbt", {"maxIter": 2, "maxDepth": 0})])
def test_contributions_and_bias_are_the_margin(spark, family, params):
    df = panel(spark)
    path = tempfile.mkdtemp(prefix="zc-attr-")
    MS.save_model(spark, MS.train_model(df, ["x", "y"], "label", family, "1", params), path)
    m = MS.load_model(spark, path)
    nodes = A.node_table(spark, path, m)
    out = A.contributions(A.margin(m, df), m, nodes).collect()
    assert len(out) == df.count()
    for r in out:
        assert r.bias + sum(r.phi) == pytest.approx(r.margin, abs=1e-9)
    means = {r.feature: r.importance for r in A.mean_abs_attribution(df, m, nodes).collect()}
    assert means["x"] == pytest.approx(sum(abs(r.phi[0]) for r in out) / len(out))
    if params["maxDepth"]:
        assert means["x"] > means["y"]
    by = A.mean_abs_attribution(df, m, nodes, ["split"]).collect()
    assert {(r.split, r.feature) for r in by} == {(s, f) for s in ("train", "val", "test") for f in ("x", "y")}


def test_shuffled_features_are_permutations_in_one_job(spark, monkeypatch):
    df = panel(spark)
    model = ML.fit_classifier(df, ["x", "y"], "label", "gbt", {"maxIter": 3, "maxDepth": 2})
    seen = {}
    inner = ML.predict_scores

    def predict(m, frame, features, name="score"):
        if "_j" in frame.columns:
            seen["rows"] = frame.collect()
            seen["times"] = seen.get("times", 0) + 1
        return inner(m, frame, features, name)

    monkeypatch.setattr(ML, "predict_scores", predict)
    got = {r.feature: r for r in ML.permutation_importance(model, df, ["x", "y"], "label", ["id"]).collect()}
    assert seen["times"] == 1  # all features in one scoring
    rows = df.select("label", "x", "y").collect()
    for j, of in ((-1, None), (0, "x"), (1, "y")):
        mine = [r for r in seen["rows"] if r["_j"] == j]
        for f in ("x", "y"):
            assert sorted(map(str, (r[f] for r in mine))) == sorted(map(str, (r[f] for r in rows)))  # the same values
        pairs = sorted(str((r.label, r.y if of == "x" else r.x)) for r in mine)
        assert pairs == sorted(str((r.label, r.y if of == "x" else r.x)) for r in rows)  # the other feature stays with its row
    assert got["x"].importance > .1 > abs(got["y"].importance)
    assert got["x"].base_auc == got["y"].base_auc
    assert ML.permutation_importance(model, df.limit(0), ["x", "y"], "label", ["id"]).where("importance IS NULL").count() == 2


def test_search_stops_losing_trials_early(spark, monkeypatch):
    from zonecast.operators import split as SP

    df = panel(spark, 300).withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 15).cast("int")))
    folds = SP.time_folds(df, "date", 3)
    fits = []
    inner = ML.fit_classifier

    def fit(frame, features, label, family, params):
        fits.append(params["maxIter"])
        return inner(frame, features, label, family, params)

    monkeypatch.setattr(ML, "fit_classifier", fit)
    space = {"maxIter": ("int", 4, 8), "maxDepth": ("int", 1, 3), "stepSize": ("log", 0.01, 0.3), "subsamplingRate": ("float", 0.6, 1.0),
             "featureSubsetStrategy": ("float", 0.6, 1.0), "minInstancesPerNode": ("int", 1, 10), "pos_weight": ("float", 1.0, 10.0)}
    rungs = ((1 / 4, 1, 1 / 3), (1.0, None, 1.0))
    out = ML.halving_search(df, ["x", "y"], "label", folds, space, 6, "gbt", 1, rungs, parallel=3)
    rows = {r.trial: r for r in out.collect()}
    assert len(rows) == 6 and sorted(r.rung for r in rows.values()) == [0, 0, 0, 0, 1, 1]
    assert len(fits) == 6 + 2 * 3 and max(fits[:6]) <= 2
    best = ML.best_trial(out).first()
    assert best.rung == 1 and best.mean_f2 == max(r.mean_f2 for r in rows.values() if r.rung == 1)
    again = ML.halving_search(df, ["x", "y"], "label", folds, space, 6, "gbt", 1, rungs, parallel=1)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in rows.values()}  # whatever runs at a time
    assert set(ML.REFERENCE_SPACE) == set(space)
