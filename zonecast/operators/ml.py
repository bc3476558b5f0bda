"""Modelling on Spark ML.

* ``fit_classifier``: boosted trees (``GBTClassifier``) or a random forest
  with a positive-class weight column (the reference's ``scale_pos_weight``).
* ``calibrate``: Platt scaling as a logistic regression on the score, fitted
  on a held-out slice with Platt's smoothed targets (each row twice, label 1
  with weight t and label 0 with weight 1 - t).
* ``permutation_importance``: drop in AUC when one feature column is
  shuffled -- donors are rows shifted along one seeded random order
  (``ordering.global_index``), all features in one job.
* ``search_params``: seeded random search; every (trial, fold) is a Spark ML
  fit on the fold's rows; the objective is mean F2 at 0.5 over folds.

Training data is the gold panel, one row per (zone, date): the fits are
distributed by Spark ML; only model parameters come back to the driver.
"""

from __future__ import annotations

import math
import random
from typing import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import metrics as M
from ..session import cut_lineage
from .ordering import best_row, global_index

# Fixed: the reference's search space (GBM libraries); Spark parameter names
# in brackets.  n_estimators [maxIter] 100-500, max_depth [maxDepth] 3-8,
# learning_rate [stepSize] 0.01-0.3 log, subsample [subsamplingRate] 0.6-1.0,
# colsample [featureSubsetStrategy] 0.6-1.0, min_child_weight
# [minInstancesPerNode] 1-10, scale_pos_weight 1-10.
REFERENCE_SPACE = {
    "maxIter": ("int", 100, 500), "maxDepth": ("int", 3, 8),
    "stepSize": ("log", 0.01, 0.3), "subsamplingRate": ("float", 0.6, 1.0),
    "featureSubsetStrategy": ("float", 0.6, 1.0), "minInstancesPerNode": ("int", 1, 10),
    "pos_weight": ("float", 1.0, 10.0),
}
F2_BETA = 2.0


def with_weight(df: DataFrame, label: str, pos_weight: float | None,
                name: str = "_weight") -> DataFrame:
    """Weight column: ``pos_weight`` for positives, 1 otherwise; default
    pos_weight = negatives / positives (computed in one aggregate)."""
    if pos_weight is None:
        r = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n")).first()
        # a single-class slice keeps unit weights (n / p would be 0 or undefined)
        pos_weight = (r["n"] / r["p"]) if r["p"] and r["n"] else 1.0
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)))


def _estimator(family: str, label: str, params: Mapping | None):
    p = dict(params or {})
    p.pop("pos_weight", None)
    if "featureSubsetStrategy" in p and not isinstance(p["featureSubsetStrategy"], str):
        p["featureSubsetStrategy"] = f"{float(p['featureSubsetStrategy']):.3f}"
    common = dict(featuresCol="_features", labelCol=label, weightCol="_weight", seed=42)
    if family == "gbt":
        return GBTClassifier(**common, **p)
    if family == "rf":
        p.pop("stepSize", None)
        if "maxIter" in p:
            p["numTrees"] = p.pop("maxIter")
        # bootstrap draws can leave a child with zero total weight, whose
        # probability vector cannot be normalised; require a minimum weight
        p.setdefault("minWeightFractionPerNode", 0.001)
        return RandomForestClassifier(**common, **p)
    if family == "linear":
        # linear probability model in closed form (normal equations)
        return LinearRegression(featuresCol="_features", labelCol=label, weightCol="_weight",
                                solver="normal", regParam=0.0, **p)
    raise ValueError(family)


def fit_classifier(df: DataFrame, features: Sequence[str], label: str, family: str = "gbt",
                   params: Mapping | None = None, pos_weight: float | None = None) -> PipelineModel:
    """Fit assembler + classifier with class weights (M1).  Null features are
    filled with 0 (as the reference does before scoring)."""
    pw = (params or {}).get("pos_weight", pos_weight)
    train = with_weight(df.fillna(0, subset=list(features)), label, pw)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_features"),
                            _estimator(family, label, params)])
    return pipe.fit(train)


def predict_scores(model: PipelineModel, df: DataFrame, features: Sequence[str],
                   name: str = "score") -> DataFrame:
    """Positive-class probability as a double column; a linear model's
    prediction clipped to [0, 1].  Works on streaming frames alike."""
    out = model.transform(df.fillna(0, subset=list(features)))
    score = vector_to_array("probability")[1] if "probability" in out.columns \
        else F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction")))
    return out.select(*df.columns, score.alias(name))


def calibrate(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Platt sigmoid calibration fitted on ``scored`` (M3).  Returns a
    one-row frame (a, b) with p = 1 / (1 + exp(a * s + b)) -- Platt's
    parametrisation."""
    r = scored.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n")).first()
    t_pos = (r["p"] + 1.0) / (r["p"] + 2.0)
    t_neg = 1.0 / (r["n"] + 2.0)
    t = F.when(F.col(label) == 1, F.lit(t_pos)).otherwise(F.lit(t_neg))
    twice = scored.select(F.col(score).alias("_s"), t.alias("_t")) \
        .withColumn("_y", F.explode(F.array(F.lit(1.0), F.lit(0.0)))) \
        .withColumn("_weight", F.when(F.col("_y") == 1.0, F.col("_t")).otherwise(1 - F.col("_t")))
    data = VectorAssembler(inputCols=["_s"], outputCol="_f").transform(twice)
    lr = LogisticRegression(featuresCol="_f", labelCol="_y", weightCol="_weight", regParam=0.0,
                            standardization=False, maxIter=100).fit(data)
    a = -float(lr.coefficients[0])
    b = -float(lr.intercept)
    return scored.sparkSession.range(1).select(F.lit(a).alias("a"), F.lit(b).alias("b"))


def apply_calibration(scored: DataFrame, score: str, ab: DataFrame,
                      name: str = "score_cal") -> DataFrame:
    r = ab.first()
    z = F.lit(r["a"]) * F.col(score) + F.lit(r["b"])
    return scored.withColumn(name, 1 / (1 + F.exp(z)))


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str],
                           label: str, key: Sequence[str], seed: int = 42) -> DataFrame:
    """AUC drop per feature when that column is shuffled across rows (M7, a
    model-agnostic companion of the trees' own attributions).

    Rows get one index in a seeded hash order.  Feature j's donor is the row
    some places further on, another distance for every feature, so each
    feature's values are permuted.  Rows send their values to the places that
    need them (one shuffle for all features), every row is scored once as it is
    and once per feature, and one grouped curve gives all areas."""
    cols = [f"_x{i}" for i in range(len(features))]
    rows = df.select(F.xxhash64(*key, F.lit(seed)).alias("_h"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)],
                     F.col(label).alias("_label"), *[F.col(f).cast("double").alias(c) for f, c in zip(features, cols)])
    indexed = global_index(rows, [F.col("_h"), *[F.col(f"_k{i}") for i in range(len(key))]], "_pos")
    n = max(1, indexed.count())
    own = F.struct(F.col("_pos").alias("at"), F.lit(-1).alias("j"), F.struct("_label", *cols).alias("row"), F.lit(None).cast("double").alias("value"))
    given = [F.struct(F.pmod(F.col("_pos") - F.lit((i + 1) * n // (len(cols) + 1)), F.lit(n)).alias("at"), F.lit(i).alias("j"),
                      F.lit(None).cast(rows.select(F.struct("_label", *cols)).schema[0].dataType).alias("row"), F.col(c).alias("value"))
             for i, c in enumerate(cols)]
    met = indexed.select(F.inline(F.array(own, *given))).groupBy("at").agg(
        F.max("row").alias("row"), *[F.max(F.when(F.col("j") == i, F.col("value"))).alias(f"_d{i}") for i in range(len(cols))])
    each = met.select("row.*", *[f"_d{i}" for i in range(len(cols))], F.explode(F.lit(list(range(-1, len(cols))))).alias("_j"))
    tried = each.select("_j", F.col("_label").alias(label),
                        *[F.when(F.col("_j") == i, F.col(f"_d{i}")).otherwise(F.col(c)).alias(f) for i, (f, c) in enumerate(zip(features, cols))])
    auc = cut_lineage(M.roc_auc(predict_scores(model, tried, features), "score", label, ["_j"]))  # one row per feature
    base = auc.where("_j = -1").select("auc").first()
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "_j int, feature string")
    out = names.join(auc, "_j", "left").select("feature", F.lit(base and base["auc"]).cast("double").alias("base_auc"), F.col("auc").alias("perm_auc"))
    return out.withColumn("importance", F.col("base_auc") - F.col("perm_auc"))


def draw_params(space: Mapping, n: int, seed: int = 42) -> list[dict]:
    """Seeded random draws from a search space (int / float / log)."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        p = {}
        for k, (kind, lo, hi) in space.items():
            if kind == "int":
                p[k] = rng.randint(lo, hi)
            elif kind == "log":
                p[k] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                p[k] = rng.uniform(lo, hi)
        out.append(p)
    return out


def search_params(df: DataFrame, features: Sequence[str], label: str, folds: DataFrame,
                  space: Mapping, n_trials: int, family: str = "gbt", seed: int = 42) -> DataFrame:
    """Random search: for every trial and fold, fit on the fold's train rows
    and score F2 at 0.5 on its validation rows; one row per trial with the
    mean fold score (M2, A32).  ``folds`` carries ``fold`` and ``role``
    columns as produced by ``split.time_folds``; they are pinned once, as a
    fit reads its rows many times."""
    folds = cut_lineage(folds)
    fold_ids = sorted(r[0] for r in folds.select("fold").distinct().collect())
    rows = []
    for t, params in enumerate(draw_params(space, n_trials, seed)):
        scores = []
        for fo in fold_ids:
            tr = folds.where((F.col("fold") == fo) & (F.col("role") == "train"))
            vl = folds.where((F.col("fold") == fo) & (F.col("role") == "val"))
            model = fit_classifier(tr, features, label, family, params)
            m = M.binary_metrics(predict_scores(model, vl, features), "score", label, 0.5,
                                 beta=F2_BETA, digits=12).first()
            scores.append(float(m["f_beta"]))
        rows.append((t, str(params), float(sum(scores) / len(scores)) if scores else None))
    return df.sparkSession.createDataFrame(rows, "trial int, params string, mean_f2 double")


RUNGS = ((1 / 16, 1, 1 / 5), (1 / 4, 2, 1 / 3), (1.0, None, 1.0))   # share of trees, folds, share of trials that go on


def halving_search(df: DataFrame, features: Sequence[str], label: str, folds: DataFrame,
                   space: Mapping = REFERENCE_SPACE, n_trials: int = 150, family: str = "gbt", seed: int = 42,
                   rungs: Sequence[tuple[float, int | None, float]] = RUNGS, parallel: int = 4) -> DataFrame:
    """Random search with early stopping of losing trials (M2, A32): every
    trial is fitted with a share of its trees on the latest folds; the better
    ones (mean F2 at 0.5) go on to more trees and folds, the last rung fits
    them whole on all folds.  Fits are independent jobs, ``parallel`` of them
    at a time over the folds, which are pinned once.  One row per trial:
    params, the rung it reached and its mean F2 there."""
    from concurrent.futures import ThreadPoolExecutor

    pinned = cut_lineage(folds)
    ids = sorted(r[0] for r in pinned.select("fold").distinct().collect())
    draws = draw_params(space, n_trials, seed)

    def score(job: tuple[int, int, float]) -> tuple[int, float]:
        trial, fold, trees = job
        params = dict(draws[trial])
        if "maxIter" in params:
            params["maxIter"] = max(1, round(params["maxIter"] * trees))
        mine = pinned.where(F.col("fold") == fold)
        model = fit_classifier(mine.where("role = 'train'"), features, label, family, params)
        m = M.binary_metrics(predict_scores(model, mine.where("role = 'val'"), features), "score", label, 0.5, beta=F2_BETA, digits=12).first()
        return trial, float(m["f_beta"])

    alive, reached = list(range(n_trials)), {}
    with ThreadPoolExecutor(parallel) as pool:
        for k, (trees, n_folds, keep) in enumerate(rungs):
            # the latest folds have the most training rows
            use = ids if n_folds is None else ids[-n_folds:]
            found: dict[int, list[float]] = {}
            for trial, f2 in pool.map(score, [(t, f, trees) for t in alive for f in use]):
                found.setdefault(trial, []).append(f2)
            reached.update({t: (k, sum(v) / len(v)) for t, v in found.items()})
            # ties: the earlier trial
            alive = sorted(sorted(alive, key=lambda t: (-reached[t][1], t))[:max(1, math.ceil(len(alive) * keep))])
    rows = [(t, str(draws[t]), k, f2) for t, (k, f2) in sorted(reached.items())]
    return df.sparkSession.createDataFrame(rows, "trial int, params string, rung int, mean_f2 double")


def best_trial(searched: DataFrame) -> DataFrame:
    """The best trial of those that reached the last rung, the first on ties."""
    last = searched.agg(F.max("rung")).first()[0]
    return best_row(searched.where(F.col("rung") == F.lit(last)), "mean_f2", "trial")
