"""Queries: Spark ML on the gold panel (rows-only checks; iterative fits
have no SQL twin).

The panel is the flagship ``risk_panel`` (one row per zone x date with the
forward label); the first 16 snapshot days train, the next 6 calibrate /
pick the threshold, 4 more test, the rest are out of time (oot) -- date
offsets from the first snapshot, so the split scales with the calendar, not
with row counts."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import functions as F

from ..operators import attribution as A
from ..operators import candidates as CD
from ..operators import drift as D
from ..operators import ml as ML
from ..operators import model_store as MS
from ..operators import ordering as O
from ..operators import split as SP
from ..session import cut_lineage, scratch_path
from .oracle import sql
from .queries import risk_panel
from .registry import query, rnd

FEATURES = ["active_roll2w", "active_roll4w", "value_sum", "value_roll2w_log",
            "value_roll4w_log", "active_cluster_overlap"]
GBT_PARAMS = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1}
RF_PARAMS = {"maxIter": 30, "maxDepth": 5}
SEARCH_SPACE = {"maxIter": ("int", 5, 20), "maxDepth": ("int", 2, 5),
                "stepSize": ("log", 0.05, 0.3), "subsamplingRate": ("float", 0.6, 1.0),
                "pos_weight": ("float", 1.0, 10.0)}


def model_table(spark, sf_dir):
    p = risk_panel(spark, sf_dir)
    d0 = p.agg(F.min("date")).first()[0]
    off = F.datediff(F.col("date"), F.lit(d0))
    return p.withColumn("split", F.when(off < 16, "train").when(off < 22, "calib")
                        .when(off < 26, "test").otherwise("oot"))


@query("gbt_scores")
def gbt_scores(spark, sf_dir):
    """Boosted trees with positive-class weight, scored on every row, tiered
    (M1, M4, P19)."""
    mt = model_table(spark, sf_dir)
    model = ML.fit_classifier(mt.where("split = 'train'"), FEATURES, "label", "gbt", GBT_PARAMS)
    s = ML.predict_scores(model, mt, FEATURES)
    return s.select("date", "user_id", "split", rnd("score", 4), "label") \
        .withColumn("risk_tier", F.when(F.col("score") >= 0.6, "High")
                    .when(F.col("score") >= 0.3, "Medium").otherwise("Low"))


@query("rf_scores")
def rf_scores(spark, sf_dir):
    """Second model family: random forest with class weight (M1)."""
    mt = model_table(spark, sf_dir)
    model = ML.fit_classifier(mt.where("split = 'train'"), FEATURES, "label", "rf",
                              RF_PARAMS)
    return ML.predict_scores(model, mt, FEATURES).select("date", "user_id", "split",
                                                         rnd("score", 4), "label")


@query("platt")
def platt(spark, sf_dir):
    """Platt calibration fitted on the calib slice, applied to test (M3)."""
    mt = model_table(spark, sf_dir)
    model = ML.fit_classifier(mt.where("split = 'train'"), FEATURES, "label", "gbt", GBT_PARAMS)
    s = ML.predict_scores(model, mt, FEATURES)
    ab = ML.calibrate(s.where("split = 'calib'"), "score", "label")
    out = ML.apply_calibration(s.where("split = 'test'"), "score", ab)
    return out.select("date", "user_id", rnd("score", 4), rnd("score_cal", 4), "label")


class Fitted:
    """The panel, written once, and the candidates fitted on it: shared by the
    steps of one query."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def table(self):
        """The model table; the validation days are halved into calibration
        and threshold days."""
        mt = model_table(self.spark, self.sf_dir)
        path = scratch_path(self.spark, f"model-table-{uuid.uuid4().hex[:12]}")
        mt.write.parquet(path)
        t = self.spark.read.schema(mt.schema).parquet(path)
        first = t.where("split = 'calib'").agg(F.min("date")).first()[0]
        half = F.when(F.datediff("date", F.lit(first).cast("date")) < 3, "calib").otherwise("thresh")
        return t.withColumn("half", F.when(F.col("split") == "calib", half))

    @cached_property
    def models(self):
        """Two calibrated families (M1, M3)."""
        train, calib = self.table.where("split = 'train'"), self.table.where("half = 'calib'")
        return {"gbt": MS.train_model(train, FEATURES, "label", "gbt", "gbt-1", GBT_PARAMS, calib=calib),
                "rf": MS.train_model(train, FEATURES, "label", "rf", "rf-1", RF_PARAMS, calib=calib)}

    @cached_property
    def evaluated(self):
        keep = ["date", "user_id", "split", "half", "label"]
        long = cut_lineage(CD.candidate_scores(self.table, self.models, keep))
        return cut_lineage(CD.evaluate_candidates(long, "label", "split", F.col("half") == "thresh", 0.80, "calib"))

    @property
    def best(self):
        return self.models[CD.best_model(self.evaluated, "split", "calib").first()["model"]]


@query("model_eval")
def model_eval(spark, sf_dir, fitted=None):
    """Every calibrated candidate on every split, at the threshold picked on
    the threshold days (recall floor 0.8): counts, metrics, AUC, average
    precision, and which one is chosen (M5, T7, A10-A15)."""
    ev = (fitted or Fitted(spark, sf_dir)).evaluated
    return ev.select("model", "split", rnd("threshold"), "n_rows", "n_positive", "tp", "fp", "tn", "fn", "precision", "recall", "f1", "f_beta",
                     rnd("auc", 4), rnd("avg_precision", 4), "meets_target", "is_best")


@query("promotion_gate")
def promotion_gate(spark, sf_dir):
    """Gate of the chosen model on test vs the out-of-time slice after it,
    with the importances counted that were computed (M6)."""
    fitted = Fitted(spark, sf_dir)
    ev = model_eval(spark, sf_dir, fitted)
    if "is_best" in ev.columns:
        ev = ev.where("is_best")
    test = ev.where("split = 'test'").select("recall", "auc")
    oot = ev.where("split = 'oot'").select("recall", "auc")
    importances = perm_importance(spark, sf_dir, fitted).where("importance IS NOT NULL").count()
    return D.promotion_gate(test, oot, importance_rows=importances)


@query("perm_importance")
def perm_importance(spark, sf_dir, fitted=None):
    """AUC drop per shuffled feature on the test slice, for the chosen
    model's trees or, alone, the boosted trees (M7)."""
    if fitted is not None:
        model, mt = fitted.best.pipeline, fitted.table
    else:
        mt = cut_lineage(model_table(spark, sf_dir))
        model = ML.fit_classifier(mt.where("split = 'train'"), FEATURES, "label", "gbt", GBT_PARAMS)
    return ML.permutation_importance(model, mt.where("split = 'test'"), FEATURES, "label",
                                     ["date", "user_id"])


def _stored_candidates(fitted):
    """The candidates saved and loaded, with their node tables."""
    root = scratch_path(fitted.spark, f"candidates-{uuid.uuid4().hex[:12]}")
    out = {}
    for name, model in fitted.models.items():
        MS.save_model(fitted.spark, model, f"{root}/{name}")
        loaded = MS.load_model(fitted.spark, f"{root}/{name}")
        out[name] = loaded, cut_lineage(A.node_table(fitted.spark, f"{root}/{name}", loaded))
    return out


@query("tree_importance")
def tree_importance(spark, sf_dir):
    """Mean absolute tree contribution per feature and candidate on the test
    days, the top eight of each (M7, T4)."""
    fitted = Fitted(spark, sf_dir)
    test = fitted.table.where("split = 'test'")
    parts = [A.mean_abs_attribution(test, m, nodes).withColumn("model", F.lit(name)) for name, (m, nodes) in _stored_candidates(fitted).items()]
    ranked = [D.ranked_importance(p, "feature", "importance").where(F.col("rank") <= 8) for p in parts]
    out = ranked[0]
    for r in ranked[1:]:
        out = out.unionByName(r)
    return out.select("model", "feature", rnd("importance", 6), "rank")


@query("attribution_parity")
def attribution_parity(spark, sf_dir):
    """Per candidate and split: rows, and those on which bias plus the tree
    contributions equal the fitted model's margin (M7)."""
    fitted = Fitted(spark, sf_dir)
    out = None
    for name, (m, nodes) in _stored_candidates(fitted).items():
        phi = A.contributions(A.margin(m, fitted.table), m, nodes)
        total = F.aggregate("phi", F.col("bias"), lambda s, x: s + x)
        part = phi.groupBy(F.lit(name).alias("model"), "split").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(total - F.col("margin")) < 1e-9).alias("n_equal"))
        out = part if out is None else out.unionByName(part)
    return out


sql("attribution_parity", """
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE ts IS NOT NULL),
s AS (SELECT date_diff('day', (SELECT min(date) FROM d), date) AS off FROM d),
p AS (SELECT CASE WHEN off < 16 THEN 'train' WHEN off < 22 THEN 'calib' WHEN off < 26 THEN 'test' ELSE 'oot' END AS split,
        (SELECT count(DISTINCT user_id) FROM events) AS zones FROM s)
SELECT model, split, sum(zones)::BIGINT AS n_rows, sum(zones)::BIGINT AS n_equal FROM p, (VALUES ('gbt'), ('rf')) m(model) GROUP BY ALL
""")


@query("tree_attribution_drift")
def tree_attribution_drift(spark, sf_dir):
    """Tree contributions on the test days against the days after them: rank
    shift and relative change per feature (M8)."""
    fitted = Fitted(spark, sf_dir)
    m, nodes = _stored_candidates(fitted)["gbt"]
    both = A.mean_abs_attribution(fitted.table.where("split IN ('test', 'oot')"), m, nodes, ["split"])
    base, now = (both.where(F.col("split") == s).select("feature", "importance") for s in ("test", "oot"))
    return D.attribution_drift(base, now, "feature", "importance")


@query("hpt")
def hpt(spark, sf_dir):
    """Seeded random search over expanding time folds of the train slice,
    mean F2 per trial and the running best (M2, W11, A32, W9, T7)."""
    mt = model_table(spark, sf_dir).where("split = 'train'")
    folds = SP.time_folds(mt, "date", 3)
    res = ML.search_params(mt, FEATURES, "label", folds, SEARCH_SPACE, 3, "gbt")
    return O.running_best(res, "trial", "mean_f2")


@query("batch_scores")
def batch_scores(spark, sf_dir):
    """Weekly batch scoring (M4): latest non-null features per zone (A5),
    model score rounded 4, tier, action, zones above 0.5 flagged (F7)."""
    from ..operators import serving as SV
    mt = model_table(spark, sf_dir)
    model = ML.fit_classifier(mt.where("split = 'train'"), FEATURES, "label", "gbt", GBT_PARAMS)
    latest = SV.latest_scores(mt, "user_id", "date", FEATURES)
    s = ML.predict_scores(model, latest, FEATURES)
    out = SV.with_action(SV.with_tier(s.withColumn("score", F.round("score", 4)), "score"))
    return out.select("user_id", "date", "score", "risk_tier", "action",
                      (F.col("score") >= 0.5).alias("above_default"))
