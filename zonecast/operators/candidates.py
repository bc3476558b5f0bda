"""All candidate models at once (M5, T7): one long table (model, split, score),
grouped curves, and a grouped choice of threshold and model.

The panel is scanned once for all candidates; every metric is a grouped
aggregate or a grouped curve over the long table, so the number of Spark jobs
does not grow with the number of models or splits.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import RECALL_TARGET
from . import metrics as M
from .model_store import StoredModel
from .ordering import best_row


def candidate_scores(panel: DataFrame, models: Mapping[str, StoredModel], keep: Sequence[str]) -> DataFrame:
    """``keep``, model, rank (its place among the candidates) and score: one
    row per panel row and model, from one scan of the panel."""
    scored = panel
    for i, m in enumerate(models.values()):
        scored = m.score(scored, f"_score_{i}")
    rows = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(i).alias("rank"), F.col(f"_score_{i}").alias("score"))
                     for i, name in enumerate(models)])
    return scored.select(*keep, F.inline(rows))


def model_thresholds(long: DataFrame, label: str, recall_floor: float) -> DataFrame:
    """model, threshold: per model the highest precision at the recall floor."""
    curve = M.pr_curve(long, "score", label, ["model"])
    return M.pick_threshold(curve, recall_floor, ["model"]).select("model", "threshold", "meets_target")


def evaluate_candidates(long: DataFrame, label: str, split: str, pick: Column, recall_floor: float = RECALL_TARGET,
                        validation: str = "val") -> DataFrame:
    """Per (model, split): confusion counts, precision, recall, F1, F2, AUC and
    average precision at the model's threshold, which is picked on the rows
    ``pick``; ``is_best`` marks the chosen model (``best_model``)."""
    thresholds = model_thresholds(long.where(pick), label, recall_floor)
    at = long.join(F.broadcast(thresholds), "model")  # one row per model
    by = ["model", split]
    found = M.binary_metrics(at, "score", label, F.col("threshold"), [*by, "rank", "meets_target"])
    ranks = M.rank_metrics(long, "score", label, by)
    table = found.join(ranks, by, "left")
    best = best_model(table, split, validation).select(F.col("model").alias("_best"))
    return table.join(F.broadcast(best), F.col("model") == F.col("_best"), "left") \
        .withColumn("is_best", F.col("_best").isNotNull()).drop("_best")


def best_model(evaluated: DataFrame, split: str, validation: str = "val") -> DataFrame:
    """The row of the model with the highest precision on the validation split
    at its threshold, the first candidate on ties (T7)."""
    return best_row(evaluated.where(F.col(split) == validation), "precision", "rank")
