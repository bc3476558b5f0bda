"""Persisted models: a Spark ML pipeline with its feature list, version and
calibration in one folder, loaded wherever scores are needed (M4, J11).

The folder holds ``pipeline`` (Spark ML's own format) and ``meta`` (one row).
``meta`` is written last: a folder without it is not a model.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ml as ML

META = "features array<string>, version string, a double, b double"


@dataclass(frozen=True)
class StoredModel:
    """A fitted pipeline; ``sigmoid`` is Platt's (a, b), or None."""

    pipeline: PipelineModel
    features: tuple[str, ...]
    version: str
    sigmoid: tuple[float, float] | None = None

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        """``df`` with the (calibrated) score; missing features count as 0.
        ``df`` may be a stream."""
        out = ML.predict_scores(self.pipeline, df, self.features, name)
        if self.sigmoid is None:
            return out
        a, b = self.sigmoid
        return out.withColumn(name, 1 / (1 + F.exp(F.lit(a) * F.col(name) + F.lit(b))))


def save_model(spark: SparkSession, model: StoredModel, path: str) -> None:
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    a, b = model.sigmoid or (None, None)
    spark.createDataFrame([(list(model.features), model.version, a, b)], META).coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> StoredModel:
    m = spark.read.schema(META).parquet(f"{path}/meta").first()
    return StoredModel(PipelineModel.load(f"{path}/pipeline"), tuple(m["features"]), m["version"],
                       None if m["a"] is None else (m["a"], m["b"]))


def train_model(train: DataFrame, features: Sequence[str], label: str, family: str, version: str,
                params: dict | None = None, pos_weight: float | None = None,
                calib: DataFrame | None = None) -> StoredModel:
    """Fit on ``train``; with ``calib`` the scores are Platt-calibrated on it
    (M1, M3)."""
    pipeline = ML.fit_classifier(train, features, label, family, params, pos_weight)
    sigmoid = None
    if calib is not None:
        ab = ML.calibrate(ML.predict_scores(pipeline, calib, features), "score", label).first()
        sigmoid = (ab["a"], ab["b"])
    return StoredModel(pipeline, tuple(features), version, sigmoid)
