"""Composite vulnerability index: PCA weights, global min-max scaling and
the weighted sum (A30, P17, P18).

The min/max bounds are one-row aggregates read back as scalars, so scaling
is a narrow projection (no join).  PCA runs on Spark ML: the covariance
matrix is aggregated across the cluster, only the d x d matrix is
decomposed on the driver."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import minmax_expr

EPS = 1e-9          # fixed: min-max denominator guard
MIN_PCA_ROWS = 10   # fixed: fewer complete rows -> equal weights


def minmax(df: DataFrame, cols: Sequence[str], eps: float = EPS, suffix: str = "_norm",
           fill_null: bool = True) -> DataFrame:
    """(x - min) / (max - min + eps) over the whole table; nulls count as 0
    before the bounds are taken (P17)."""
    src = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if fill_null else F.col(c).cast("double")
           for c in cols]
    row = df.agg(*[F.min(s).alias(f"lo{i}") for i, s in enumerate(src)],
                 *[F.max(s).alias(f"hi{i}") for i, s in enumerate(src)]).first()
    out = df
    for i, c in enumerate(cols):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        out = out.withColumn(c + suffix, minmax_expr(c, lo if lo is not None else 0.0,
                                                     hi if hi is not None else 0.0, eps))
    return out


def composite_index(df: DataFrame, weights: Mapping[str, float], name: str = "vulnerability_index",
                    digits: int = 4, half_even: bool = False) -> DataFrame:
    """round(sum w_i * col_i, digits) (P18); ``half_even`` for pandas parity."""
    expr = None
    for c, w in weights.items():
        t = F.lit(float(w)) * F.col(c)
        expr = t if expr is None else expr + t
    return df.withColumn(name, (F.bround if half_even else F.round)(expr, digits))


def pca_weights(df: DataFrame, cols: Sequence[str], min_rows: int = MIN_PCA_ROWS,
                digits: int = 4) -> dict:
    """PC1 loadings of the standardised columns, absolute, normalised to sum
    1 and rounded; PC1 variance share in percent (1 decimal); rows used.
    Rows with a null in any column are dropped; fewer than ``min_rows`` ->
    equal weights (A30).

    With two standardised inputs PC1 is always (1, 1)/sqrt(2) up to sign, so
    the weights are 0.5 / 0.5 and the share is (1 + |r|) / 2 -- a property
    of PCA, kept as is."""
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler

    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    n = data.count()
    k = len(cols)
    if n < min_rows:
        return {"weights": {c: round(1.0 / k, digits) for c in cols}, "pc1_share_pct": None,
                "n_rows": 0, "method": "fallback equal weights"}
    vec = VectorAssembler(inputCols=list(cols), outputCol="_v").transform(data)
    std = StandardScaler(inputCol="_v", outputCol="_z", withMean=True, withStd=True).fit(vec)
    model = PCA(k=k, inputCol="_z", outputCol="_p").fit(std.transform(vec))
    pc1 = [abs(float(x)) for x in model.pc.toArray()[:, 0]]
    tot = sum(pc1)
    weights = {c: round(v / tot, digits) for c, v in zip(cols, pc1)}
    share = round(float(model.explainedVariance[0]) * 100, 1)
    return {"weights": weights, "pc1_share_pct": share, "n_rows": n,
            "method": "PCA PC1 loadings, abs normalised"}


def pca_weights_frame(df: DataFrame, cols: Sequence[str], min_rows: int = MIN_PCA_ROWS) -> DataFrame:
    """``pca_weights`` as a one-row DataFrame (weights as ``w_<col>``)."""
    res = pca_weights(df, cols, min_rows)
    spark = df.sparkSession
    cols_out = [F.lit(v).cast("double").alias(f"w_{c}") for c, v in res["weights"].items()]
    return spark.range(1).select(*cols_out,
                                 F.lit(res["pc1_share_pct"]).cast("double").alias("pc1_share_pct"),
                                 F.lit(res["n_rows"]).cast("long").alias("n_rows"),
                                 F.lit(res["method"]).alias("method"))
