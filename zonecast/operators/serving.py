"""Scoring-side table logic: tiers, alerts, defaults, shadow comparison,
tier counts (P19-P27, F7, F8, A8, A9, M10, J13).

The reference serves these through HTTP and a key-value store; here each is
a DataFrame operator usable in batch and inside a streaming micro-batch."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import action_for, agree, alert_flag, alert_score, tier
from .clean import trailing

# Fixed defaults for keys the online store does not know (reference values).
ONLINE_DEFAULTS = {"case_count": 1, "vulnerability_index": 0.5}
PROMOTE_AGREEMENT_PCT = 90.0   # fixed: shadow promotion recommendation floor


def with_tier(df: DataFrame, score: str, name: str = "risk_tier") -> DataFrame:
    return df.withColumn(name, tier(score))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill nulls left by a lookup with per-column defaults (P22); a stored
    0 stays 0 (only null is replaced)."""
    out = df
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def override(df: DataFrame, fresh: DataFrame, key: str, col: str) -> DataFrame:
    """Replace a static feature by its fresh value where one exists."""
    f = fresh.select(key, F.col(col).alias("_fresh"))
    return df.join(f, key, "left").withColumn(col, F.coalesce("_fresh", col)).drop("_fresh")


def with_action(df: DataFrame, tier_col: str = "risk_tier", name: str = "action") -> DataFrame:
    """Tier -> action text (P25)."""
    return df.withColumn(name, action_for(tier_col))


def with_alert(df: DataFrame, score: str, vulnerability: str, cases: str,
               threshold: float = 0.6) -> DataFrame:
    """alert_score = round(score * vulnerability * ln(cases + 1), 4) and the
    strict ``> threshold`` decision (P20, P21)."""
    return (df.withColumn("alert_score", alert_score(score, vulnerability, cases))
              .withColumn("alert_triggered", alert_flag("alert_score", threshold)))


def tier_counts(df: DataFrame, tier_col: str = "risk_tier") -> DataFrame:
    """Rows per tier."""
    return df.groupBy(tier_col).agg(F.count(F.lit(1)).alias("n"))


def shadow_score(df: DataFrame, production: str, shadow: str, threshold: float = 0.6) -> DataFrame:
    """Tier both scores and flag agreement."""
    return (df.withColumn("production_tier", tier(production))
              .withColumn("shadow_tier", tier(shadow))
              .withColumn("agreement", agree(production, shadow, threshold)))


def shadow_summary(df: DataFrame, ts: str, production: str = "production_score",
                   shadow: str = "shadow_score", version: str = "shadow_model_version",
                   ref=None, days: int = 7) -> DataFrame:
    """Comparison of shadow vs production scores over the last ``days``
    before ``ref`` (a parameter): count, agreement %, mean / max absolute
    difference (rounded 4), High-tier misses both ways, window bounds,
    distinct shadow versions and the promotion recommendation (A8, X7).
    One aggregation pass."""
    src = df
    if ref is not None:
        src = trailing(df, ts, days, ref)
    diff = F.abs(F.col(production) - F.col(shadow))
    out = src.agg(
        F.count(F.lit(1)).alias("total_cases"),
        F.round(F.avg(F.when(F.col("agreement"), 1.0).otherwise(0.0)) * 100, 1).alias("agreement_pct"),
        F.round(F.avg(diff), 4).alias("avg_score_diff"),
        F.round(F.max(diff), 4).alias("max_score_diff"),
        F.count_if((F.col("production_tier") == "High") & (F.col("shadow_tier") != "High"))
        .alias("prod_high_shadow_missed"),
        F.count_if((F.col("shadow_tier") == "High") & (F.col("production_tier") != "High"))
        .alias("shadow_high_prod_missed"),
        F.min(ts).alias("window_start"), F.max(ts).alias("window_end"),
        F.countDistinct(version).alias("shadow_versions"))
    return out.withColumn("ready_to_promote",
                          F.coalesce(F.col("agreement_pct") >= PROMOTE_AGREEMENT_PCT, F.lit(False)))


def latest_scores(features: DataFrame, key: str, date: str, cols: Sequence[str]) -> DataFrame:
    """Latest non-null value per key for each feature column, the greatest on
    ties (A5 for M4)."""
    aggs = [F.max(date).alias(date)] + [
        F.expr(f"max_by(`{c}`, struct(`{date}`, `{c}`)) FILTER (WHERE `{c}` IS NOT NULL)").alias(c) for c in cols]
    return features.groupBy(key).agg(*aggs)
