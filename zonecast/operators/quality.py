"""Data-quality checks, profiles and constraint validation.

All checks are one-pass aggregates; the check report is a long table
(check, metric, threshold, passed) so it can be written like any table."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (COVERAGE_SHARE, MAX_NULL_RATE, MAX_STALE_DAYS)


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls per column, one aggregation pass, long output."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return row.unpivot([], cols, "column", "null_rate")


def null_report(df: DataFrame, flag_pct: float = 20.0, digits: int = 2) -> DataFrame:
    """Null percentage per column, flagged above ``flag_pct`` (A23 report)."""
    r = null_rates(df)
    return r.select("column", F.round(F.col("null_rate") * 100, digits).alias("null_pct")) \
        .withColumn("flagged", F.col("null_pct") > F.lit(flag_pct))


def dq_report(df: DataFrame, date: str, zone: str, features: Sequence[str], run_date: str,
              expected_zones: int | None = None,
              activity: Mapping[str, float] | None = None,
              max_stale_days: int = MAX_STALE_DAYS, max_null_rate: float = MAX_NULL_RATE,
              coverage_share: float = COVERAGE_SHARE) -> DataFrame:
    """Pipeline health on the latest snapshot (A23-A26): freshness in days
    from the latest date to ``run_date`` (a parameter), null rate per
    feature, zone coverage against ``expected_zones`` (default: distinct
    zones over the whole table), activity floors (feature mean >= floor),
    and an overall AND.  Rows: (check, metric, threshold, passed)."""
    activity = dict(activity or {})
    latest_date = df.agg(F.max(date).alias("d")).first()["d"]
    latest = df.where(F.col(date) == F.lit(latest_date))
    if expected_zones is None:
        expected_zones = df.agg(F.countDistinct(zone)).first()[0]
    aggs = [F.countDistinct(zone).alias("_zones")]
    aggs += [F.avg(F.col(c).isNull().cast("double")).alias(f"_null_{c}") for c in features]
    aggs += [F.avg(F.col(c).cast("double")).alias(f"_mean_{c}") for c in activity]
    a = latest.agg(*aggs)
    fresh = F.datediff(F.lit(run_date).cast("date"), F.lit(latest_date).cast("date"))
    rows = [F.struct(F.lit("freshness").alias("check"), fresh.cast("double").alias("metric"),
                     F.lit(float(max_stale_days)).alias("threshold"),
                     (fresh <= max_stale_days).alias("passed"))]
    for c in features:
        m = F.col(f"_null_{c}")
        rows.append(F.struct(F.lit(f"null_rate:{c}").alias("check"), m.alias("metric"),
                             F.lit(float(max_null_rate)).alias("threshold"),
                             F.coalesce(m <= max_null_rate, F.lit(False)).alias("passed")))
    need = expected_zones * coverage_share
    rows.append(F.struct(F.lit("coverage").alias("check"), F.col("_zones").cast("double").alias("metric"),
                         F.lit(float(need)).alias("threshold"),
                         (F.col("_zones") >= F.lit(need)).alias("passed")))
    for c, floor in activity.items():
        m = F.col(f"_mean_{c}")
        rows.append(F.struct(F.lit(f"activity:{c}").alias("check"), m.alias("metric"),
                             F.lit(float(floor)).alias("threshold"),
                             F.coalesce(m >= F.lit(floor), F.lit(False)).alias("passed")))
    long = a.select(F.inline(F.array(*rows)))
    overall = long.agg(F.lit("overall").alias("check"), F.lit(None).cast("double").alias("metric"),
                       F.lit(None).cast("double").alias("threshold"),
                       F.bool_and("passed").alias("passed"))
    return long.unionByName(overall)


def profile(df: DataFrame, date: str, distinct_cols: Iterable[str]) -> DataFrame:
    """Row count, distinct counts and date range in one pass."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.min(date).alias("min_date"),
            F.max(date).alias("max_date")]
    aggs += [F.countDistinct(c).alias(f"n_{c}") for c in distinct_cols]
    return df.agg(*aggs)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count / mean / stddev / min / quartiles / max of numeric columns
    (A28, ``DataFrame.summary``: one distributed pass, approximate
    quartiles)."""
    return df.select(*cols).summary("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def check_constraints(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (),
                      allowed: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Violations of NOT NULL, UNIQUE (on the column set) and CHECK IN
    (K8).  Rows: (constraint, value, n) -- one per violating value; UNIQUE
    and CHECK are grouped aggregates (partial, skew-safe)."""
    parts = []
    for c in not_null:
        parts.append(df.where(F.col(c).isNull()).agg(F.count(F.lit(1)).alias("n"))
                     .where("n > 0").select(F.lit(f"not_null:{c}").alias("constraint"),
                                            F.lit(None).cast("string").alias("value"), "n"))
    if unique:
        parts.append(df.groupBy(*unique).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                     .select(F.lit("unique:" + ",".join(unique)).alias("constraint"),
                             F.concat_ws("|", *[F.col(c).cast("string") for c in unique]).alias("value"),
                             "n"))
    for c, vals in (allowed or {}).items():
        parts.append(df.where(~F.coalesce(F.col(c).isin(list(vals)), F.lit(False)))
                     .groupBy(c).agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(f"check_in:{c}").alias("constraint"),
                             F.col(c).cast("string").alias("value"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def split_summary(df: DataFrame, split: str, label: str, digits: int = 4) -> DataFrame:
    """Rows, positives and positive rate per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.sum(F.col(label)).alias("n_pos"),
                                 F.round(F.avg(F.col(label)), digits).alias("pos_rate"))
