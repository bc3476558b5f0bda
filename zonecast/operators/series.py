"""Daily series: calendar reindex, limited forward fill, linear interpolation.

All windows are partitioned by the series key (station, supplier, ...); a
series holds at most one row per calendar day, so a partition is bounded by
the calendar span whatever the raw data volume.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .guards import day_number


def calendar(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """Every day between the first and last date, per key (U9, U10).  Built by
    a per-key 1-row aggregate and ``sequence``/``explode`` (no join)."""
    b = df.where(F.col(date).isNotNull()).groupBy(*by).agg(
        F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    return b.select(*by, F.explode(F.sequence("_lo", "_hi")).alias(date))


def fill_calendar(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """Reindex to a complete daily calendar per key; missing days get null
    values (U9) -- the placeholder rows of U11."""
    return calendar(df, date, by).join(df, [*by, date], "left")


def _series_window(by: Sequence[str], date: str):
    return Window.partitionBy(*by).orderBy(date) if by else Window.orderBy(date)


def ffill_limit(df: DataFrame, date: str, value: str, limit: int = 3,
                by: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Forward fill at most ``limit`` days after the last valid value."""
    out = out or value
    w = _series_window(by, date).rowsBetween(Window.unboundedPreceding, 0)
    day = day_number(F.col(date))
    p_val = F.last(value, ignorenulls=True).over(w)
    p_day = F.last(F.when(F.col(value).isNotNull(), day), ignorenulls=True).over(w)
    return df.withColumn(out, F.when(F.col(value).isNotNull(), F.col(value))
                         .when(day - p_day <= limit, p_val))


def interpolate(df: DataFrame, date: str, value: str, limit: int = 3,
                by: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Forward fill with ``limit`` then linear interpolation of the rest
    (W4 + W5), on a calendar-complete series.  With p the last valid day and
    n the next valid day: gap <= limit -> v_p; no n -> v_p; no p -> null;
    else v_p + (v_n - v_p) * (i - p - limit) / (n - p - limit)."""
    out = out or value
    w_prev = _series_window(by, date).rowsBetween(Window.unboundedPreceding, 0)
    # "next valid" = running last over the reversed order: a growing frame,
    # linear per series (a current-row..unbounded-following frame is
    # re-aggregated for every row, quadratic in the series length)
    rev = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(F.col(date).desc())
    w_next = rev.rowsBetween(Window.unboundedPreceding, 0)
    day = day_number(F.col(date))
    valid_day = F.when(F.col(value).isNotNull(), day)
    tmp = (df.withColumn("_pv", F.last(value, ignorenulls=True).over(w_prev))
             .withColumn("_pd", F.last(valid_day, ignorenulls=True).over(w_prev))
             .withColumn("_nv", F.last(value, ignorenulls=True).over(w_next))
             .withColumn("_nd", F.last(valid_day, ignorenulls=True).over(w_next)))
    gap = day - F.col("_pd")
    filled = (F.when(F.col(value).isNotNull(), F.col(value))
              .when(F.col("_pd").isNull(), F.lit(None))
              .when(gap <= limit, F.col("_pv"))
              .when(F.col("_nd").isNull(), F.col("_pv"))
              .otherwise(F.col("_pv") + (F.col("_nv") - F.col("_pv")) * (gap - limit)
                         / (F.col("_nd") - F.col("_pd") - limit)))
    return tmp.withColumn(out, filled).drop("_pv", "_pd", "_nv", "_nd")


def fill_series(df: DataFrame, date: str, value: str, by: Sequence[str] = (), limit: int = 3,
                raw: str | None = None, out: str | None = None) -> DataFrame:
    """Calendar reindex + limited forward fill + linear interpolation in one
    generator pass (U9, W4, W5), per key from its first to its last day, valid or
    not: days before the first valid one are null, days after the last one
    carry its value on.  Each valid day is paired with the next valid day (``lead`` over the
    valid rows only) and emits every day of the segment [p, n) with its
    filled value -- the same rule as ``interpolate``, without a calendar join
    or a window over the reindexed rows.  ``raw`` keeps the original value
    (null on generated days)."""
    raw = raw or value
    out = out or value
    day = day_number(F.col(date))
    days = df.where(F.col(date).isNotNull()) \
        .select(*by, F.col(date).alias("_d"), day.alias("_pd"), F.col(value).alias("_pv"))
    every = Window.partitionBy(*by) if by else Window.partitionBy()
    days = (days.withColumn("_lo", F.min("_pd").over(every)).withColumn("_hi", F.max("_pd").over(every))
            .withColumn("_first", F.min(F.when(F.col("_pv").isNotNull(), F.col("_pd"))).over(every)))
    # valid days; of a key without any, its first day stands for all
    lone = F.col("_first").isNull() & (F.col("_pd") == F.col("_lo"))
    w = every.orderBy("_pd")
    seg = (days.where(F.col("_pv").isNotNull() | lone)
           .withColumn("_nd", F.lead("_pd").over(w)).withColumn("_nv", F.lead("_pv").over(w)))
    start = F.when(F.col("_pd") == F.col("_first"), F.col("_lo") - F.col("_pd")).otherwise(F.lit(0))
    end = F.coalesce(F.col("_nd") - 1, F.col("_hi")) - F.col("_pd")
    rows = seg.withColumn("_k", F.explode(F.sequence(start, end)))
    gap = F.col("_k")
    filled = (F.when(gap < 0, F.lit(None))
              .when(gap == 0, F.col("_pv"))
              .when(gap <= limit, F.col("_pv"))
              .when(F.col("_nd").isNull(), F.col("_pv"))
              .otherwise(F.col("_pv") + (F.col("_nv") - F.col("_pv")) * (gap - limit)
                         / (F.col("_nd") - F.col("_pd") - limit)))
    return rows.select(*by, F.date_add(F.col("_d"), F.col("_k")).alias(date),
                       F.when(gap == 0, F.col("_pv")).alias(raw), filled.alias(out))


def month_gaps(df: DataFrame, date: str, name: str = "n_rows") -> DataFrame:
    """Monthly row counts with empty months kept (A31): month-end calendar
    from min..max, left join the counts, zero-fill, flag gaps."""
    m = df.select(F.last_day(F.col(date)).alias("month")).where("month IS NOT NULL")
    counts = m.groupBy("month").agg(F.count(F.lit(1)).alias(name))
    b = counts.agg(F.min("month").alias("_lo"), F.max("month").alias("_hi"))
    cal = b.select(F.explode(F.sequence(F.trunc("_lo", "month"), F.trunc("_hi", "month"),
                                        F.expr("INTERVAL 1 MONTH"))).alias("_m")) \
        .select(F.last_day("_m").alias("month"))
    return (cal.join(counts, "month", "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("long"))
            .withColumn("is_gap", F.col(name) == 0))
