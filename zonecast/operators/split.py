"""Temporal splits and expanding-window folds.

Split assignment is a generator, not a join: each row emits one row per
split whose date range contains it (splits may overlap, e.g. ``val`` and its
two halves).  Folds number the distinct dates (one row per calendar day,
bounded) and map every row to the folds it trains or validates."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed split boundaries (inclusive); None = open end.  The reference's table
# (train to 2018-12-31, val 2019-01..06 with halves at 03-31, test
# 2019-07..12, oot from 2020-01-01) is expressed with ``shift_years`` so it
# can be laid over any calendar.
REFERENCE_SPLITS = (
    ("train", None, "2018-12-31"),
    ("val", "2019-01-01", "2019-06-30"),
    ("val_calib", "2019-01-01", "2019-03-31"),
    ("val_thresh", "2019-04-01", "2019-06-30"),
    ("test", "2019-07-01", "2019-12-31"),
    ("oot", "2020-01-01", None),
)
N_FOLDS = 5


def shifted_splits(years: int, splits=REFERENCE_SPLITS):
    """The split table moved by whole years."""
    def mv(d):
        return None if d is None else f"{int(d[:4]) + years:04d}{d[4:]}"
    return tuple((n, mv(a), mv(b)) for n, a, b in splits)


def assign_splits(df: DataFrame, date: str, splits=REFERENCE_SPLITS,
                  name: str = "split") -> DataFrame:
    """Tag rows with every split containing their date."""
    d = F.to_date(F.col(date))
    tags = []
    for n, lo, hi in splits:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (d >= F.lit(lo).cast("date"))
        if hi is not None:
            cond = cond & (d <= F.lit(hi).cast("date"))
        tags.append(F.when(cond, F.lit(n)))
    arr = F.filter(F.array(*tags), lambda x: x.isNotNull())
    return df.withColumn(name, F.explode(arr))


def time_folds(df: DataFrame, date: str, k: int = N_FOLDS) -> DataFrame:
    """Expanding-window folds over the distinct dates of ``df`` (W11):
    fold_size = n_dates // (k + 1); fold i trains on dates [0, i*size) and
    validates on [i*size, (i+1)*size); left-over dates are unused.  Each row
    is emitted once per (fold, role) it belongs to, as columns
    ``fold`` and ``role``."""
    d = F.to_date(F.col(date)).alias("_d")
    dates = df.select(d).where("_d IS NOT NULL").distinct()
    # one row per distinct day: a bounded global window
    idx = dates.withColumn("_i", F.row_number().over(Window.orderBy("_d")) - 1)
    n = dates.count()
    size = n // (k + 1)
    if size == 0:
        return df.withColumn("fold", F.lit(None).cast("int")).withColumn(
            "role", F.lit(None).cast("string")).limit(0)
    tagged = df.withColumn("_d", F.to_date(F.col(date))).join(F.broadcast(idx) if n <= 1_000_000
                                                             else idx, "_d")
    blk = F.floor(F.col("_i") / size).cast("int")
    train_folds = F.when(blk + 1 <= k, F.sequence(blk + 1, F.lit(k))).otherwise(F.array().cast("array<int>"))
    val_fold = F.when((blk >= 1) & (blk <= k), F.array(blk)).otherwise(F.array().cast("array<int>"))
    roles = F.concat(F.transform(train_folds, lambda f: F.struct(f.alias("fold"), F.lit("train").alias("role"))),
                     F.transform(val_fold, lambda f: F.struct(f.alias("fold"), F.lit("val").alias("role"))))
    out = tagged.withColumn("_r", F.explode(roles))
    return out.withColumn("fold", F.col("_r.fold")).withColumn("role", F.col("_r.role")) \
        .drop("_r", "_i", "_d")


def fold_summary(folds: DataFrame, date: str, label: str | None = None) -> DataFrame:
    """Rows, dates and date range per (fold, role)."""
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct(F.to_date(F.col(date))).alias("n_dates"),
            F.min(F.to_date(F.col(date))).alias("min_date"),
            F.max(F.to_date(F.col(date))).alias("max_date")]
    if label:
        aggs.append(F.sum(label).alias("n_pos"))
    return folds.groupBy("fold", "role").agg(*aggs)


def split_rows(df: DataFrame, split: str, names: Sequence[str]) -> DataFrame:
    return df.where(F.col(split).isin(list(names)))
