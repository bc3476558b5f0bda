"""Small shared helpers.

Broadcast policy: an explicit ``broadcast`` hint is only placed on a side
whose row count has a *proven* bound (a parameter table, a row per model, a
per-partition summary).  Everything else is left to the planner: with AQE on, Spark converts a join to a broadcast join only after
measuring the shuffled side at run time, and falls back to a sort-merge join
beyond ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_number(c: Column) -> Column:
    """Days since 1970-01-01 as an integer (for RANGE windows on dates)."""
    return F.unix_date(c.cast("date"))


def require_columns(df: DataFrame, cols) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
