"""Registered queries over the driver tables.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables.  The
driver tables stand in for the reference's inputs (SURVEY section 7.3):
``events`` plays the case events (user = zone, ``error`` = active cluster,
``value`` = recent cases), ``lineitem`` the weather and score tables,
``customer`` the zone scores, ``embeddings`` the point layer.

Floating outputs are rounded (``R`` digits) so that the DuckDB oracle, which
sums in a different order, compares equal.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import panel as P
from .registry import R, REGISTRY, query  # noqa: F401
from .tables import table


def _r(c, digits: int = R):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def _events_daily(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), "user_id", "event_type", "value")


# ----------------------------------------------------------------- panel
@query("risk_panel")
def risk_panel(spark, sf_dir):
    """Flagship: events -> zone x date panel with rolling features and the
    forward 14-day label."""
    ev = table(spark, sf_dir, "events")
    out = P.build_panel(ev, "ts", "user_id", F.col("event_type") == "error", "value")
    return out.select("date", "user_id", "active_zones", _r("active_roll2w").alias("active_roll2w"),
                      _r("active_roll4w").alias("active_roll4w"),
                      _r("value_sum").alias("value_sum"),
                      _r("value_roll2w_log").alias("value_roll2w_log"),
                      _r("value_roll4w_log").alias("value_roll4w_log"),
                      "active_cluster_overlap", "label")


@query("panel_spine")
def panel_spine(spark, sf_dir):
    ev = _events_daily(spark, sf_dir)
    return P.spine(ev, "date", None, "user_id")


@query("rolling_active")
def rolling_active(spark, sf_dir):
    ev = _events_daily(spark, sf_dir)
    daily = P.daily_distinct(ev, "date", "user_id", "active_users")
    out = P.rolling_mean_rows(daily, "date", "active_users",
                              {"active_roll2w": 14, "active_roll4w": 28})
    return out.select("date", "active_users", _r("active_roll2w").alias("active_roll2w"),
                      _r("active_roll4w").alias("active_roll4w"))


@query("rolling_recent_log")
def rolling_recent_log(spark, sf_dir):
    ev = _events_daily(spark, sf_dir)
    daily = P.daily_sum(ev, "date", "value", "value_sum")
    out = P.rolling_mean_rows(daily, "date", "value_sum",
                              {"recent_roll2w_log": 14, "recent_roll4w_log": 28}, log1p=True)
    return out.select("date", _r("value_sum").alias("value_sum"),
                      _r("recent_roll2w_log").alias("recent_roll2w_log"),
                      _r("recent_roll4w_log").alias("recent_roll4w_log"))


@query("forward_label")
def forward_label(spark, sf_dir):
    """Spine x error flag -> forward 14-day label, from the pinned zone-day
    table (events read once)."""
    from ..session import cut_lineage
    ev = table(spark, sf_dir, "events")
    zd = cut_lineage(P.zone_day(ev, F.to_date("ts"), "user_id", "value",
                                F.col("event_type") == "error"))
    sp = P.spine(zd, "date", None, "user_id")
    hits = zd.where(F.col("hit") == 1).select("date", "user_id")
    return P.overlap_and_label(sp, hits, "user_id", "date", 14, "overlap", "label")


@query("rainfall_lags")
def rainfall_lags(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"),
                                                 "l_quantity")
    daily = P.daily_mean(li, "date", "l_quantity", "qty_mean")
    out = P.rolling_mean_rows(daily, "date", "qty_mean",
                              {"lag1w": 7, "lag2w": 14, "lag4w": 28})
    return out.select("date", *[_r(c).alias(c) for c in ("qty_mean", "lag1w", "lag2w", "lag4w")])


@query("latest_nonnull")
def latest_nonnull(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_type",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value"))
        .alias("value"))
    return P.latest_nonnull(ev, "user_id", "ts", ["event_type", "value"])


# Register the other plan modules (import for side effects).
from . import q_clean, q_metrics, q_drift, q_spatial, q_serving, q_ml, q_stream, q_io, q_ext, q_more, q_gold, q_variants, q_sources, q_scored, q_silver  # noqa: E402,F401
