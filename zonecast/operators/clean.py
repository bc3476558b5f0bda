"""Cleaning operators: rule chains with an audit, keep-first de-duplication,
projections and row filters (P9, P10, P12-P14, F1-F10, W10, A27)."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import row_sum

# Fixed values (must equal the reference's): non-residential zone keywords
# (substring match on the upper-cased name), the inclusive latitude/longitude
# box for valid points, and the elderly age-band columns.
NON_RESIDENTIAL_KEYWORDS = (
    "AIRPORT", "PORT", "RESERVOIR", "STRAIT", "SEA",
    "ISLAND", "SOUTHERN ISLANDS", "JURONG ISLAND",
    "NORTH-EASTERN ISLANDS", "SEMAKAU",
)
LAT_RANGE = (1.15, 1.48)
LON_RANGE = (103.6, 104.1)
ELDERLY_COLS = ("age_65_69", "age_70_74", "age_75_79", "age_80_84", "age_85_89", "age_90_over")


def clean_rules(df: DataFrame, rules: Sequence[tuple[str, Column]],
                kept_label: str = "kept") -> tuple[DataFrame, DataFrame]:
    """Apply keep-rules in order.  Returns ``(kept, audit)`` where ``audit``
    has one row per rule with the number of rows it dropped (first failing
    rule wins; a null predicate counts as failing), plus the kept count
    (A27, F1-F6).  One pass, one small grouped aggregate."""
    reason = None
    for name, keep in rules:
        fail = ~F.coalesce(keep, F.lit(False))
        reason = F.when(fail, F.lit(name)) if reason is None else reason.when(fail, F.lit(name))
    reason = F.lit(kept_label) if reason is None else reason.otherwise(F.lit(kept_label))
    tagged = df.withColumn("_rule", reason)
    # kept rows: the plain conjunction (a null predicate drops the row), which
    # Catalyst can push into the scan, unlike a filter on the label
    keep_all = None
    for _, keep in rules:
        keep_all = keep if keep_all is None else (keep_all & keep)
    kept = df.where(keep_all) if keep_all is not None else df
    audit = tagged.groupBy(F.col("_rule").alias("rule")).agg(F.count(F.lit(1)).alias("n_rows"))
    return kept, audit


def in_box(lat: str, lon: str, lat_range: tuple[float, float],
           lon_range: tuple[float, float]) -> Column:
    """Inclusive bounding box."""
    return F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range)


def excludes_keywords(c: str | Column, keywords: Iterable[str] = NON_RESIDENTIAL_KEYWORDS) -> Column:
    """True when none of the keywords occurs as a substring."""
    col = F.col(c) if isinstance(c, str) else c
    hit = None
    for k in keywords:
        h = F.contains(col, F.lit(k))
        hit = h if hit is None else (hit | h)
    return ~F.coalesce(hit, F.lit(False)) if hit is not None else F.lit(True)


def dedup_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key by ``order`` (W10); null keys compare
    equal.  Expressed as ``min_by`` over a struct, a partial aggregate, so a
    hot key is reduced map-side instead of sorted in one task."""
    others = [c for c in df.columns if c not in key]
    ordk = F.struct(*[F.col(c) for c in order])
    packed = F.struct(*[F.col(c) for c in others])
    return (df.groupBy(*key).agg(F.min_by(packed, ordk).alias("_row"))
            .select(*key, *[F.col(f"_row.{c}").alias(c) for c in others])
            .select(*df.columns))


def drop_matching(df: DataFrame, tokens: Iterable[str]) -> DataFrame:
    """Drop columns whose name contains any token."""
    toks = list(tokens)
    return df.drop(*[c for c in df.columns if any(t in c for t in toks)])


def project(df: DataFrame, spec: Mapping[str, str | Column]) -> DataFrame:
    """Select/rename/reorder: ``{out_name: source column or expression}`` (P10)."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in spec.items()])


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null -> 0 on the listed columns."""
    return df.fillna(0, subset=list(cols))


def share(df: DataFrame, parts: Sequence[str], total: str, part_name: str,
          share_name: str, digits: int = 4, half_even: bool = False) -> DataFrame:
    """Row-wise sum of the part columns that exist, and its share of
    ``total`` rounded (P13, P14).  ``half_even`` rounds like pandas
    (``bround``); the default half-up matches the SQL oracle."""
    present = [c for c in parts if c in df.columns]
    out = df.withColumn(part_name, row_sum(present) if present else F.lit(0))
    rnd = F.bround if half_even else F.round
    return out.withColumn(share_name, rnd(F.try_divide(F.col(part_name), F.col(total)), digits))


def min_support(df: DataFrame, by: Sequence[str], n: int = 10) -> DataFrame:
    """Keep only groups with at least ``n`` non-null rows."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n)
    return df.join(counts.select(*by), list(by), "left_semi")


def trailing(df: DataFrame, ts: str, days: int, ref) -> DataFrame:
    """Rows with ``ts`` in the last ``days`` days up to the reference time
    (F9); ``ref`` is a parameter, never ``now()``, so runs repeat."""
    at = F.lit(ref).cast("timestamp")
    return df.where((F.col(ts) >= at - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col(ts) <= at))


def above(df: DataFrame, col: str, t: float = 0.5) -> DataFrame:
    """Rows with score at/above a threshold."""
    return df.where(F.col(col) >= F.lit(t))


def search(df: DataFrame, tier_col: str, tier: str, name_col: str, text: str,
           order: Sequence[str] = ("High", "Medium", "Low")) -> DataFrame:
    """Cumulative tier filter (Medium shows High+Medium) and case-insensitive
    name contains (F8)."""
    allowed = list(order[: list(order).index(tier) + 1])
    return df.where(F.col(tier_col).isin(allowed)
                    & F.lower(F.col(name_col)).contains(text.lower()))


def impute_group_mean(df: DataFrame, group: str, col: str, out: str | None = None) -> DataFrame:
    """Fill nulls of ``col`` with the mean of its group (D7); rows without a
    group are one group.  The group means are a partial aggregate joined back
    (one row per group), so a group holding a third of all rows is not sent to
    one task."""
    means = df.groupBy(F.col(group).alias("_group")).agg(F.avg(col).alias("_gmean"))
    return df.join(means, F.col(group).eqNullSafe(F.col("_group")), "left").withColumn(
        out or col, F.coalesce(F.col(col).cast("double"), F.col("_gmean"))).drop("_gmean", "_group")
