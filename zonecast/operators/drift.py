"""Distribution drift and the retrain decision.

PSI/CSI reduce both sides to bin counts with partial aggregation (one row
per group x side x bin), so the shuffle is tiny whatever the input size.
Many features are handled in one pass by unpivoting to (feature, value)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import CSI_ALARM, PSI_ALARM, numpy_bin, psi_flag

EMPTY_SHARE = 1e-4            # fixed: share used for an empty bin
RANK_SHIFT_ALARM = 3          # fixed: attribution rank moves more than 3 places
MAGNITUDE_ALARM = 0.50        # fixed: attribution magnitude changes more than 50 %
RECALL_GATE = 0.70            # fixed: promotion gate, test recall floor
OOT_DROP_LIMIT = 0.10         # fixed: promotion gate, test - oot recall
AUC_GATE = 0.75               # fixed: promotion gate, test AUC floor


def _sides(base: DataFrame, cur: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    b = base.select(*by, F.col(col).cast("double").alias("x"), F.lit("e").alias("side"))
    c = cur.select(*by, F.col(col).cast("double").alias("x"), F.lit("a").alias("side"))
    return b.unionByName(c)


def psi_long(both: DataFrame, bins: int = 10, bounds: tuple[float, float] | None = (0.0, 1.0),
             by: Sequence[str] = (), drop_nulls: bool = False, min_rows: int = 0,
             digits: int = 4) -> DataFrame:
    """PSI from a long table (by..., side in {'e','a'}, x).

    ``bounds`` fixed -> numpy-style equal bins on it, out-of-range values
    counted in the side total but not in any bin (A20); ``bounds=None`` ->
    bins span min..max of both sides per group (A21).  Empty bin share ->
    1e-4; psi = sum (a - e) * ln(a / e), rounded.  Groups with fewer than
    ``min_rows`` values on a side (or a missing side) are skipped (F10).

    The source is counted per group x side x bin with map-side partial
    aggregation: one pass for fixed bounds.  Bins over a group's range need the
    ranges first; they are joined back as data (a single range, without
    groups, as two scalars).  Then one row per group holds all its bin counts,
    so any number of groups runs."""
    src = both.where(F.col("x").isNotNull()) if drop_nulls else both
    lo = hi = None
    if bounds is not None:
        lo, hi = F.lit(float(bounds[0])), F.lit(float(bounds[1]))
    elif not by:
        r = src.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
        lo, hi = F.lit(r["lo"]).cast("double"), F.lit(r["hi"]).cast("double")
    else:
        spans = src.groupBy(*[F.col(b).alias(f"_b_{b}") for b in by]).agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"))
        same = F.lit(True)
        for b in by:
            same = same & F.col(b).eqNullSafe(F.col(f"_b_{b}"))
        src, lo, hi = src.join(spans, same).drop(*[f"_b_{b}" for b in by]), F.col("_lo"), F.col("_hi")
    counts = src.select(*by, "side", numpy_bin("x", lo, hi, bins).alias("bin")).groupBy(*by, "side", "bin").agg(F.count(F.lit(1)).alias("_c"))

    def total(side: str, k: int | None = None):
        mine = (F.col("side") == side) & (F.lit(True) if k is None else F.col("bin") == k)
        return F.coalesce(F.sum(F.when(mine, F.col("_c"))), F.lit(0))

    g = counts.groupBy(*by) if by else counts.groupBy()
    wide = g.agg(*[total(s).alias(f"_{s}") for s in "ea"], *[total(s, k).alias(f"_{s}{k}") for s in "ea" for k in range(bins)])
    wide = wide.where((F.least("_e", "_a") > 0) & (F.least("_e", "_a") >= min_rows))

    def share(side: str, k: int):
        return F.when(F.col(f"_{side}{k}") == 0, F.lit(EMPTY_SHARE)).otherwise(F.col(f"_{side}{k}") / F.col(f"_{side}"))

    terms = [(share("a", k) - share("e", k)) * F.log(share("a", k) / share("e", k)) for k in range(bins)]
    out = wide.select(*by, F.round(sum(terms[1:], terms[0]), digits).alias("psi"))
    return out.withColumn("flag", psi_flag("psi"))


def psi(base: DataFrame, cur: DataFrame, col: str, bins: int = 10,
        bounds: tuple[float, float] | None = (0.0, 1.0), by: Sequence[str] = ()) -> DataFrame:
    """Score PSI between a baseline and a current frame."""
    return psi_long(_sides(base, cur, col, by), bins, bounds, by)


def csi(base: DataFrame, cur: DataFrame, cols: Sequence[str], bins: int = 10,
        min_rows: int = 10, alarm: float = CSI_ALARM) -> DataFrame:
    """Per-feature PSI over data-range bins, nulls dropped, features with
    fewer than ``min_rows`` values on a side skipped, flagged and alarmed
    (A22, U8, F10).  All features in one pass via unpivot."""
    def long(df, side):
        cast = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
        return cast.unpivot([], list(cols), "feature", "x").withColumn("side", F.lit(side))
    both = long(base, "e").unionByName(long(cur, "a"))
    out = psi_long(both, bins, None, ["feature"], drop_nulls=True, min_rows=min_rows)
    return out.withColumnRenamed("psi", "csi").withColumn("alarm", F.col("csi") > F.lit(alarm))


def drift_alarm(score_psi: DataFrame, csi_table: DataFrame, action: str = "retrain_requested") -> DataFrame:
    """One drift-alarm log row (K6, U12): score PSI, its flag, the per-feature
    CSI results as a JSON object ``{feature: {csi, flag}}`` (the reference's
    JSONB column, built with ``map_from_entries`` + ``to_json``) and the
    action.  Both inputs are small (one row; one row per feature)."""
    entries = F.array_sort(F.collect_list(F.struct("feature", F.struct("csi", "flag"))))
    js = csi_table.agg(F.to_json(F.map_from_entries(entries))).first()[0] or "{}"
    return score_psi.select("psi", F.col("flag").alias("psi_flag"), F.lit(js).alias("csi_json"),
                            F.lit(action).alias("action"))


def ranked_importance(df: DataFrame, feature: str = "feature", value: str = "importance",
                      order: str | None = None) -> DataFrame:
    """Rank features by importance descending; ties keep the listed order
    (``order`` column) or the feature name (W8).  One row per feature."""
    tie = F.col(order) if order else F.col(feature)
    return df.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col(value).desc(), tie)).cast("long"))


def attribution_drift(base: DataFrame, cur: DataFrame, feature: str = "feature",
                      value: str = "importance", order: str | None = None,
                      rank_alarm: int = RANK_SHIFT_ALARM,
                      magnitude_alarm: float = MAGNITUDE_ALARM) -> DataFrame:
    """Per feature: baseline/current rank and magnitude, rank shift,
    relative magnitude change and alarms (M8, W8, J12).  Input tables hold
    one row per feature (bounded by the feature count)."""
    keep = [feature, value] + ([order] if order else [])
    b = ranked_importance(base.select(*keep), feature, value, order).select(
        feature, F.col(value).alias("baseline_value"), F.col("rank").alias("baseline_rank"),
        *([F.col(order)] if order else []))
    c = ranked_importance(cur.select(*keep), feature, value, order).select(
        feature, F.col(value).alias("current_value"), F.col("rank").alias("current_rank"))
    j = b.join(c, feature, "inner")
    rel = F.abs(F.col("current_value") - F.col("baseline_value")) / (F.col("baseline_value") + F.lit(1e-9))
    out = (j.withColumn("rank_shift", F.abs(F.col("current_rank") - F.col("baseline_rank")))
            .withColumn("magnitude_change_pct", F.round(rel * 100, 1))
            .withColumn("rank_alarm", F.col("rank_shift") > rank_alarm)
            .withColumn("magnitude_alarm", rel > F.lit(magnitude_alarm)))
    return out.drop(order) if order else out


def attribution_summary(detail: DataFrame) -> DataFrame:
    """One row: alarmed feature count, top feature each side, whether the
    top feature changed, all_ok (M8)."""
    return detail.agg(
        F.count_if(F.col("rank_alarm") | F.col("magnitude_alarm")).alias("n_alarmed"),
        F.min_by("feature", "baseline_rank").alias("top_feature_baseline"),
        F.min_by("feature", "current_rank").alias("top_feature_current"),
    ).withColumn("top_feature_changed", F.col("top_feature_baseline") != F.col("top_feature_current")) \
     .withColumn("all_ok", (F.col("n_alarmed") == 0) & ~F.col("top_feature_changed"))


def retrain_decision(score_psi: DataFrame, attribution: DataFrame,
                     quality: DataFrame | None = None, alarm: float = PSI_ALARM) -> DataFrame:
    """Retrain only when score PSI > alarm AND attribution drifted; PSI alone
    warns; a failed data-quality check only warns (M9).  The attribution
    and quality inputs are one-row summaries (``all_ok``, ``all_pass``),
    read as scalars."""
    ok = attribution.agg(F.min(F.col("all_ok").cast("int"))).first()[0]
    dq = quality.agg(F.min(F.col("all_pass").cast("int"))).first()[0] if quality is not None else 1
    stable = ok is None or ok == 1
    p = score_psi.agg(F.max("psi").alias("psi"))
    shifted = F.col("psi") > F.lit(alarm)
    return p.select(
        "psi", psi_flag("psi").alias("psi_flag"), F.lit(stable).alias("attribution_stable"),
        (shifted & F.lit(not stable)).alias("retrain_triggered"),
        (shifted & F.lit(stable)).alias("psi_warning"),
        F.lit(dq == 0).alias("data_quality_warning"))


def promotion_gate(test: DataFrame, oot: DataFrame, importance_rows: int,
                   recall_gate: float = RECALL_GATE, drop_limit: float = OOT_DROP_LIMIT,
                   auc_gate: float = AUC_GATE, require_importance: bool = True) -> DataFrame:
    """Promotion gate (M6) from one-row metric frames with ``recall`` and
    ``auc``: test recall >= gate, signed test-oot recall drop <= limit (a
    gain passes), test AUC >= gate, importances present; all must pass.
    ``require_importance=False`` is the notebook's three-rule gate."""
    if not require_importance:
        importance_rows = max(importance_rows, 1)
    recall_oot = oot.agg(F.max("recall")).first()[0]
    j = test.select(F.col("recall").alias("recall_test"), F.col("auc").alias("auc_test"),
                    F.lit(recall_oot).cast("double").alias("recall_oot"))
    drop = F.col("recall_test") - F.col("recall_oot")
    checks = j.select(
        "recall_test", "recall_oot", "auc_test", drop.alias("oot_drop"),
        (F.col("recall_test") >= recall_gate).alias("recall_pass"),
        F.coalesce(drop <= drop_limit, F.lit(False)).alias("oot_drop_pass"),
        (F.col("auc_test") >= auc_gate).alias("auc_pass"),
        F.lit(importance_rows > 0).alias("importance_pass"))
    return checks.withColumn("promote", F.col("recall_pass") & F.col("oot_drop_pass")
                             & F.col("auc_pass") & F.col("importance_pass"))
