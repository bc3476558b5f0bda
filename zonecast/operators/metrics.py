"""Classification metrics as Spark jobs.

Every curve metric starts from one row per (group, distinct score) with the
positive and negative counts -- a partial aggregate, so a hot score value is
combined map-side.  Running counts over the score order come from
``ordering.prefix_sums`` (range partitions + broadcast partition offsets), so
no step puts all scores of a group into one task.

Groups (``by``) are metadata such as model x split; their number is small.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import numpy_bin
from .ordering import prefix_sums
from ..session import cut_lineage

DELTAS = (-0.05, -0.02, 0.0, 0.02, 0.05)   # fixed: threshold sensitivity offsets
SWEEP = (0.01, 0.99, 200)                   # fixed: sweep grid lo, hi, points


def _zdiv(a: Column, b: Column) -> Column:
    """a / b with zero (or null) denominator -> 0 (sklearn zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, score: str, label: str, threshold: float | Column = 0.5,
                   by: Sequence[str] = (), beta: float = 2.0, digits: int = 4,
                   single_class_zero: bool = True) -> DataFrame:
    """Confusion counts at ``score >= threshold`` and precision / recall /
    F1 / F-beta (zero division -> 0), rounded (A10, A11).  ``threshold`` may
    be a column, the same for all rows of a group (a threshold per model).

    ``single_class_zero`` keeps the reference's behaviour when only one
    class occurs among labels and predictions: all four counts are 0."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col(score) >= cut
    y = F.col(label) == 1
    g = df.groupBy(*by) if by else df.groupBy()
    a = g.agg(F.max(cut).alias("threshold"), F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
              F.count_if(~pred & ~y).alias("tn"), F.count_if(~pred & y).alias("fn"),
              F.count(F.lit(1)).alias("n_rows"), F.count_if(y).alias("n_positive"))
    if single_class_zero:
        has1 = (F.col("tp") + F.col("fp") + F.col("fn")) > 0
        has0 = (F.col("tn") + F.col("fp") + F.col("fn")) > 0
        one = ~(has1 & has0)
        for c in ("tp", "fp", "tn", "fn"):
            a = a.withColumn(c, F.when(one, F.lit(0).cast("long")).otherwise(F.col(c)))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    b2 = float(beta) ** 2

    def fbeta(bb: float) -> Column:
        return _zdiv(F.lit(1.0 + bb) * tp, F.lit(bb) * (tp + fn) + (tp + fp))

    if not isinstance(threshold, Column):
        a = a.withColumn("threshold", F.lit(float(threshold)))  # also where there are no rows
    return a.select(*by, "threshold", "n_rows", "n_positive",
                    "tp", "fp", "tn", "fn",
                    F.round(_zdiv(tp, tp + fp), digits).alias("precision"),
                    F.round(_zdiv(tp, tp + fn), digits).alias("recall"),
                    F.round(fbeta(1.0), digits).alias("f1"),
                    F.round(fbeta(b2), digits).alias("f_beta"))


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, distinct score): positives and negatives."""
    y = (F.col(label) == 1)
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*by, score).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))


def attach_totals(df: DataFrame, totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach per-group totals: a counted (then broadcast) lookup per group,
    or literal scalars from the single row when there is no grouping."""
    if by:
        return df.join(totals, list(by), "left")
    row = totals.first()
    out = df
    for k, v in (row.asDict() if row is not None else {}).items():
        out = out.withColumn(k, F.lit(v))
    return out


def curve_points(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Per (group, distinct score s): pos, neg, tp = positives with score >= s,
    fp = negatives with score >= s, and the group totals P, N (W12)."""
    sc = score_counts(df, score, label, by)
    cum = prefix_sums(sc, [F.col(score).desc()], ["pos", "neg"], by)
    return (cum.withColumnRenamed("pos_cum", "tp").withColumnRenamed("neg_cum", "fp")
               .withColumnRenamed("pos_tot", "P").withColumnRenamed("neg_tot", "N"))


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC with tied scores sharing rank (A12):
    sum_s pos_s * (negatives below s + neg_s / 2) / (P * N); null when a
    group has a single class."""
    cp = curve_points(df, score, label, by)
    num = F.sum(F.col("pos") * (F.col("N") - F.col("fp")) + F.lit(0.5) * F.col("pos") * F.col("neg"))
    g = cp.groupBy(*by, "P", "N")
    return g.agg(num.alias("_num")).select(
        *by, F.try_divide(F.col("_num"), F.col("P").cast("double") * F.col("N")).alias("auc"))


def average_precision(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Average precision, step-wise: sum over distinct scores of
    (recall gain) x precision (A13) -- not the trapezoid area."""
    cp = curve_points(df, score, label, by)
    term = F.col("pos") / F.col("P") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return cp.where(F.col("P") > 0).groupBy(*by).agg(F.sum(term).alias("avg_precision"))


def rank_metrics(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC and average precision from one curve (A12, A13): both are null
    where a group lacks a class they need."""
    cp = curve_points(df, score, label, by)
    area = F.sum(F.col("pos") * (F.col("N") - F.col("fp")) + F.lit(0.5) * F.col("pos") * F.col("neg"))
    gain = F.sum(F.try_divide("pos", "P") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    return cp.groupBy(*by, "P", "N").agg(area.alias("_area"), gain.alias("avg_precision")).select(
        *by, F.try_divide(F.col("_area"), F.col("P").cast("double") * F.col("N")).alias("auc"), "avg_precision")


def pr_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score used as threshold."""
    cp = curve_points(df, score, label, by)
    return cp.select(*by, F.col(score).alias("threshold"),
                     _zdiv(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                     F.when(F.col("P") == 0, F.lit(1.0))
                     .otherwise(F.col("tp") / F.col("P")).alias("recall"))


def pick_threshold(curve: DataFrame, recall_target: float = 0.80,
                   by: Sequence[str] = ()) -> DataFrame:
    """Highest precision among points with recall >= target, lowest threshold
    on ties; if none qualifies, the point with recall closest to the target
    (lowest threshold on ties) (A15).  Two partial aggregates."""
    pt = F.struct("threshold", "precision", "recall")
    meets = F.col("recall") >= F.lit(recall_target)
    best = F.min_by(F.when(meets, pt), F.when(meets, F.struct(F.negative("precision"), "threshold")))
    near = F.min_by(pt, F.struct(F.abs(F.col("recall") - F.lit(recall_target)), F.col("threshold")))
    g = curve.groupBy(*by) if by else curve.groupBy()
    out = g.agg(best.alias("_b"), near.alias("_n"))
    pick = F.coalesce("_b", "_n")
    return out.select(*by, pick["threshold"].alias("threshold"),
                      pick["precision"].alias("precision"), pick["recall"].alias("recall"),
                      F.col("_b").isNotNull().alias("meets_target"))


def sensitivity(df: DataFrame, score: str, label: str, threshold: float,
                deltas: Sequence[float] = DELTAS, by: Sequence[str] = (),
                digits: int = 4) -> DataFrame:
    """Recall / precision at threshold + delta, clipped to [0, 1] (A16).  One
    aggregation pass with a pair of conditional counts per delta, then one
    row per delta."""
    y = F.col(label) == 1
    ts = [min(max(threshold + d, 0.0), 1.0) for d in deltas]
    aggs = [F.count_if(y).alias("_P")]
    for i, t in enumerate(ts):
        p = F.col(score) >= F.lit(t)
        aggs += [F.count_if(p & y).alias(f"_tp{i}"), F.count_if(p).alias(f"_pp{i}")]
    g = (df.groupBy(*by) if by else df.groupBy()).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(round(d, 4)).alias("delta"),
                              F.lit(round(t, 4)).alias("threshold"),
                              F.round(_zdiv(F.col(f"_tp{i}"), F.col("_P")), digits).alias("recall"),
                              F.round(_zdiv(F.col(f"_tp{i}"), F.col(f"_pp{i}")), digits)
                              .alias("precision"))
                     for i, (d, t) in enumerate(zip(deltas, ts))])
    return g.select(*by, F.inline(rows))


def grid_threshold(i: Column, lo: float, hi: float, n: int) -> Column:
    """Grid point i of numpy ``linspace(lo, hi, n)``: i * step + lo, the last
    point exactly ``hi``."""
    step = (hi - lo) / (n - 1)
    return F.when(i == n - 1, F.lit(float(hi))).otherwise(
        i.cast("double") * F.lit(step) + F.lit(float(lo)))


def sweep(df: DataFrame, score: str, label: str, lo: float = SWEEP[0], hi: float = SWEEP[1],
          n: int = SWEEP[2], by: Sequence[str] = ()) -> DataFrame:
    """Precision / recall at each point of a fixed threshold grid (A17); no
    predicted positive -> precision 1, recall 0.

    Scores are reduced to counts per grid cell (cell = number of grid points
    <= score, found arithmetically and corrected against the exact grid
    values), so the work is one pass plus n rows per group -- no per-row
    fan-out over the grid."""
    step = (hi - lo) / (n - 1)
    s = F.col(score)
    b0 = F.floor((s - F.lit(lo)) / F.lit(step)).cast("int")
    cell = (b0 + 1
            - F.when(grid_threshold(b0, lo, hi, n) > s, 1).otherwise(0)
            + F.when(grid_threshold(b0 + 1, lo, hi, n) <= s, 1).otherwise(0))
    cell = F.when(s < F.lit(lo), 0).when(s >= F.lit(hi), n).otherwise(
        F.least(F.greatest(cell, F.lit(0)), F.lit(n)))
    y = F.col(label) == 1
    counts = (df.where(s.isNotNull()).withColumn("_cell", cell)
              .groupBy(*by, "_cell").agg(F.count_if(y).alias("_pos"),
                                          F.count(F.lit(1)).alias("_all")))
    # at most (n + 1) rows per group: pinned once so the grid, the totals and
    # the running sums below do not each rescan the scored table
    counts = cut_lineage(counts)
    groups = counts.select(*by).distinct() if by else None
    grid_src = groups if by else counts.sparkSession.range(1).select()
    grid = grid_src.select(*by, F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_cell"))
    full = grid.join(counts, [*by, "_cell"], "left").fillna(0, ["_pos", "_all"])
    # rows with cell >= i+1 are predicted positive at grid point i (cell i+1)
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(F.col("_cell").desc()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    tot = counts.groupBy(*by).agg(F.sum("_pos").alias("_P")) if by else \
        counts.agg(F.sum("_pos").alias("_P"))
    cum = full.withColumn("_tp", F.sum("_pos").over(w)).withColumn("_pp", F.sum("_all").over(w))
    cum = attach_totals(cum, tot, by)
    idx = F.col("_cell") - 1
    return cum.select(*by, idx.alias("i"), grid_threshold(idx, lo, hi, n).alias("threshold"),
                      F.when(F.col("_pp") == 0, F.lit(1.0))
                      .otherwise(F.col("_tp") / F.col("_pp")).alias("precision"),
                      F.when(F.col("_pp") == 0, F.lit(0.0))
                      .otherwise(_zdiv(F.col("_tp"), F.col("_P"))).alias("recall"))


def label_correlation(df: DataFrame, cols: Sequence[str], label: str,
                      by: Sequence[str] = ()) -> DataFrame:
    """Pearson (point-biserial) r of each feature with the label; zero
    variance -> 0; ranked by |r| descending, feature order on ties (A18, T3).
    One aggregation pass with ``covar_pop``/``stddev_pop`` (no division by
    zero under ANSI), then one row per feature."""
    y = F.col(label).cast("double")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.covar_pop(x, y).alias(f"_cv_{c}"), F.stddev_pop(x).alias(f"_sx_{c}")]
    aggs.append(F.stddev_pop(y).alias("_sy"))
    g = (df.groupBy(*by) if by else df.groupBy()).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("_pos"),
                              F.when((F.col(f"_sx_{c}") == 0) | (F.col("_sy") == 0), F.lit(0.0))
                              .otherwise(F.try_divide(F.col(f"_cv_{c}"),
                                                      F.col(f"_sx_{c}") * F.col("_sy")))
                              .alias("r")) for i, c in enumerate(cols)])
    long = g.select(*by, F.inline(rows))
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(
        F.abs("r").desc(), F.col("_pos"))
    return long.withColumn("rank", F.row_number().over(w).cast("long")).drop("_pos")


def histogram(df: DataFrame, col: str, lo, hi, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts over n equal bins on [lo, hi], numpy edges, last bin closed,
    out-of-range values dropped, empty bins kept (A19)."""
    b = numpy_bin(col, lo, hi, n)
    counts = df.withColumn("bin", b).where(F.col("bin").isNotNull()) \
        .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count"))
    src = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    grid = src.select(*by, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("bin"))
    return grid.join(counts, [*by, "bin"], "left").fillna(0, ["count"])
