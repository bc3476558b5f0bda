"""Global order without a single-task window.

A window with ``orderBy`` but no ``partitionBy`` moves every row into one
task.  ``global_index`` instead range-partitions on the full order key
(Spark's range partitioner samples the composite key, so a hot leading value
is spread over several partitions by the tie-breaker), numbers rows inside
each partition, pins that layout with a reliable checkpoint, and adds the
row counts of all earlier partitions (one row per partition, broadcast).

Top-k and sampling (T2, T4, T6) use ``orderBy().limit()``: Spark plans that
as TakeOrderedAndProject, a per-partition top-k followed by a merge of k
rows per partition -- no full sort and no single-task window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _default_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_index(df: DataFrame, order: Sequence[Column], name: str = "_idx",
                 partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the total order ``order`` (which must
    be a strict order, i.e. end with a unique tie-breaker)."""
    n = partitions or _default_parts(df)
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    pid = F.spark_partition_id()
    tagged = (ordered.withColumn("_pid", pid)
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(pid.cast("long"), 33)))
    tagged = cut_lineage(tagged)
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the window below is bounded by the partition count
    offs = sizes.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_off"))
    return (tagged.join(F.broadcast(offs), "_pid")
            .withColumn(name, F.col("_off") + F.col("_local"))
            .drop("_pid", "_local", "_off"))


def prefix_sums(df: DataFrame, order: Sequence[Column], cols: Sequence[str],
                by: Sequence[str] = (), suffix: str = "_cum",
                partitions: int | None = None) -> DataFrame:
    """Running sums of ``cols`` in the order ``order`` (inclusive of the
    current row), optionally restarting per ``by`` group; ``<col>_tot``
    carries the group total.

    The rows are range-partitioned on (by, order) and summed per partition, so
    a hot group is spread over partitions.  Only groups that go on beyond a
    partition need other partitions' totals: each partition has at most two of
    them, so the broadcast table has at most two rows per partition, however
    many groups there are.  Null ``by`` values are a group."""
    n = partitions or _default_parts(df)
    keys = [F.col(b) for b in by]
    ordered = df.repartitionByRange(n, *keys, *order)
    tagged = cut_lineage(ordered.withColumn("_pid", F.spark_partition_id()))
    w_all_in = Window.partitionBy("_pid", *by)
    w_in = w_all_in.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = tagged
    for c in cols:
        local = local.withColumn(c + "_loc", F.sum(c).over(w_in)).withColumn(c + "_own", F.sum(c).over(w_all_in))
    part_tot = tagged.groupBy("_pid", *by).agg(*[F.sum(c).alias(c + "_pt") for c in cols])
    # one row per partition x group: a group's window is bounded by the partition count
    w_off = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*by)
    offs = part_tot.select(F.col("_pid").alias("_opid"), *[F.col(x).alias(f"_o_{x}") for x in by],
                           F.count(F.lit(1)).over(w_all).alias("_parts"),
                           *[F.coalesce(F.sum(c + "_pt").over(w_off), F.lit(0)).alias(c + "_off")
                             for c in cols],
                           *[F.sum(c + "_pt").over(w_all).alias(c + "_tot") for c in cols]).where("_parts > 1")
    same = F.col("_pid") == F.col("_opid")
    for x in by:
        same = same & F.col(x).eqNullSafe(F.col(f"_o_{x}"))
    out = local.join(F.broadcast(offs), same, "left")
    for c in cols:
        out = out.withColumn(c + suffix, F.col(c + "_loc") + F.coalesce(c + "_off", F.lit(0))) \
            .withColumn(c + "_tot", F.coalesce(c + "_tot", c + "_own")).drop(c + "_loc", c + "_off", c + "_own")
    return out.drop("_pid", "_opid", "_parts", *[f"_o_{x}" for x in by])


def ranked(df: DataFrame, score: str, key: str, name: str = "rank") -> DataFrame:
    """Rank 1..n by score descending, unique, ties broken by key."""
    idx = global_index(df, [F.col(score).desc_nulls_last(), F.col(key).asc()], "_i")
    return idx.withColumn(name, F.col("_i") + 1).drop("_i")


def top_k(df: DataFrame, col: str, k: int, where: Column | None = None,
          tiebreak: str | None = None) -> DataFrame:
    """Top-k by a column, optional filter."""
    src = df.where(where) if where is not None else df
    order = [F.col(col).desc_nulls_last()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return src.orderBy(*order).limit(k)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Repeatable sample of at most n rows without replacement (T6): the n
    smallest md5 hashes of key and seed, a per-partition top-n merge."""
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def running_best(df: DataFrame, order: str, col: str, name: str = "best_so_far",
                 by: Sequence[str] = ()) -> DataFrame:
    """Cumulative max (W9); input is one row per trial, bounded."""
    base = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    return df.withColumn(name, F.max(col).over(base.rowsBetween(Window.unboundedPreceding, 0)))


def best_row(df: DataFrame, col: str, tiebreak: str, by: Sequence[str] = ()) -> DataFrame:
    """Row with the highest ``col``, first ``tiebreak`` on ties (T7), as a
    partial aggregate (``max_by`` on a struct)."""
    others = [c for c in df.columns if c not in by]
    ordk = F.struct(F.negative(F.col(col)), F.col(tiebreak))
    agg = F.min_by(F.struct(*others), ordk).alias("_r")
    grouped = df.groupBy(*by).agg(agg) if by else df.agg(agg)
    return grouped.select(*by, *[F.col(f"_r.{c}").alias(c) for c in others])


def median_by(df: DataFrame, col: str, by: Sequence[str] = (), name: str = "median",
              partitions: int | None = None) -> DataFrame:
    """Exact median per group (A33), null for a group without values.

    Rank selection: rows are reduced to counts per value (a partial
    aggregate), the counts are summed in value order over range partitions,
    and the one or two middle ranks pick their values.  No task holds a
    group's values, however many distinct ones there are."""
    x = F.col(col).cast("double")
    counts = df.select(*by, x.alias("_x")).groupBy(*by, "_x").agg(F.count("_x").alias("_n"))  # 0 for the null value
    ranks = prefix_sums(counts, [F.col("_x").asc_nulls_first()], ["_n"], by, partitions=partitions)
    first, last = F.col("_n_cum") - F.col("_n"), F.col("_n_cum")

    def at(rank: Column) -> Column:
        return F.max(F.when((first < rank) & (rank <= last), F.col("_x")))

    lower, upper = F.floor((F.col("_n_tot") + 1) / 2), F.floor(F.col("_n_tot") / 2) + 1
    g = ranks.groupBy(*by) if by else ranks.groupBy()
    return g.agg(((at(lower) + at(upper)) / 2).alias(name))


def nearest_point(curve: DataFrame, col: str, x: float, by: Sequence[str] = ()) -> DataFrame:
    """Curve row whose ``col`` is nearest to ``x`` (T5), first on ties by
    ascending ``col``; ``min_by`` over a struct, a partial aggregate."""
    others = [c for c in curve.columns if c not in by]
    dist = F.struct(F.abs(F.col(col) - F.lit(x)), F.col(col))
    agg = F.min_by(F.struct(*others), dist).alias("_r")
    g = curve.groupBy(*by).agg(agg) if by else curve.agg(agg)
    return g.select(*by, *[F.col(f"_r.{c}").alias(c) for c in others])
