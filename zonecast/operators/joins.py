"""Joins and set operations.

Dimension lookups are plain left joins: the planner broadcasts a side whose
measured bytes allow it and otherwise shuffles both (sort-merge, with AQE skew
splitting)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dim: DataFrame, key: str | Sequence[str], probe: str) -> tuple[DataFrame, DataFrame]:
    """Left lookup of a dimension (J1) and the count of unmatched rows (A34):
    ``probe`` is a dimension column that is null exactly when unmatched.  The
    planner broadcasts the dimension if its measured bytes allow."""
    joined = df.join(dim, key, "left")
    unmatched = joined.agg(F.count_if(F.col(probe).isNull()).alias("n_unmatched"))
    return joined, unmatched


def add_attrs(panel: DataFrame, dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join of attributes by name (J4).  A key repeated in ``dim`` fans
    the panel out, as in the reference; guard with ``check_constraints``."""
    return panel.join(dim, key, "left")


def anti_done(df: DataFrame, done: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keep keys not already stored (J9, resume)."""
    return df.join(done, key, "left_anti")


def semi(df: DataFrame, keys: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keep rows whose key appears in ``keys``."""
    return df.join(keys, key, "left_semi")


def merge_metrics(frames: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Full outer join of per-metric frames on the key (J8); a metric missing
    for a key is null.  Keys are merged by ``join(on=names)``, which coalesces
    them."""
    return reduce(lambda a, b: a.join(b, list(key), "full_outer"), frames)


def inner_by(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner join on a shared key."""
    return a.join(b, key, "inner")


def attach_scores(features: DataFrame, scores: DataFrame, key: str,
                  score_cols: Sequence[str], no_data: str = "no data") -> DataFrame:
    """Geometry/attribute rows keep their place when no score exists (J13);
    a ``status`` column says ``no data`` for them."""
    out = features.join(scores.select(key, *score_cols), key, "left")
    return out.withColumn("status", F.when(F.col(score_cols[0]).isNull(), F.lit(no_data))
                          .otherwise(F.lit("scored")))


def union_latest(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    """Union of two id->name lists; names stripped, null ids dropped, the
    later list wins for a repeated id (U2)."""
    tag = lambda d, i: d.select(F.trim(F.col(key)).alias(key), F.trim(F.col(name)).alias(name),
                                F.lit(i).alias("_src"))
    u = tag(a, 0).unionByName(tag(b, 1)).where(F.col(key).isNotNull() & (F.col(key) != ""))
    return u.groupBy(key).agg(F.max_by(name, "_src").alias(name))


def compare_keys(a: DataFrame, b: DataFrame, key_a: str, key_b: str,
                 name: str = "key") -> DataFrame:
    """Key sets of two sources: which keys are in both, only left, only right
    (U3) -- ``intersect`` and ``subtract`` as one outer join on distinct keys."""
    ka = a.select(F.col(key_a).alias(name)).where(F.col(name).isNotNull()).distinct() \
        .withColumn("_a", F.lit(True))
    kb = b.select(F.col(key_b).alias(name)).where(F.col(name).isNotNull()).distinct() \
        .withColumn("_b", F.lit(True))
    j = ka.join(kb, name, "full_outer")
    side = (F.when(F.col("_a") & F.col("_b"), F.lit("both"))
            .when(F.col("_a"), F.lit("left_only")).otherwise(F.lit("right_only")))
    return j.select(name, side.alias("side"))


def union_loose(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of sources with differing columns, missing ones null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def keep_last(df: DataFrame, key: Sequence[str], order: Column) -> DataFrame:
    """Last row per key (W10 keep-last variant) as a partial aggregate."""
    others = [c for c in df.columns if c not in key]
    return (df.groupBy(*key).agg(F.max_by(F.struct(*others), order).alias("_r"))
            .select(*key, *[F.col(f"_r.{c}").alias(c) for c in others]))

