"""Connected components by alternating stars, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over undirected ``edges`` (u, v).  With m the least of a
    node and its neighbours, the larger neighbours (large star), or the node
    and its smaller neighbours (small star), are linked to m."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # a partial minimum first; the join's hot nodes are split by the planner
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (u, v;
    no nulls).  Every round is written to the shared scratch folder; it ends
    when a round changes nothing."""
    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = written(edges.where("u <> v").select("u", "v").distinct(), "edges")
    seen = None
    while True:
        now = written(_stars(_stars(now, large=True), large=False), "stars")
        if (s := state(now)) == seen:
            break
        seen = s
    low = now.groupBy(F.col("v").alias("node")).agg(F.min("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(low)
