"""Feature attribution from the trees themselves (M7, M8).

A fitted tree model's margin for a row is its trees' root values plus, along
each tree's path, the changes of value from node to node; every change belongs
to the feature that the node splits on.  Summed over paths and trees, bias plus
contributions equal the margin on every row.

The node table is read from the saved model.  A row's path in a tree depends
only on its leaf, so a tree becomes one CASE expression (row -> leaf) and one
literal array per feature (leaf -> contribution): all contributions are column
expressions, and the mean absolute contribution of all features is one scan.
The expressions grow with the model, not with the data.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .model_store import StoredModel


def node_table(spark: SparkSession, path: str, model: StoredModel) -> DataFrame:
    """tree, node, value, left, right, feature, threshold and weight of the
    saved ``model``'s trees; ``value`` is the node's own prediction (boosting) or
    share of positive weight (forest)."""
    stage = f"{path}/pipeline/stages/{len(model.pipeline.stages) - 1}_{model.pipeline.stages[-1].uid}"
    n = F.col("nodeData")
    stats = n["impurityStats"]
    share = F.try_divide(stats[1], F.aggregate(stats, F.lit(0.0), lambda s, x: s + x))
    value = n["prediction"] if _boosted(model) else F.coalesce(share, F.lit(0.0))
    nodes = spark.read.parquet(f"{stage}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), value.alias("value"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), F.try_element_at(n["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"))
    weights = spark.read.parquet(f"{stage}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    share_of_forest = F.lit(1.0 / model.pipeline.stages[-1].getNumTrees)
    return nodes.join(weights, "tree").withColumn("weight", F.col("weight") if _boosted(model) else share_of_forest)


def _boosted(model: StoredModel) -> bool:
    return "GBT" in type(model.pipeline.stages[-1]).__name__


def margin(model: StoredModel, df: DataFrame, name: str = "margin") -> DataFrame:
    """The fitted model's own margin: the boosted sum, or the forest's share."""
    from pyspark.ml.functions import vector_to_array
    out = model.pipeline.transform(df.fillna(0, subset=list(model.features)))
    return out.select(*df.columns, vector_to_array("rawPrediction" if _boosted(model) else "probability")[1].alias(name))


def _leaf(nodes: dict, node: int, features: Sequence[str], path: dict, leaves: list) -> Column:
    """Column of a row's leaf number below ``node``; appends to ``leaves`` each
    leaf's contributions {feature: sum of changes}."""
    n = nodes[node]
    if n["left"] < 0:
        leaves.append(path)
        return F.lit(len(leaves))
    below = []
    for child in (n["left"], n["right"]):
        change = n["weight"] * (nodes[child]["value"] - n["value"])
        below.append(_leaf(nodes, child, features, path | {n["feature"]: path.get(n["feature"], 0.0) + change}, leaves))
    return F.when(F.col(features[n["feature"]]) <= F.lit(n["threshold"]), below[0]).otherwise(below[1])


def contributions(df: DataFrame, model: StoredModel, nodes: DataFrame, name: str = "phi") -> DataFrame:
    """``df`` with ``bias`` and the array ``name``: the contribution of each of
    the model's features, in their order; bias plus sum is the margin."""
    trees: dict[int, dict] = {}
    for r in nodes.collect():  # the model's nodes
        trees.setdefault(r["tree"], {})[r["node"]] = r.asDict()
    filled, parts, bias = df.fillna(0, subset=list(model.features)), [[] for _ in model.features], 0.0
    leaf_columns = []
    for t in sorted(trees):
        leaves: list[dict] = []
        leaf_columns.append(_leaf(trees[t], 0, model.features, {}, leaves).alias(f"_leaf_{t}"))
        bias += trees[t][0]["weight"] * trees[t][0]["value"]
        for i in range(len(model.features)):
            if any(i in path for path in leaves):
                parts[i].append(F.element_at(F.lit([path.get(i, 0.0) for path in leaves]), F.col(f"_leaf_{t}")))
    phi = F.array(*[sum(p, F.lit(0.0)) for p in parts])
    return filled.select("*", *leaf_columns).select(*df.columns, F.lit(bias).alias("bias"), phi.alias(name))


def mean_abs_attribution(df: DataFrame, model: StoredModel, nodes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(``by``,) feature, importance: the mean absolute contribution of every
    feature, from one scan."""
    phi = contributions(df, model, nodes)
    means = F.array(*[F.struct(F.lit(f).alias("feature"), F.avg(F.abs(F.col("phi")[i])).alias("importance")) for i, f in enumerate(model.features)])
    g = phi.groupBy(*by) if by else phi
    return g.agg(means.alias("_m")).select(*by, F.inline("_m"))
