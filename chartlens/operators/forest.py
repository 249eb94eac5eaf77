"""A fitted forest as a table of nodes, scored and attributed by joins.

The model's own saved node data becomes rows (tree, node, ...). A row is scored by
walking from each tree's root one join per level, and the importances are sums
over the nodes. The table's size is bounded by trees and depth, not by the data: fifty
trees of depth ten have at most 102,350 nodes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartlens.schema import IMPORTANCE_CUTOFF, MODEL_FEATURES
from chartlens.session import fresh_path


def forest_nodes(model: RandomForestRegressionModel) -> DataFrame:
    """Rows (tree, node, feature, threshold, left, right, gain, count, impurity, prediction) of a fitted forest.

    ``feature`` is the index in the feature vector; a row of the data goes left where its value is at most
    ``threshold``. Leaves have no feature, threshold, children or gain. ``count`` is
    the weight of the training rows (as sampled) in the node, ``impurity`` the variance of their labels. Written in the
    shared folder by the model itself. Only continuous features are supported.
    """
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    path = fresh_path(spark, "forest")
    model.write().save(path)
    n = F.col("nodeData")
    count, total, squares = (n["impurityStats"][i] for i in range(3))  # weights, labels, squared labels
    inner = n["leftChild"] >= 0
    kinds = F.when(inner & (n["split"]["numCategories"] >= 0), F.raise_error(F.lit("a categorical split")))
    threshold = F.coalesce(kinds.cast("double"), n["split"]["leftCategoriesOrThreshold"][0])
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner, threshold).alias("threshold"),
        F.when(inner, n["leftChild"]).alias("left"),
        F.when(inner, n["rightChild"]).alias("right"),
        F.when(inner, n["gain"]).alias("gain"),
        count.alias("count"),
        (squares / count - (total / count) * (total / count)).alias("impurity"),
        n["prediction"].alias("prediction"),
    )


def walk(
    rows: DataFrame, nodes: DataFrame, keys: Sequence[str], features: Sequence[str] = MODEL_FEATURES, depth: int | None = None
) -> DataFrame:
    """The leaf of each row in each tree: ``keys``, tree, node, leaf_prediction, steps.

    One join per level with the node table, which is bounded (see above) and broadcast by that bound;
    a row that has reached its leaf stays there. ``keys`` must tell rows apart.
    """
    if depth is None:
        depth = _depth(nodes)
    values = F.array(*[F.col(f).cast("double") for f in features])
    roots = nodes.where("node = 0").select("tree", F.lit(0).alias("node"))
    at = rows.select(*keys, values.alias("_x"))
    trees = [r["tree"] for r in roots.select("tree").distinct().collect()]  # one row per tree
    at = at.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in sorted(trees)]))).withColumn("node", F.lit(0))
    at = at.withColumn("steps", F.lit(0))
    table = F.broadcast(nodes.select("tree", "node", "feature", "threshold", "left", "right"))
    for _ in range(depth):
        here = at.join(table, ["tree", "node"])
        inner = F.col("left").isNotNull()
        goes = F.when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = here.select(
            *keys, "_x", "tree",
            F.when(inner, goes).otherwise(F.col("node")).alias("node"),
            (F.col("steps") + inner.cast("int")).alias("steps"),
        )
    leaves = F.broadcast(nodes.select("tree", "node", F.col("prediction").alias("leaf_prediction")))
    return at.join(leaves, ["tree", "node"]).select(*keys, "tree", "node", "leaf_prediction", "steps")


def score(rows: DataFrame, nodes: DataFrame, keys: Sequence[str], features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Per row: ``keys`` and the mean of its leaves' predictions (``prediction``)."""
    return walk(rows, nodes, keys, features).groupBy(*keys).agg(F.avg("leaf_prediction").alias("prediction"))


def importance(
    nodes: DataFrame, features: Sequence[str] = MODEL_FEATURES, cutoff: float = IMPORTANCE_CUTOFF
) -> DataFrame:
    """Feature importances from the nodes: index, feature, importance, above_cutoff, largest first.

    Per tree, a feature's share of the sum of gain x count; shares are averaged over
    the trees that split at all and scaled to sum to 1.
    """
    spark = nodes.sparkSession
    gains = nodes.where("feature IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("count")).alias("g"))
    totals = gains.groupBy("tree").agg(F.sum("g").alias("total")).where("total > 0")
    share = gains.join(F.broadcast(totals), "tree").groupBy("feature").agg(F.sum(F.col("g") / F.col("total")).alias("s"))
    names = spark.createDataFrame(list(enumerate(features)), "index int, feature string")
    every = names.join(share.withColumnRenamed("feature", "index"), "index", "left").na.fill(0.0, ["s"])
    whole = F.sum("s").over(Window.partitionBy())  # one row per feature
    rows = every.select("index", "feature", F.coalesce(F.try_divide("s", whole), F.lit(0.0)).alias("importance"))
    return rows.withColumn("above_cutoff", F.col("importance") >= cutoff).orderBy(F.desc("importance"), "index")


def _depth(nodes: DataFrame) -> int:
    """Levels below the root in the deepest tree; the nodes' parents are followed level by level."""
    children = nodes.where("left IS NOT NULL").select("tree", "node", F.explode(F.array("left", "right")).alias("child"))
    level, depth = nodes.where("node = 0").select("tree", "node"), 0
    pairs = F.broadcast(children)
    while True:
        level = level.join(pairs, ["tree", "node"]).select("tree", F.col("child").alias("node"))
        if level.isEmpty():
            return depth
        depth += 1
