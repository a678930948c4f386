"""The fitted forest as a table, and what can be asked of it in SQL: scores and importances."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.plans import ml
from citylake.session import checkpoint_dir


def forest_table(spark: SparkSession, model: PipelineModel, path: str | None = None) -> DataFrame:
    """One row per node: ``tree``, ``node`` (0 is the root), ``feature`` (-1 in a leaf), ``threshold`` (go left at or below it) or
    ``categories`` (go left if among them), ``left``, ``right``, ``impurity``, ``gain``, ``n`` (training rows) and ``stats`` (weight
    by label index). The nodes come from the forest's own saved form at ``path`` (a new folder in the checkpoint folder unless given)."""
    path = path or f"{checkpoint_dir(spark)}/forest-{uuid.uuid4().hex}"
    ml.forest(model).write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData")
    split = node["split"]
    leaf = node["leftChild"] < 0
    plain = split["numCategories"] == -1
    # a categorical split lists the categories that go left, a continuous one its threshold
    return saved.select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), F.when(leaf, -1).otherwise(split["featureIndex"]).alias("feature"),
        F.when(~leaf & plain, F.element_at(split["leftCategoriesOrThreshold"], 1)).alias("threshold"),
        F.when(~leaf & ~plain, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(~leaf, node["leftChild"]).alias("left"), F.when(~leaf, node["rightChild"]).alias("right"),
        node["impurity"].alias("impurity"), node["gain"].alias("gain"), node["rawCount"].cast("double").alias("n"), node["impurityStats"].alias("stats"))


def score(forest: DataFrame, rows: DataFrame, features: str = "indexedFeatures", depth: int = 5) -> DataFrame:
    """``rows`` with ``votes`` (by label index, each tree's leaf shares summed) and ``forest_prediction``: every row walks down every tree.

    ``features`` is an array column and ``depth`` the forest's largest. The forest is a few thousand rows at most, by its parameters, and is
    broadcast; a step down is one join, so the plan has ``depth`` of them and the rows are shuffled only to sum the trees' votes.
    """
    inner = forest.where("feature >= 0").select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "feature", "threshold", "categories", "left", "right")
    at = rows.withColumn("_row", F.monotonically_increasing_id()).crossJoin(F.broadcast(forest.where("node = 0").select("tree"))).withColumn("node", F.lit(0))
    value = F.get(F.col(features), F.col("feature"))
    go_left = F.when(F.col("categories").isNotNull(), F.array_contains("categories", value)).otherwise(value <= F.col("threshold"))
    for _ in range(depth):
        step = at.join(F.broadcast(inner), (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")), "left")
        at = step.withColumn("node", F.when(F.col("feature").isNull(), F.col("node")).when(go_left, F.col("left")).otherwise(F.col("right"))) \
                 .drop("_t", "_n", "feature", "threshold", "categories", "left", "right")
    leaves = forest.where("feature < 0").select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "stats")
    shares = F.transform("stats", lambda s: s / F.aggregate("stats", F.lit(0.0), lambda a, x: a + x))
    voted = (at.join(F.broadcast(leaves), (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")))
             .select("_row", *[F.col(f"`{c}`") for c in rows.columns], F.posexplode(shares).alias("_label", "_share")))
    # trees first: a row's few votes per label are one group
    each = voted.groupBy("_row", "_label").agg(F.sum("_share").alias("vote"), *[F.first(f"`{c}`").alias(c) for c in rows.columns])
    out = each.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_label", "vote"))).alias("_v"), *[F.first(f"`{c}`").alias(c) for c in rows.columns])
    return (out.withColumn("votes", F.transform("_v", lambda x: x["vote"]))
            .withColumn("forest_prediction", (F.array_position("votes", F.array_max("votes")) - 1).cast("double")).drop("_row", "_v"))


def importances(forest: DataFrame) -> DataFrame:
    """(feature, importance): each tree's gains weighted by rows and scaled to 1, averaged and scaled to 1 again. Features that no
    node splits on have no row."""
    per_tree = forest.where("feature >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
    totals = per_tree.groupBy("tree").agg(F.sum("g").alias("t"))
    scaled = per_tree.join(F.broadcast(totals), "tree").where("t > 0").groupBy("feature").agg(F.sum(F.col("g") / F.col("t")).alias("s"))
    return scaled.crossJoin(F.broadcast(scaled.agg(F.sum("s").alias("all")))).select("feature", (F.col("s") / F.col("all")).alias("importance"))
