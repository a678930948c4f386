"""Random-forest classifier of the income tercile from place features (``pyspark.ml``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.operators.encode import confusion, evaluation
from citylake.session import materialize

# Fixed values from the reference model: 10 trees, 70/30 split, categorical features up to 3 values.
NUM_TREES = 10
SPLIT = (0.7, 0.3)
MAX_CATEGORIES = 3


def share(key, seed: int) -> F.Column:
    """A number in [0, 1) that depends on the seed and the key alone (32 bits of an md5)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def split(df: DataFrame, *, seed: int, key: str = "neighborhood_id", weights: Sequence[float] = SPLIT) -> list[DataFrame]:
    """Seeded split (the reference's is unseeded) on a hash of ``key``: a row's part doesn't depend on
    partitioning, on the order of rows or on recomputation. Rows of one key, NULL included, stay together."""
    u, total, low, parts = share(F.col(f"`{key}`"), seed), float(sum(weights)), 0.0, []
    for i, w in enumerate(weights):
        high = low + w / total
        parts.append(df.where((u >= low) & (u < high) if i < len(weights) - 1 else u >= low))
        low = high
    return parts


def train(df: DataFrame, *, label: str = "index_rfd", id_cols: Sequence[str] = ("neighborhood_id",),
          seed: int = 42, num_trees: int = NUM_TREES, weights: Sequence[float] = SPLIT):
    """Fit assembler -> label indexer -> feature indexer -> forest -> label decoder.

    Features are every column but ``id_cols`` and ``label``, chosen by name. As in the reference
    the label indexer is fitted on all rows (it only fixes the label set). Returns
    ``(model, train_df, test_df)``.
    """
    features = [c for c in df.columns if c not in set(id_cols) | {label}]
    df = materialize(df)  # the fitting jobs below each read the input: compute it once
    labels = StringIndexer(inputCol=label, outputCol="indexedLabel").fit(df)
    train_df, test_df = split(df, seed=seed, key=id_cols[0], weights=weights)
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="features"),  # NULL features fail, as in the reference
        labels,
        VectorIndexer(inputCol="features", outputCol="indexedFeatures", maxCategories=MAX_CATEGORIES,
                      handleInvalid="keep"),
        RandomForestClassifier(labelCol="indexedLabel", featuresCol="indexedFeatures", numTrees=num_trees,
                               seed=seed),
        IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=labels.labels),
    ])
    return pipeline.fit(train_df), train_df, test_df


def predict(model: PipelineModel, df: DataFrame, *, keep: Sequence[str] = ("neighborhood_id", "index_rfd")) -> DataFrame:
    return model.transform(df).select(*keep, "predictedLabel", "prediction", "indexedLabel")


def preview(model: PipelineModel, df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` predictions with label and features (the reference's ``show(5)``)."""
    return model.transform(df).select("predictedLabel", "index_rfd", "features").limit(n)


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row: accuracy and test error (1 - accuracy), from the confusion table."""
    return evaluation(confusion(predictions, "indexedLabel", "prediction"))


def accuracy(predictions: DataFrame) -> float:
    ev = MulticlassClassificationEvaluator(labelCol="indexedLabel", predictionCol="prediction",
                                           metricName="accuracy")
    return ev.evaluate(predictions)


def forest(model: PipelineModel):
    """The fitted forest stage (``featureImportances``, ``toDebugString``)."""
    return model.stages[3]
