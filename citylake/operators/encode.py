"""Label indexes, category maps and evaluation of predictions, as aggregates over the data alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylake.operators.rank import global_rank


def label_index(df: DataFrame, column: str) -> DataFrame:
    """(label, index, n): labels by descending number of rows, ties by the label; NULL is no label.

    Rows are counted in each task first. The distinct labels are then ranked by ``global_rank``, so many labels don't meet in one task.
    """
    counts = df.where(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`").cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    ranked = global_rank(counts.withColumn("_down", -F.col("n")), ["_down", "label"], rank_col="_rank")
    return ranked.select("label", F.col("_rank").cast("double").alias("index"), "n")


def category_maps(df: DataFrame, columns: Sequence[str], most: int) -> DataFrame:
    """(column, value, index) of the numeric columns with at most ``most`` distinct values; NULL and NaN are no values. Zero, if it
    occurs, has index 0, the other values follow in ascending order.

    One pass keeps a sketch of fixed size for each column. A column with at most ``most`` values sets at most so many of the
    sketch's registers, so its estimate can't pass the bound below; all columns above it are out before any value is
    shuffled. The others' values are counted exactly.
    """
    sketches = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`").cast("double"), 0.02).alias(f"_c{i}") for i, c in enumerate(columns)])
    bound = 2 * most + 16
    few = (sketches.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("n")) for i, c in enumerate(columns)])).alias("x"))
           .where(F.col("x.n") <= bound).select(F.col("x.column").alias("column")))  # one row per column at most
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])).alias("x"))
    distinct = (values.select("x.column", "x.value").where(F.col("value").isNotNull() & ~F.isnan("value"))
                .join(F.broadcast(few), "column").distinct())
    each = Window.partitionBy("column")  # only columns that passed the bound
    numbered = (distinct.withColumn("_n", F.count(F.lit(1)).over(each))
                .withColumn("index", F.row_number().over(each.orderBy(F.col("value") != 0, "value")) - 1))
    return numbered.where(F.col("_n") <= most).select("column", "value", "index")


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n): labelled rows by label and prediction; a NULL prediction is a class of its own. Counted in each task first."""
    return (df.where(F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{label}`").alias("label"), F.col(f"`{prediction}`").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def evaluation(table: DataFrame) -> DataFrame:
    """One row from a confusion table: ``accuracy``, ``test_error`` (1 - accuracy) and ``n_test``; NULL accuracy without rows."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    return (table.agg(F.sum(hit).alias("_hit"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_test"))
            .withColumn("accuracy", F.try_divide(F.col("_hit").cast("double"), F.col("n_test")))
            .select("accuracy", (F.lit(1.0) - F.col("accuracy")).alias("test_error"), "n_test"))


def class_report(table: DataFrame) -> DataFrame:
    """Per class of a confusion table: ``n`` rows, ``n_predicted``, ``n_hit``, ``precision`` and ``recall`` (NULL without rows)."""
    as_label = table.select(F.col("label").alias("class"), F.col("n"), F.lit(0).cast("long").alias("n_predicted"),
                            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("n_hit"))
    as_prediction = table.where(F.col("prediction").isNotNull()).select(
        F.col("prediction").alias("class"), F.lit(0).cast("long").alias("n"), F.col("n").alias("n_predicted"), F.lit(0).cast("long").alias("n_hit"))
    return (as_label.unionAll(as_prediction).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("n", "n_predicted", "n_hit")])
            .withColumn("precision", F.try_divide(F.col("n_hit").cast("double"), F.col("n_predicted")))
            .withColumn("recall", F.try_divide(F.col("n_hit").cast("double"), F.col("n"))))
