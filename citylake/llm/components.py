"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import dropped, staged


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root) for every node of an edge, ``root`` being the least node it is connected with.

    Alternating large-star and small-star steps: each links a node's larger (or its smaller and itself)
    neighbours to the least one. Every step is an aggregation and a join by node; the edges are
    written after each round, until a round changes nothing. A star's hub is
    grouped by a partially aggregated minimum, so a hot node never gathers its neighbours in one task.
    """
    def both(e):
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def summary(e):
        return e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).collect()[0]

    now = staged(edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    last = summary(now)
    while True:
        # large star: each node's larger neighbours link to the least of it and its neighbours
        two = both(now)
        least = two.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = two.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b").where(F.col("a") != F.col("b")).distinct()
        # small star: a node and its smaller neighbours link to the least of these
        stars = staged(large, "large")
        down = stars.select(F.col("b").alias("n"), F.col("a").alias("s"))
        least = down.groupBy("n").agg(F.min("s").alias("m"))
        small = down.join(least, "n")
        old, now = now, staged(small.select(F.col("m").alias("a"), F.col("s").alias("b")).union(small.select(F.col("m").alias("a"), F.col("n").alias("b")))
                     .where(F.col("a") != F.col("b")).distinct(), "edges")
        dropped(old, stars)
        this = summary(now)
        if this == last:
            break
        last = this
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
