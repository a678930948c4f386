"""A key holding a third of the rows, and results that do not depend on the partition count."""

import random

import pytest
from pyspark.sql import functions as F

from citylake.operators.aggregate import mean_by
from citylake.operators.dedup import dedup_first
from citylake.operators.rank import global_rank, rank_bucket
from citylake.operators.reconcile import LOOKUP_COLUMNS, reconcile
from citylake.plans import registry

LK_SCHEMA = "pos long, " + ", ".join(f"{c} string" for c in LOOKUP_COLUMNS)


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rows: key 'hot' holds a third of them, the rest spread over 500 keys."""
    rnd = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randint(0, 499)}", i, float(rnd.randint(0, 9))) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "k string, ord int, x double").repartition(8)


def test_dedup_hot_key_is_combined_map_side(spark, hot):
    rows, df = hot
    out = {r.k: r.ord for r in dedup_first(df, "k", "ord").collect()}
    assert out["hot"] == 0 and len(out) == len({r[0] for r in rows})
    plan = dedup_first(df, "k", "ord")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # map-side combine before the exchange


def test_mean_hot_key(spark, hot):
    rows, df = hot
    got = {r.k: r.x for r in mean_by(df, "k", ["x"]).collect()}
    hot_x = [r[2] for r in rows if r[0] == "hot"]
    assert got["hot"] == pytest.approx(sum(hot_x) / len(hot_x))


def test_reconcile_hot_name(spark):
    lk = spark.createDataFrame([(0, "D", "Hot Place", "D", "d", "Q1", "Hot Place", "hot place", "Q11"),
                                (1, "D", "Other", "D", "d", "Q1", "Other", "other", "Q12")], LK_SCHEMA)
    probe = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "HOT PLACE")
                                     .otherwise(F.concat(F.lit("x"), F.col("id").cast("string"))).alias("name"))
    out = reconcile(probe, lk, "name", how="left")
    got = out.groupBy("neighborhood_id").count().collect()
    assert {r.neighborhood_id: r["count"] for r in got} == {"Q11": 1000, None: 2000}


def test_rank_hot_value_is_split_by_key(spark, hot):
    _, df = hot
    same = df.withColumn("x", F.when(F.col("k") == "hot", F.lit(5.0)).otherwise(F.col("x")))
    ranked = global_rank(same, ["x", "ord"], num_partitions=6)
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(3000))
    # the tied value is spread over several range partitions (ties broken by the key)
    per_part = (same.repartitionByRange(6, "x", "ord").where("k = 'hot'")
                    .groupBy(F.spark_partition_id()).count().count())
    assert per_part > 1


@pytest.mark.parametrize("name", ["dedup_first_lineitem", "reconcile_left", "extend_lookup", "rank_bucket_income",
                                  "global_rank_orders", "markets_vs_income", "format_listings_zone"])
def test_results_do_not_depend_on_partition_count(spark, name):
    sf = "/root/testdata/sf0.001"
    results = []
    for parts in ("1", "4", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            df = registry.QUERIES[name](spark, sf)
            results.append(sorted(map(str, (tuple(r) for r in df.collect()))))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]


def test_rank_bucket_hot_ties(spark):
    df = spark.createDataFrame([(f"k{i:02d}", 1.0) for i in range(9)], "key string, v double")
    got = [r.bucket for r in rank_bucket(df, "v", "key").orderBy("key").collect()]
    assert got == ["Low"] * 3 + ["Medium"] * 4 + ["High"] * 2


def test_rank_with_adaptive_range_count(spark, hot):
    rows, df = hot
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        got = {r.ord: r["rank"] for r in global_rank(df, ["x", "ord"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    spec = {r[1]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[1])))}
    assert got == spec
