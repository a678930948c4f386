import os

from pyspark.sql import functions as F

from citylake.operators.upsert import check_unique, upsert
from citylake.sources.zone import Zone

import pytest


def test_upsert_semantics(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "b1", 1), (2, "b2", 2), (3, "c", 1)], "k int, v string, seq int")
    out = upsert(target, updates, "k", order="seq").drop("seq")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, "b2"), (3, "c")]
    again = upsert(out, updates, "k", order="seq").drop("seq")  # idempotent
    assert sorted(tuple(r) for r in again.collect()) == [(1, "a"), (2, "b2"), (3, "c")]


def test_check_unique(spark):
    check_unique(spark.createDataFrame([(1,), (2,)], "k int"), "k")
    with pytest.raises(ValueError):
        check_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_zone_roundtrip(spark, scratch):
    z = Zone(spark, os.path.join(scratch, "zone"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    z.overwrite(df, "t")
    z.append(spark.createDataFrame([(3, "c")], "k int, v string"), "t")
    assert sorted(r.k for r in z.read("t").collect()) == [1, 2, 3]
    # rebuild a table from itself: staged write + swap, no read/overwrite conflict
    z.overwrite(z.read("t").withColumn("v", F.upper("v")), "t")
    assert sorted(r.v for r in z.read("t").collect()) == ["A", "B", "C"]
    z.upsert("t", spark.createDataFrame([(3, "z"), (4, "d")], "k int, v string"), ["k"])
    assert sorted(tuple(r) for r in z.read("t").collect()) == [(1, "A"), (2, "B"), (3, "z"), (4, "d")]
    z.insert_new("t", spark.createDataFrame([(4, "x"), (5, "e")], "k int, v string"), ["k"])
    assert sorted(tuple(r) for r in z.read("t").collect()) == [(1, "A"), (2, "B"), (3, "z"), (4, "d"), (5, "e")]
    z.ensure_table("t2", df.schema, primary_key=["k"])
    assert z.read("t2").count() == 0


def test_failed_overwrite_keeps_the_table(spark, scratch):
    z = Zone(spark, os.path.join(scratch, "zone2"))
    z.overwrite(spark.createDataFrame([(1, "a")], "k int, v string"), "t")
    bad = spark.range(10).select(F.col("id").cast("int").alias("k"),
                                 F.when(F.col("id") == 7, F.raise_error(F.lit("boom"))).otherwise(F.lit("x")).alias("v"))
    with pytest.raises(Exception):
        z.overwrite(bad, "t")
    assert [tuple(r) for r in z.read("t").collect()] == [(1, "a")]
    staging = os.path.join(scratch, "zone2", "_staging")
    assert not os.path.exists(staging) or os.listdir(staging) == []


def test_append_aligns_columns_by_name(spark, scratch):
    z = Zone(spark, os.path.join(scratch, "zone3"))
    z.overwrite(spark.createDataFrame([(1, "a", 1.0)], "k int, v string, x double"), "t")
    z.append(spark.createDataFrame([("b", 2)], "v string, k int"), "t")  # other order, x missing
    assert sorted(tuple(r) for r in z.read("t").collect()) == [(1, "a", 1.0), (2, "b", None)]
    with pytest.raises(ValueError):
        z.append(spark.createDataFrame([(3, "c", "extra")], "k int, v string, y string"), "t")


def test_partitioned_zone_table(spark, scratch):
    z = Zone(spark, os.path.join(scratch, "zone4"))
    df = spark.createDataFrame([(1, "2023", 1.0), (2, "2024", 2.0), (3, "2024", 3.0)], "k int, year string, x double")
    z.overwrite(df, "t", partition_by=["year"])
    assert os.path.isdir(os.path.join(scratch, "zone4", "t.parquet", "year=2024"))
    back = z.read("t").where("year = '2024'")
    assert sorted(r.k for r in back.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(year" in back._jdf.queryExecution().executedPlan().toString()


def test_interrupted_swap_is_recovered(spark, scratch):
    root = os.path.join(scratch, "zone5")
    z = Zone(spark, root)
    z.overwrite(spark.createDataFrame([(1, "a")], "k int, v string"), "t")
    # a driver that died between the two renames of an overwrite: the table was moved aside
    os.makedirs(os.path.join(root, "_staging"), exist_ok=True)
    os.rename(os.path.join(root, "t.parquet"), os.path.join(root, "_staging", "t-old-0123"))
    assert z.exists("t")
    assert [tuple(r) for r in z.read("t").collect()] == [(1, "a")]
    assert not os.path.exists(os.path.join(root, "_staging", "t-old-0123"))
