"""Partitioning, types and the primary key are kept by every write path of a zone."""

import os

import pytest

from citylake.operators.upsert import upsert
from citylake.sources.zone import Zone

SCHEMA = "k int, year string, v string"


@pytest.fixture
def zone(spark, scratch):
    z = Zone(spark, os.path.join(scratch, "zone"))
    z.overwrite(spark.createDataFrame([(1, "2023", "a"), (2, "2024", "b")], SCHEMA), "t", partition_by=["year"])
    return z


def rows(z):
    return sorted(tuple(r) for r in z.read("t").collect())


def test_appends_to_a_partitioned_table_are_read_back(spark, zone):
    zone.append(spark.createDataFrame([(3, "2025", "c")], SCHEMA), "t")
    zone.insert_new("t", spark.createDataFrame([(3, "2025", "x"), (4, "2023", "d")], SCHEMA), ["k"])
    assert rows(zone) == [(1, "2023", "a"), (2, "2024", "b"), (3, "2025", "c"), (4, "2023", "d")]
    with pytest.raises(ValueError):
        zone.append(spark.createDataFrame([(9, "2025", "c")], SCHEMA), "t", partition_by=["k"])


def test_types_and_column_order_survive(spark, zone):
    assert zone.read("t").dtypes == [("k", "int"), ("year", "string"), ("v", "string")]


@pytest.mark.parametrize("keys", [["k"], ["k", "year"]])
def test_upsert_keeps_the_partitioning(spark, zone, keys):
    path = os.path.join(zone.root, "t.parquet")
    before = {f for f in os.listdir(os.path.join(path, "year=2024")) if f.endswith(".parquet")}
    zone.upsert("t", spark.createDataFrame([(1, "2023", "new"), (5, "2023", "e")], SCHEMA), keys)
    assert rows(zone) == [(1, "2023", "new"), (2, "2024", "b"), (5, "2023", "e")]
    assert {d for d in os.listdir(path) if "=" in d} == {"year=2023", "year=2024"}
    if keys == ["k", "year"]:  # only the touched partition was written
        assert before == {f for f in os.listdir(os.path.join(path, "year=2024")) if f.endswith(".parquet")}


def test_repeated_update_keys(spark, scratch):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "b", 1), (1, "c", 2)], "k int, v string, seq int")
    with pytest.raises(Exception, match="occurs twice"):
        upsert(target, twice.drop("seq"), "k").collect()
    out = upsert(target, twice, "k", order="seq")
    assert out.columns == ["k", "v"] and [tuple(r) for r in out.collect()] == [(1, "c")]
    z = Zone(spark, os.path.join(scratch, "z2"))
    z.upsert("t", twice, ["k"], order=["seq"])
    z.upsert("t", twice, ["k"], order=["seq"])
    assert [tuple(r) for r in z.read("t").collect()] == [(1, "c")]


def test_insert_new_keeps_the_first_of_a_batch(spark, scratch):
    z = Zone(spark, os.path.join(scratch, "z3"))
    batch = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 1)], "k int, v string, seq int")
    for _ in range(2):
        z.insert_new("t", batch, ["k"], order=["seq"])
    assert sorted(tuple(r) for r in z.read("t").collect()) == [(1, "a", 1), (2, "c", 1)]


def test_primary_key_is_enforced_on_every_write(spark, scratch):
    z = Zone(spark, os.path.join(scratch, "z4"))
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    z.ensure_table("t", one.schema, primary_key=["k"])
    z.append(one, "t")
    for bad in (one, spark.createDataFrame([(7, "x"), (7, "y")], "k int, v string")):
        with pytest.raises(ValueError):
            z.append(bad, "t")
    with pytest.raises(ValueError):
        z.overwrite(one.union(one), "t")
    assert [tuple(r) for r in z.read("t").collect()] == [(1, "a")]


def test_tables_without_properties_keep_their_folders(spark, scratch):
    z = Zone(spark, os.path.join(scratch, "z5"))
    spark.createDataFrame([(1, "x")], "k int, p string").write.partitionBy("p").parquet(z.path("t"))
    z.append(spark.createDataFrame([(2, "y")], "k int, p string"), "t")
    assert sorted(tuple(r) for r in z.read("t").collect()) == [(1, "x"), (2, "y")]
