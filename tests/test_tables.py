import uuid

import pytest
from pyspark.sql import types as T

from citylake.plans import mart_state
from citylake.sources.tables import Tables


@pytest.fixture
def tables(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    return Tables(spark, name, f"file://{tmp_path}/{name}")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_append_grows_without_rewriting(spark, tables):
    tables.append(spark.createDataFrame([(1, "a")], "id int, v string"), "t")
    before = set(tables.read("t").inputFiles())
    tables.append(spark.createDataFrame([("x", 2)], "more string, id int"), "t")
    assert rows(tables.read("t")) == [(1, "a", None), (2, None, "x")] and before <= set(tables.read("t").inputFiles())
    with pytest.raises(ValueError, match="other"):
        tables.append(spark.createDataFrame([(3, 1)], "id int, other int"), "t", grow=False)


def test_append_grows_nested_fields_and_types(spark, tables):
    tables.append(spark.createDataFrame([(1, ("a",))], "id int, s struct<x:string>"), "t", partition_by=["id"])
    tables.append(spark.createDataFrame([(1 << 40, ("b", 2.5))], "id bigint, s struct<x:string,y:double>"), "t")
    got = {r.id: r.s.asDict() for r in tables.read("t").collect()}
    assert got == {1: {"x": "a", "y": None}, 1 << 40: {"x": "b", "y": 2.5}} and tables.partitions("t") == ["id"]


def test_keys_are_kept(spark, tables):
    schema = T.StructType.fromDDL("id int, v string")
    tables.create("t", schema, primary_key=["id"])
    tables.create("t", schema, primary_key=["id"])
    tables.append(spark.createDataFrame([(1, "a"), (2, "b")], schema), "t")
    for bad in ([(2, "c")], [(3, "c"), (3, "d")]):
        with pytest.raises(ValueError):
            tables.append(spark.createDataFrame(bad, schema), "t")
    with pytest.raises(ValueError):
        tables.replace(spark.createDataFrame([(1, "a"), (1, "b")], schema), "t")
    assert rows(tables.read("t")) == [(1, "a"), (2, "b")] and tables.primary_key("t") == ["id"]
    tables.replace(tables.read("t").where("id = 1"), "t")
    assert rows(tables.read("t")) == [(1, "a")] and tables.primary_key("t") == ["id"]
    tables.insert_new(spark.createDataFrame([(1, "z"), (4, "q"), (4, "p"), (None, "n")], schema), "t", ["id"], order=["v"])
    tables.insert_new(spark.createDataFrame([(4, "0"), (None, "0")], schema), "t", ["id"], order=["v"])
    assert rows(tables.read("t")) == [(1, "a"), (4, "p"), (None, "n")]


def test_replaced_partitions_and_upserts_leave_others(spark, tables):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0), (None, 1, 4.0)], "p string, id int, v double")
    tables.replace(df, "t", partition_by=["p"])
    files = {f for f in tables.read("t").inputFiles() if "p=b" in f}
    tables.replace_partitions(spark.createDataFrame([(9.0, 7, "a")], "v double, id int, p string"), "t")
    assert rows(tables.read("t").select("p", "id", "v")) == [("a", 7, 9.0), ("b", 1, 3.0), (None, 1, 4.0)]
    tables.upsert(spark.createDataFrame([("a", 7, -1.0), ("a", 8, 8.0), (None, 1, 5.0)], df.schema), "t", ["p", "id"])
    assert rows(tables.read("t").select("p", "id", "v")) == [("a", 7, -1.0), ("a", 8, 8.0), ("b", 1, 3.0), (None, 1, 5.0)]
    assert files == {f for f in tables.read("t").inputFiles() if "p=b" in f}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    tables.upsert(spark.createDataFrame([("b", 1, 0.0)], df.schema), "t", ["id"])  # not partitioned by its key: rewritten
    assert rows(tables.read("t").select("p", "id", "v")) == [("a", 7, -1.0), ("a", 8, 8.0), ("b", 1, 0.0)]


def test_a_failed_replace_leaves_the_old_rows(spark, tables):
    tables.append(spark.range(3), "t")
    with pytest.raises(Exception):
        tables.replace(spark.range(3).selectExpr("assert_true(id < 2) AS x", "id"), "t")
    assert tables.read("t").count() == 3 and [t.name for t in spark.catalog.listTables(tables.database)] == ["t"]


def test_batches_merge_to_the_whole(spark, tables):
    data = [("n1", "2023-01-01", "d", 10.0, 2, 1, 5.0, 50.0), ("n1", "2023-05-01", "d", 30.0, None, 2, 6.0, 60.0), ("n2", "2022-01-01", "d", 7.0, 1, 1, None, 70.0),
            ("n1", "2023-06-01", "d", None, 4, 4, 4.0, 40.0), (None, "2021-01-01", "e", 1.0, 1, 0, 1.0, 10.0)]
    schema = "neighborhood_id string, timestamp string, district string, price double, rooms int, bathrooms int, priceByArea double, size double"
    from citylake.plans import marts
    for k in range(3):
        batch = spark.createDataFrame(data[k::3], schema)
        untouched = {f for f in tables.read("s").inputFiles()} if tables.exists("s") else set()
        years = {r[1][:4] for r in data[k::3]}
        mart_state.add_batch(tables, "s", mart_state.listing_partials(batch), mart_state.LISTING_KEYS, ["Year"])
        assert {f for f in untouched if not any(f"Year={y}" in f for y in years)} <= set(tables.read("s").inputFiles())
    got = mart_state.listing_mart(tables.read("s").withColumn("Year", __import__("pyspark").sql.functions.col("Year").cast("string")))
    want = marts.listing_mart(spark.createDataFrame(data, schema))
    assert rows(got.select(*sorted(got.columns))) == rows(want.select(*sorted(got.columns)))
