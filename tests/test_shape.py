from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.functions.columns import snapshot_date
from citylake.operators.shape import (SRC, drop_all_null, flatten_first, flatten_struct, unnest_envelope)

REC = "array<struct<k:string,v:int>>"


def envs(spark, rows):
    schema = T.StructType.fromDDL(f"_id string, filename string, timestamp string, data {REC}")
    return spark.createDataFrame(rows, schema)


def test_unnest_envelope_cases(spark):
    df = envs(spark, [
        ("d1", "a_2023-01-01_x.json", "t1", [("a", 1), ("b", 2)]),
        ("d2", "a_2023-02-01.json", "t2", []),          # empty data
        ("d3", "a_2023-03-01.json", "t3", None),        # NULL data
        ("d4", "a_2023-04-01.json", "t4", [("a", 1)]),  # same record in another document
    ])
    out = unnest_envelope(df).orderBy("source_id", F.col(f"{SRC}.pos")).collect()
    assert [(r.k, r.v, r.source_id, r.timestamp, r[SRC].pos) for r in out] == [
        ("a", 1, "d1", "t1", 0), ("b", 2, "d1", "t1", 1), ("a", 1, "d4", "t4", 0)]
    snap = unnest_envelope(df, snapshot_from_filename=True).select("timestamp").distinct().collect()
    assert sorted(r.timestamp for r in snap) == ["2023-01-01", "2023-04-01"]
    first = unnest_envelope(df, first_only=True).collect()
    assert sorted((r.k, r.source_id) for r in first) == [("a", "d1"), ("a", "d4")]


def test_snapshot_date(spark):
    df = spark.createDataFrame([("idealista_2023-05-11_x.json",), ("a_b_2023-05-11.json",), ("2023-05-11T10.json",),
                                (None,)], "fn string")
    got = [r.s for r in df.select(snapshot_date("fn").alias("s")).collect()]
    # reference: fn[find('_')+1 : find('_')+11]
    exp = [None if fn is None else fn[fn.find("_") + 1: fn.find("_") + 11]
           for fn in ["idealista_2023-05-11_x.json", "a_b_2023-05-11.json", "2023-05-11T10.json"]] + [None]
    assert got == exp


def test_flatten_struct_collision_and_missing(spark):
    df = spark.createDataFrame([(1, 10.0, (True, 5.0, 99.0)), (2, 20.0, None)],
                               "id int, price double, ps struct<has:boolean,spPrice:double,price:double>")
    out = {r.id: r for r in flatten_struct(df, "ps").collect()}
    assert out[1].price == 99.0 and out[1].has is True and out[1].spPrice == 5.0
    assert out[2].price == 20.0 and out[2].has is None
    assert "ps" not in flatten_struct(df, "ps").columns


def test_flatten_first_order_and_empty(spark):
    schema = ("id int, level int, addresses array<struct<level:int,zip:string>>, "
              "classes array<struct<level:int,tree:int>>")
    df = spark.createDataFrame([
        (1, 0, [(1, "z1"), (2, "z2")], [(7, 70)]),   # classes wins on level
        (2, 0, [(1, "z1")], []),                      # empty classes: address level kept
        (3, 5, [], []),                               # both empty: own value kept
        (4, 5, None, [(8, 80)]),
    ], schema)
    out = {r.id: r for r in flatten_first(flatten_first(df, "addresses"), "classes").collect()}
    assert (out[1].level, out[1].zip, out[1].tree) == (7, "z1", 70)
    assert (out[2].level, out[2].zip, out[2].tree) == (1, "z1", None)
    assert (out[3].level, out[3].zip, out[3].tree) == (5, None, None)
    assert (out[4].level, out[4].zip, out[4].tree) == (8, None, 80)


def test_drop_all_null(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b string, c string")
    assert drop_all_null(df).columns == ["a", "c"]
    empty = spark.createDataFrame([], "a int, b string")
    assert drop_all_null(empty).columns == ["a", "b"]


def test_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([("d", "f_2020-01-01", "t", [(1, (2, 3), [(5,)])])],
                               "_id string, filename string, timestamp string, "
                               "data array<struct<`a.b`:int, `s t`:struct<`x.y`:int, `a.b`:int>, `ar r`:array<struct<`a.b`:int>>>>")
    f = flatten_first(flatten_struct(unnest_envelope(df), "s t"), "ar r")
    row = f.first()
    assert (row["a.b"], row["x.y"]) == (5, 2)
    assert drop_all_null(f).columns == f.columns
