import pytest
from pyspark.sql import types as T

from citylake.operators.schema import conform, merge_schemas, merge_types, union_growing


def ddl(text):
    return T.StructType.fromDDL(text)


def test_merge_types(spark):
    a = ddl("a int, s struct<x:int,y:array<struct<p:string>>>, d decimal(5,2), t date, m map<string,int>, f float, n void")
    b = ddl("z string, S struct<x:bigint,y:array<struct<q:double>>,w:struct<k:boolean>>, A smallint, d int, t timestamp, m map<string,double>, f int, n array<int>")
    got = merge_schemas(a, b)
    assert got.simpleString() == ("struct<a:int,s:struct<x:bigint,y:array<struct<p:string,q:double>>,w:struct<k:boolean>>,d:decimal(12,2),t:timestamp,"
                                  "m:map<string,double>,f:double,n:array<int>,z:string>")
    with pytest.raises(ValueError, match="s.x"):
        merge_schemas(ddl("s struct<x:int>"), ddl("s struct<x:string>"))
    with pytest.raises(ValueError):
        merge_types(T.DecimalType(38, 0), T.DecimalType(38, 20))


def test_rows_in_the_common_schema(spark):
    one = spark.createDataFrame([(1, (5,), [(1,)], {"k": 1}), (2, None, None, None)], "id int, s struct<x:int>, a array<struct<p:int>>, m map<string,int>")
    two = spark.createDataFrame([(1 << 40, ("t", (9,)), [(2, "q"), None], {"k": 0.5}, "new")],
                                "ID bigint, s struct<w:string,v:struct<x:int>>, a array<struct<p:bigint,r:string>>, m map<string,double>, more string")
    rows = {r.id: r for r in union_growing(one, two).collect()}
    assert rows[1].s.asDict(True) == {"x": 5, "w": None, "v": None} and rows[1].more is None and rows[1].m == {"k": 1.0}
    assert rows[2].s is None and rows[2].a is None and rows[2].m is None
    late = rows[1 << 40]
    assert late.s.asDict(True) == {"x": None, "w": "t", "v": {"x": 9}} and late.more == "new"
    assert [None if e is None else e.asDict() for e in late.a] == [{"p": 2, "r": "q"}, None]
    assert rows[1].a[0].asDict() == {"p": 1, "r": None}
    assert union_growing(two, one).count() == 3 and union_growing(one.limit(0), two).count() == 1
    with pytest.raises(ValueError, match="more"):
        conform(two, one.schema)


def test_no_shuffle_and_no_job(spark):
    one = spark.range(10).selectExpr("id", "named_struct('x', id) AS s")
    two = spark.range(10).selectExpr("id", "named_struct('y', id) AS s")
    assert "Exchange" not in union_growing(one, two)._jdf.queryExecution().executedPlan().toString()
