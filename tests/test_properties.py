"""Property checks of the exact reference rules against their Python statement."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citylake.functions.columns import snapshot_date
from citylake.operators.rank import tercile


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab_-.0123456789é")), max_size=30), min_size=1, max_size=20))
def test_snapshot_date_is_the_filename_slice(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "fn string")
    got = [r.s for r in df.select(snapshot_date("fn").alias("s")).collect()]
    assert got == [n[n.find("_") + 1: n.find("_") + 11] for n in names]


@settings(max_examples=20, deadline=None)
@given(st.integers(min_value=1, max_value=60))
def test_tercile_is_the_strict_cut(spark, n):
    df = spark.range(n).select(F.col("id").alias("i"), F.lit(n).alias("n"))
    got = [r.b for r in df.orderBy("i").select(tercile("i", "n").alias("b")).collect()]
    want = ["Low" if i < n / 3 else ("High" if i > n * 2 / 3 else "Medium") for i in range(n)]
    assert got == want
