import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F

from citylake.operators.aggregate import count_by, mean_by
from citylake.plans.registry import DASHBOARD_SQL
from citylake.plans import dashboard, marts
from citylake.plans.features import FEATURE_COLUMNS, build_features


def test_mean_by_text_numbers_strict_and_lenient(spark):
    df = spark.createDataFrame([("a", "1.5", "10"), ("a", "2.5", None), ("b", "oops", "3")], "k string, x string, y string")
    ok = {r.k: (r.x, r.y) for r in mean_by(df.where("k = 'a'"), "k", ["x"], sums=["y"]).collect()}
    assert ok == {"a": (2.0, 10.0)}
    lenient = {r.k: r.x for r in mean_by(df, "k", ["x"], mode="lenient").collect()}
    assert lenient == {"a": 2.0, "b": None}
    with pytest.raises(Exception) as e:
        mean_by(df, "k", ["x"]).collect()
    assert "CAST" in str(e.value).upper() or isinstance(e.value, (NumberFormatException, ArithmeticException))


def test_count_by(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted((r.k or "", r.n) for r in count_by(df, "k", out="n").collect()) == [("", 1), ("a", 2)]


def test_listing_and_income_marts(spark):
    listings = spark.createDataFrame([
        ("n1", "2022-12-31", "D1", 100.0, 2, 1, 50.0, 40.0),
        ("n1", "2023-01-01", "D1", 200.0, None, 2, 70.0, 60.0),   # year boundary; NULL rooms not counted
        ("n1", "2023-06-01", "D2", 300.0, 4, 0, 90.0, 80.0),      # same id, other district
    ], "neighborhood_id string, timestamp string, district string, price double, rooms int, bathrooms int, "
       "priceByArea double, size double")
    mv = {(r.neighborhood_id, r.Year, r.district): r for r in marts.listing_mart(listings).collect()}
    assert set(mv) == {("n1", "2022", "D1"), ("n1", "2023", "D1"), ("n1", "2023", "D2")}
    r = mv[("n1", "2023", "D1")]
    assert (r["count"], r.totalrooms, r.rooms, r.totalbathrooms) == (0, None, None, 2)
    income = spark.createDataFrame([("n1", "2021-03-01 00:00:00", "80.5"), ("n1", "2021-09-01", "90.5"),
                                    ("n2", "2022-01-01", "100")], "neighborhood_id string, timestamp string, index_rfd string")
    got = {(r.neighborhood_id, r.Year): r.average for r in marts.income_mart(income).collect()}
    assert got == {("n1", "2021"): 85.5, ("n2", "2022"): 100.0}
    fac = spark.createDataFrame([("n1", "D1", "r1"), ("n1", "D1", "r2"), ("n1", "D2", None)],
                                "neighborhood_id string, district string, register_id string")
    assert sorted((r.district, r.numMarkets) for r in marts.facility_mart(fac).collect()) == [("D1", 2), ("D2", 0)]


def test_dashboard_queries(spark):
    mvm = spark.createDataFrame([("n1", "D2", 3), ("n1", "D1", 5), ("n2", "D3", 1)],
                                "neighborhood_id string, district string, numMarkets long")
    mvi = spark.createDataFrame([("n1", "2020", 10.0), ("n1", "2021", 20.0), ("n3", "2021", 1.0)],
                                "neighborhood_id string, Year string, average double")
    got = [tuple(r) for r in dashboard.markets_vs_income(mvm, mvi).collect()]
    # SQL over the join: 2 facility rows x 2 income rows, avg = 15; bare columns pinned to min district
    assert got == [("n1", "D1", 5, 15.0)]
    by_d = {r.district: r.numMarkets for r in dashboard.markets_by_district(dashboard.markets_vs_income(mvm, mvi)).collect()}
    assert by_d == {"D1": 5.0}
    mvid = spark.createDataFrame([("D1", 100.0, 0, 0, 2.0, 1.0, 1.0, 10.0), ("D1", 300.0, 2, 1, 4.0, 2.0, 1.0, 30.0)],
                                 "district string, price double, totalrooms long, totalbathrooms long, pba double, "
                                 "rooms double, bathrooms double, mean_size double")
    ppr = dashboard.price_per_room(mvid).first()
    assert (ppr.PricePerRoom, ppr.pba) == (100.0, 3.0)  # zero denominator skipped
    assert dashboard.price_per_room(mvid, clip=(0, 50)).count() == 0
    assert [r.mean_size for r in dashboard.size_by_district(mvid).collect()] == [20.0]
    assert sorted(r.rooms_bathrooms for r in dashboard.rooms_vs_price(mvid).collect()) == [2.0, 3.0]


def test_build_features_inner_and_terciles(spark):
    markets = spark.createDataFrame([(f"n{i}",) for i in [1, 1, 2, 3, 4, 5, 6, 7]], "neighborhood_id string")
    income = spark.createDataFrame([(f"n{i}", str(i * 10.0), str(i)) for i in range(1, 8) if i != 2],
                                   "neighborhood_id string, index_rfd string, population string")
    listings = spark.createDataFrame([(f"n{i}", 1.0 * i, 2.0, 3, 1, 4.0) for i in range(1, 8) if i != 3],
                                     "neighborhood_id string, price double, size double, rooms int, bathrooms int, "
                                     "priceByArea double")
    f = build_features(markets, income, listings)
    assert f.columns == FEATURE_COLUMNS
    rows = {r.neighborhood_id: r for r in f.collect()}
    assert set(rows) == {"n1", "n4", "n5", "n6", "n7"}  # n2 lacks income, n3 lacks listings
    assert rows["n1"].n_markets == 2
    # tercile over the 6 places with income (n1,n3..n7): ranks 0..5 -> L L M M M H
    assert [rows[k].index_rfd for k in ["n1", "n4", "n5", "n6", "n7"]] == ["Low", "Medium", "Medium", "Medium", "High"]


def test_dashboard_sql_matches_dataframe_form(spark):
    mvm = spark.createDataFrame([("n1", "D2", 3), ("n1", "D1", 5), ("n2", "D3", 1)],
                                "neighborhood_id string, district string, numMarkets long")
    mvi = spark.createDataFrame([("n1", "2020", 10.0), ("n1", "2021", 20.0), ("n2", "2021", 1.0)],
                                "neighborhood_id string, Year string, average double")
    mvid = spark.createDataFrame([("n1", "2020", "D1", 100.0, 0, 0, 2.0, 1.0, 1.0, 10.0),
                                  ("n2", "2021", "D1", 300.0, 2, 1, 4.0, 2.0, 1.0, 30.0)],
                                 "neighborhood_id string, Year string, district string, price double, totalrooms long, "
                                 "totalbathrooms long, pba double, rooms double, bathrooms double, mean_size double")
    spark.range(3).createOrReplaceTempView("listings")  # a view of the caller's, which stays
    got = {k: dashboard.run_sql(spark, q, **{n: df for n, df in (("facilities", mvm), ("income", mvi), ("listings", mvid)) if f"{{{n}}}" in q})
           for k, q in DASHBOARD_SQL.items()}
    assert spark.table("listings").count() == 3
    want = {"markets_vs_income": dashboard.markets_vs_income(mvm, mvi), "rooms_vs_price": dashboard.rooms_vs_price(mvid),
            "price_per_room": dashboard.price_per_room(mvid), "size_by_district": dashboard.size_by_district(mvid)}
    for k, df in want.items():
        cols = sorted(df.columns)
        a = sorted(map(str, (tuple(r[c] for c in cols) for r in got[k].collect())))
        b = sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect())))
        assert a == b, k
