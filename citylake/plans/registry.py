"""Registered queries over the driver's test tables, each with an independent SQL oracle.

Every query reads whole tables through ``standins`` and runs the library's operator on them; the
SQL next to it states the same result in plain ANSI SQL (DuckDB dialect) without the library.
Doubles are rounded to 4 places on both sides so that summation order cannot change a hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.functions.columns import array_count, snapshot_date
from citylake.operators.aggregate import count_by, mean_by
from citylake.operators.dedup import dedup_first
from citylake.operators.quality import quality_report
from citylake.operators.rank import global_rank, rank_bucket
from citylake.operators.reconcile import extend_lookup, reconcile, reconcile_with_fallback
from citylake.operators.shape import drop_all_null, flatten_first, flatten_struct, unnest_envelope
from citylake.operators.upsert import upsert
from citylake.plans import city, dashboard, marts, ml, standins
from citylake.plans.features import LISTING_FEATURES, build_features
from citylake.session import checkpoint_dir
from citylake.sources.landing import read_lookup
from citylake.sources.zone import Zone

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# Output rounding for the oracle comparison. Averages of 2-decimal inputs often sit exactly on a
# 4-place tie, where last-bit summation differences flip the rounded value; scaling by 1 + 1e-12
# first moves exact ties away from zero in both engines (the SQL does the same) and leaves other
# values unchanged.
NUDGE = 1.000000000001


def r4(c) -> "F.Column":
    return F.round((F.col(c) if isinstance(c, str) else c) * F.lit(NUDGE), 4)


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column to 4 places (output hygiene for the oracle comparison)."""
    return df.select(*[r4(f.name).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# ---- shared SQL building blocks (the oracle's own statement of each stand-in input) -----------
GEO = "geo AS (SELECT n.n_nationkey, n.n_name, r.r_regionkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"
PLACES = """places AS (SELECT CAST(n_nationkey AS BIGINT) AS pos, r_name AS district, n_name AS neighborhood,
  r_name AS district_n_reconciled, lower(r_name) AS district_n, CAST(r_regionkey AS VARCHAR) AS district_id,
  n_name AS neighborhood_n_reconciled, lower(n_name) AS neighborhood_n, CAST(n_nationkey AS VARCHAR) AS neighborhood_id FROM geo)"""
FACILITIES = """facilities AS (SELECT CAST(s.s_suppkey AS VARCHAR) AS register_id, s.s_name AS name, s.s_acctbal AS x_coord,
  g.r_name AS district, g.n_name AS neighborhood, CAST(g.r_regionkey AS VARCHAR) AS district_id,
  CAST(g.n_nationkey AS VARCHAR) AS neighborhood_id FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey)"""
INCOME = """income AS (SELECT CAST(o.o_orderkey AS VARCHAR) AS id, c.c_acctbal AS index_rfd, o.o_totalprice AS population,
  substr(CAST(o.o_orderdate AS VARCHAR), 1, 4) AS yr, CAST(c.c_nationkey AS VARCHAR) AS neighborhood_id, g.r_name AS district
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey)"""
LISTINGS = """listings AS (SELECT l.l_extendedprice AS price, l.l_quantity AS size, l.l_linenumber AS rooms,
  CAST(round(l.l_tax * 100) AS INTEGER) AS bathrooms, l.l_extendedprice / l.l_quantity AS priceByArea,
  substr(CAST(o.o_orderdate AS VARCHAR), 1, 4) AS yr, g.r_name AS district, CAST(c.c_nationkey AS VARCHAR) AS neighborhood_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.n_nationkey)"""
MVMARKETS = "mvmarkets AS (SELECT neighborhood_id, district, count(register_id) AS numMarkets FROM facilities GROUP BY neighborhood_id, district)"
MVINCOME = "mvincome AS (SELECT neighborhood_id, yr AS Year, avg(index_rfd) AS average FROM income GROUP BY neighborhood_id, yr)"
MVIDEALISTA = """mvidealista AS (SELECT neighborhood_id, yr AS Year, district, avg(price) AS price, avg(rooms) AS rooms,
  avg(bathrooms) AS bathrooms, count(rooms) AS "count", avg(priceByArea) AS pba, CAST(sum(rooms) AS BIGINT) AS totalrooms,
  CAST(sum(bathrooms) AS BIGINT) AS totalbathrooms, avg(size) AS mean_size FROM listings GROUP BY neighborhood_id, yr, district)"""
MARKETS_VS_INCOME = """mvi AS (SELECT m.neighborhood_id, min(m.district) AS district, arg_min(m.numMarkets, m.district) AS numMarkets,
  avg(i.average) AS average FROM mvmarkets m INNER JOIN mvincome i ON i.neighborhood_id = m.neighborhood_id
  GROUP BY m.neighborhood_id)"""
LOOKUP_VALUES = ("[district, neighborhood, district_n_reconciled, district_n, district_id, "
                 "neighborhood_n_reconciled, neighborhood_n, neighborhood_id]")
CUSTOMER_PROBE = """probe AS (SELECT c.c_custkey, CASE c.c_custkey % 7 WHEN 0 THEN g.n_name WHEN 1 THEN lower(g.n_name)
  WHEN 2 THEN upper(substr(g.n_name, 1, 1)) || lower(substr(g.n_name, 2)) WHEN 3 THEN g.r_name
  WHEN 4 THEN g.n_name || ' ' WHEN 5 THEN NULL ELSE lower(g.r_name) END AS name
  FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---- marts (A4 A5 A6 X13) --------------------------------------------------------------------
@register("facility_mart", _with(GEO, FACILITIES, MVMARKETS) + "SELECT * FROM mvmarkets")
def q_facility_mart(spark, d):
    return marts.facility_mart(standins.facilities(spark, d))


@register("income_mart", _with(GEO, INCOME, MVINCOME) +
          "SELECT neighborhood_id, Year, round((average) * 1.000000000001e0, 4) AS average FROM mvincome")
def q_income_mart(spark, d):
    return rounded(marts.income_mart(standins.income(spark, d)))


@register("income_mart_survey_year", _with(GEO, INCOME) + """SELECT neighborhood_id, yr AS Year,
  round((avg(index_rfd)) * 1.000000000001e0, 4) AS average FROM income GROUP BY neighborhood_id, yr""")
def q_income_mart_survey_year(spark, d):
    """Income mart keyed by the record's own year column instead of the ingestion timestamp."""
    return rounded(marts.income_mart(standins.income(spark, d), ts="year"))


@register("listing_mart", _with(GEO, LISTINGS, MVIDEALISTA) + """SELECT neighborhood_id, Year, district, round((price) * 1.000000000001e0, 4) AS price,
  round((rooms) * 1.000000000001e0, 4) AS rooms, round((bathrooms) * 1.000000000001e0, 4) AS bathrooms, "count", round((pba) * 1.000000000001e0, 4) AS pba, totalrooms, totalbathrooms,
  round((mean_size) * 1.000000000001e0, 4) AS mean_size FROM mvidealista""")
def q_listing_mart(spark, d):
    return rounded(marts.listing_mart(standins.listings(spark, d)))


# ---- dashboard (J6 A7 A10 P14 A8 A8b F7) -------------------------------------------------------
def _mvidealista(spark, d):
    return marts.listing_mart(standins.listings(spark, d))


def _markets_vs_income(spark, d):
    return dashboard.markets_vs_income(marts.facility_mart(standins.facilities(spark, d)),
                                       marts.income_mart(standins.income(spark, d)))


@register("markets_vs_income", _with(GEO, FACILITIES, INCOME, MVMARKETS, MVINCOME, MARKETS_VS_INCOME) +
          "SELECT neighborhood_id, district, numMarkets, round((average) * 1.000000000001e0, 4) AS average FROM mvi")
def q_markets_vs_income(spark, d):
    return rounded(_markets_vs_income(spark, d))


@register("markets_by_district", _with(GEO, FACILITIES, INCOME, MVMARKETS, MVINCOME, MARKETS_VS_INCOME) +
          "SELECT district, round((avg(numMarkets)) * 1.000000000001e0, 4) AS numMarkets FROM mvi GROUP BY district")
def q_markets_by_district(spark, d):
    return rounded(dashboard.markets_by_district(_markets_vs_income(spark, d)))


@register("rooms_vs_price", _with(GEO, LISTINGS, MVIDEALISTA) +
          "SELECT round((rooms + bathrooms) * 1.000000000001e0, 4) AS rooms_bathrooms, round((pba) * 1.000000000001e0, 4) AS rph, district FROM mvidealista")
def q_rooms_vs_price(spark, d):
    return rounded(dashboard.rooms_vs_price(_mvidealista(spark, d)))


@register("price_per_room", _with(GEO, LISTINGS, MVIDEALISTA) + """SELECT district,
  round((avg(price / nullif(CAST(totalrooms + totalbathrooms AS DOUBLE), 0))) * 1.000000000001e0, 4) AS PricePerRoom, round((avg(pba)) * 1.000000000001e0, 4) AS pba
  FROM mvidealista GROUP BY district""")
def q_price_per_room(spark, d):
    return rounded(dashboard.price_per_room(_mvidealista(spark, d)))


@register("price_per_room_clipped", _with(GEO, LISTINGS, MVIDEALISTA) + """SELECT district, round((PricePerRoom) * 1.000000000001e0, 4)
  AS PricePerRoom, round((pba) * 1.000000000001e0, 4) AS pba FROM (SELECT district,
  avg(price / nullif(CAST(totalrooms + totalbathrooms AS DOUBLE), 0)) AS PricePerRoom, avg(pba) AS pba
  FROM mvidealista GROUP BY district) WHERE PricePerRoom BETWEEN 0 AND 100000""")
def q_price_per_room_clipped(spark, d):
    """Price per room with the chart's x-axis range (0 to 100000) applied as a row filter."""
    return rounded(dashboard.price_per_room(_mvidealista(spark, d), clip=(0, 100000)))


@register("size_by_district", _with(GEO, LISTINGS, MVIDEALISTA) +
          "SELECT district, round((avg(mean_size)) * 1.000000000001e0, 4) AS mean_size FROM mvidealista GROUP BY district")
def q_size_by_district(spark, d):
    return rounded(dashboard.size_by_district(_mvidealista(spark, d)))


# The same four results asked for in SQL. A place has one facility row per district and one income row per year; the mean over
# their pairs is the mean over its income rows, so each side is reduced to a row per place before they meet.
DASHBOARD_SQL = {
    "markets_vs_income": """
        SELECT neighborhood_id, district, numMarkets, average
        FROM (SELECT neighborhood_id, min(district) AS district, min_by(numMarkets, district) AS numMarkets FROM {facilities} GROUP BY ALL)
        JOIN (SELECT neighborhood_id, avg(average) AS average FROM {income} GROUP BY ALL) USING (neighborhood_id)""",
    "rooms_vs_price": "SELECT district, rooms + bathrooms AS rooms_bathrooms, pba AS rph FROM {listings}",
    "price_per_room": """
        SELECT district, avg(pba) AS pba, avg(try_divide(price, totalrooms + totalbathrooms)) AS PricePerRoom
        FROM {listings} GROUP BY ALL""",
    "size_by_district": "SELECT district, avg(mean_size) AS mean_size FROM {listings} GROUP BY ALL",
}


def _dashboard_sql(spark, d, name) -> DataFrame:
    statement = DASHBOARD_SQL[name]
    given = {"facilities": lambda: marts.facility_mart(standins.facilities(spark, d)), "income": lambda: marts.income_mart(standins.income(spark, d)),
             "listings": lambda: _mvidealista(spark, d)}
    return dashboard.run_sql(spark, statement, **{k: f() for k, f in given.items() if f"{{{k}}}" in statement})


@register("markets_vs_income_sql", _with(GEO, FACILITIES, INCOME, MVMARKETS, MVINCOME, MARKETS_VS_INCOME) +
          "SELECT neighborhood_id, district, numMarkets, round((average) * 1.000000000001e0, 4) AS average FROM mvi")
def q_markets_vs_income_sql(spark, d):
    """Facilities against income, asked for in SQL."""
    return rounded(_dashboard_sql(spark, d, "markets_vs_income"))


@register("price_per_room_sql", _with(GEO, LISTINGS, MVIDEALISTA) + """SELECT district,
  round((avg(price / nullif(CAST(totalrooms + totalbathrooms AS DOUBLE), 0))) * 1.000000000001e0, 4) AS PricePerRoom,
  round((avg(pba)) * 1.000000000001e0, 4) AS pba FROM mvidealista GROUP BY district""")
def q_price_per_room_sql(spark, d):
    """Price per room, asked for in SQL."""
    return rounded(_dashboard_sql(spark, d, "price_per_room"))


@register("rooms_vs_price_sql", ORACLE["rooms_vs_price"])
def q_rooms_vs_price_sql(spark, d):
    """Rooms against price, asked for in SQL."""
    return rounded(_dashboard_sql(spark, d, "rooms_vs_price"))


@register("size_by_district_sql", ORACLE["size_by_district"])
def q_size_by_district_sql(spark, d):
    """Mean sizes, asked for in SQL."""
    return rounded(_dashboard_sql(spark, d, "size_by_district"))


# ---- keyed aggregation (A1 A2 A2b) -----------------------------------------------------------
@register("vector_mean", _with(GEO, LISTINGS) + """SELECT neighborhood_id, round((avg(price)) * 1.000000000001e0, 4) AS price,
  round((avg(size)) * 1.000000000001e0, 4) AS size, round((avg(rooms)) * 1.000000000001e0, 4) AS rooms, round((avg(bathrooms)) * 1.000000000001e0, 4) AS bathrooms,
  round((avg(priceByArea)) * 1.000000000001e0, 4) AS priceByArea FROM listings GROUP BY neighborhood_id""")
def q_vector_mean(spark, d):
    return rounded(mean_by(standins.listings(spark, d), "neighborhood_id", LISTING_FEATURES))


@register("mean_and_sum", _with(GEO, INCOME) + """SELECT neighborhood_id, round((avg(index_rfd)) * 1.000000000001e0, 4) AS index_rfd,
  round((sum(population)) * 1.000000000001e0, 4) AS population FROM income GROUP BY neighborhood_id""")
def q_mean_and_sum(spark, d):
    return rounded(mean_by(standins.income(spark, d), "neighborhood_id", ["index_rfd"], sums=["population"]))


@register("count_by_key", _with(GEO, FACILITIES) +
          "SELECT neighborhood_id, count(*) AS n_markets FROM facilities GROUP BY neighborhood_id")
def q_count_by_key(spark, d):
    return count_by(standins.facilities(spark, d), "neighborhood_id", out="n_markets")


# ---- ranking (W1 W2 W3 A3 F6) ------------------------------------------------------------------
@register("global_rank_orders", """SELECT o_orderkey, o_totalprice,
  row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS "rank" FROM orders""")
def q_global_rank_orders(spark, d):
    o = standins.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return global_rank(o, ["o_totalprice", "o_orderkey"], rank_col="rank")


RANKED_INCOME = """im AS (SELECT neighborhood_id, avg(index_rfd) AS index_rfd, avg(population) AS population
  FROM income GROUP BY neighborhood_id),
ri AS (SELECT *, row_number() OVER (ORDER BY index_rfd, neighborhood_id) - 1 AS i, count(*) OVER () AS n FROM im),
bi AS (SELECT neighborhood_id, index_rfd, population,
  CASE WHEN 3 * i < n THEN 'Low' WHEN 3 * i > 2 * n THEN 'High' ELSE 'Medium' END AS bucket FROM ri)"""


@register("rank_bucket_income", _with(GEO, INCOME, RANKED_INCOME) +
          "SELECT neighborhood_id, round((index_rfd) * 1.000000000001e0, 4) AS index_rfd, round((population) * 1.000000000001e0, 4) AS population, bucket FROM bi")
def q_rank_bucket_income(spark, d):
    means = mean_by(standins.income(spark, d), "neighborhood_id", ["index_rfd", "population"])
    return rounded(rank_bucket(means, "index_rfd", "neighborhood_id", out="bucket"))


FEATURE_SQL = _with(GEO, FACILITIES, INCOME, LISTINGS, RANKED_INCOME) + """,
nm AS (SELECT neighborhood_id, count(*) AS n_markets FROM facilities GROUP BY neighborhood_id),
lm AS (SELECT neighborhood_id, avg(price) AS price, avg(size) AS size, avg(rooms) AS rooms, avg(bathrooms) AS bathrooms,
  avg(priceByArea) AS priceByArea FROM listings GROUP BY neighborhood_id)
SELECT nm.neighborhood_id, nm.n_markets, round((lm.price) * 1.000000000001e0, 4) AS price, round((lm.size) * 1.000000000001e0, 4) AS size, round((lm.rooms) * 1.000000000001e0, 4) AS rooms,
  round((lm.bathrooms) * 1.000000000001e0, 4) AS bathrooms, round((lm.priceByArea) * 1.000000000001e0, 4) AS priceByArea, bi.bucket AS index_rfd,
  round((bi.population) * 1.000000000001e0, 4) AS population
FROM nm JOIN lm ON lm.neighborhood_id = nm.neighborhood_id JOIN bi ON bi.neighborhood_id = nm.neighborhood_id"""


@register("feature_table", FEATURE_SQL)
def q_feature_table(spark, d):
    return rounded(_features(spark, d))


def _features(spark, d):
    return build_features(standins.facilities(spark, d), standins.income(spark, d), standins.listings(spark, d))


# ---- dedup (A9 A9b F5 A11) ---------------------------------------------------------------------
LINEITEM_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedup_first_lineitem", f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(LINEITEM_REST)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedup_first_lineitem(spark, d):
    li = standins.table(spark, d, "lineitem")
    out = dedup_first(li, ["l_orderkey", "l_linenumber"], LINEITEM_REST)
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@register("dedup_first_text", """SELECT doc_id, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def q_dedup_first_text(spark, d):
    docs = standins.table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return dedup_first(docs, ["text"], ["doc_id"]).drop("text")


# ---- reconcile (J1 J2 J3 J7 J8 F1 F2 F4 U1 L2) ---------------------------------------------------
RECONCILE_SQL = _with(GEO, PLACES, CUSTOMER_PROBE, f"""vals AS (SELECT pos, unnest({LOOKUP_VALUES}) AS v FROM places)""",
                      """best AS (SELECT p.c_custkey, min(v.pos) AS pos FROM probe p JOIN vals v
  ON v.v = p.name OR v.v = lower(p.name) GROUP BY p.c_custkey)""")
RECONCILED_SELECT = """SELECT p.c_custkey, p.name, l.district, l.neighborhood, l.district_id, l.neighborhood_id
FROM probe p {how} JOIN best b ON b.c_custkey = p.c_custkey {how} JOIN places l ON l.pos = b.pos"""


def _reconciled(spark, d, how):
    out = reconcile(standins.customer_probe(spark, d), standins.places(spark, d), "name", how=how)
    return out.select("c_custkey", "name", "district", "neighborhood", "district_id", "neighborhood_id")


@register("reconcile_inner", RECONCILE_SQL + RECONCILED_SELECT.format(how=""))
def q_reconcile_inner(spark, d):
    return _reconciled(spark, d, "inner")


@register("reconcile_left", RECONCILE_SQL + RECONCILED_SELECT.format(how="LEFT"))
def q_reconcile_left(spark, d):
    return _reconciled(spark, d, "left")


def _facility_probe(spark, d):
    s = standins.table(spark, d, "supplier")
    g = standins._geo(spark, d)
    cap = F.concat(F.upper(F.substring("n_name", 1, 1)), F.lower(F.substr("n_name", F.lit(2))))
    m = F.col("s_suppkey") % 3
    name = standins.new_place(F.when(m == 0, F.col("n_name")).when(m == 1, F.lower("n_name")).otherwise(cap))
    return s.join(g, s.s_nationkey == g.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("register_id"), name.alias("name"),
        F.col("r_name").alias("district_name"), F.col("r_regionkey").cast("string").alias("district_id"),
        F.col("n_nationkey").cast("string").alias("neighborhood_id"), F.col("s_suppkey").alias("ord"))


EXTEND_SQL = _with(GEO, PLACES, "lk AS (SELECT * FROM places)", """probe AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS register_id, CASE WHEN g.r_regionkey = 4 THEN 'New ' ELSE '' END || CASE s.s_suppkey % 3
  WHEN 0 THEN g.n_name WHEN 1 THEN lower(g.n_name) ELSE upper(substr(g.n_name, 1, 1)) || lower(substr(g.n_name, 2)) END AS name, g.r_name AS district_name,
  CAST(g.r_regionkey AS VARCHAR) AS district_id, CAST(g.n_nationkey AS VARCHAR) AS neighborhood_id, s.s_suppkey AS ord
  FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey)""",
    f"vals1 AS (SELECT pos, unnest({LOOKUP_VALUES}) AS v FROM lk)",
    """m1 AS (SELECT p.register_id, min(v.pos) AS pos FROM probe p JOIN vals1 v ON v.v = p.name OR v.v = lower(p.name)
  GROUP BY p.register_id)""",
    """firsts AS (SELECT lower(p.name) AS k, arg_min(p.name, p.ord) AS nm, arg_min(p.district_name, p.ord) AS dn,
  arg_min(p.district_id, p.ord) AS did, arg_min(p.neighborhood_id, p.ord) AS nid, min(p.ord) AS ord
  FROM probe p LEFT JOIN m1 ON m1.register_id = p.register_id WHERE m1.pos IS NULL AND p.name IS NOT NULL GROUP BY lower(p.name))""",
    """minted AS (SELECT (SELECT max(pos) FROM lk) + row_number() OVER (ORDER BY ord, k) AS pos, dn AS district,
  nm AS neighborhood, dn AS district_n_reconciled, lower(dn) AS district_n, 'Q' || did AS district_id,
  nm AS neighborhood_n_reconciled, lower(nm) AS neighborhood_n, 'Q' || did || nid AS neighborhood_id FROM firsts)""",
    "ext AS (SELECT * FROM lk UNION ALL SELECT * FROM minted)",
    f"vals2 AS (SELECT pos, unnest({LOOKUP_VALUES}) AS v FROM ext)",
    """m2 AS (SELECT p.register_id, min(v.pos) AS pos FROM probe p JOIN vals2 v ON v.v = p.name OR v.v = lower(p.name)
  GROUP BY p.register_id)""") + """SELECT p.register_id, p.name, e.district, e.neighborhood,
  CASE WHEN m2.pos IS NULL THEN p.district_id ELSE e.district_id END AS district_id,
  CASE WHEN m2.pos IS NULL THEN p.neighborhood_id ELSE e.neighborhood_id END AS neighborhood_id
FROM probe p LEFT JOIN m2 ON m2.register_id = p.register_id LEFT JOIN ext e ON e.pos = m2.pos"""


@register("extend_lookup", EXTEND_SQL)
def q_extend_lookup(spark, d):
    lookup = standins.places(spark, d)  # the records name places of one region that it lacks
    probe = _facility_probe(spark, d)
    ext = extend_lookup(lookup, probe, name="name", district="district_name", district_id="district_id",
                        neighborhood_id="neighborhood_id", order=["ord"])
    out = reconcile(probe, ext, "name", how="left")
    return out.select("register_id", "name", "district", "neighborhood", "district_id", "neighborhood_id")


FALLBACK_SQL = _with(GEO, PLACES, """probe AS (SELECT c.c_custkey,
  CASE c.c_custkey % 4 WHEN 0 THEN NULL WHEN 3 THEN lower(g.n_name) ELSE g.n_name END AS fine,
  CASE WHEN c.c_custkey % 8 = 0 THEN lower(g.r_name) ELSE g.r_name END AS coarse
  FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey)""",
    """f AS (SELECT neighborhood AS k, arg_min(neighborhood_id, pos) AS nid, arg_min(district_id, pos) AS did
  FROM places GROUP BY neighborhood)""",
    "cs AS (SELECT district AS k, arg_min(district_id, pos) AS did FROM places GROUP BY district)") + """SELECT p.c_custkey,
  p.fine, p.coarse, CASE WHEN p.fine IS NOT NULL THEN f.nid END AS neighborhood_id,
  CASE WHEN p.fine IS NOT NULL THEN f.did ELSE cs.did END AS district_id
FROM probe p LEFT JOIN f ON f.k = p.fine LEFT JOIN cs ON cs.k = p.coarse AND p.fine IS NULL"""


@register("reconcile_fallback", FALLBACK_SQL)
def q_reconcile_fallback(spark, d):
    c = standins.table(spark, d, "customer")
    g = standins._geo(spark, d)
    m4, m8 = F.col("c_custkey") % 4, F.col("c_custkey") % 8
    probe = c.join(g, c.c_nationkey == g.n_nationkey).select(
        "c_custkey",
        F.when(m4 == 0, F.lit(None).cast("string")).when(m4 == 3, F.lower("n_name")).otherwise(F.col("n_name")).alias("fine"),
        F.when(m8 == 0, F.lower("r_name")).otherwise(F.col("r_name")).alias("coarse"))
    out = reconcile_with_fallback(probe, standins.places(spark, d), fine_on="fine", coarse_on="coarse")
    return out.select("c_custkey", "fine", "coarse", "neighborhood_id", "district_id")


# ---- structure (P1 P1b P3-P10 X2 X3 X8 X9 S2 F3 U3) ---------------------------------------------
UNNEST_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
  'env-' || CAST(o_orderkey // 4 AS VARCHAR) AS source_id,
  strftime(min(o_orderdate) OVER (PARTITION BY o_orderkey // 4), '%Y-%m-%d') AS "timestamp",
  row_number() OVER (PARTITION BY o_orderkey // 4 ORDER BY o_orderkey) - 1 AS pos FROM orders"""


def _unnested(spark, d, first_only):
    env = standins.order_envelopes(spark, d)
    u = unnest_envelope(env, first_only=first_only, snapshot_from_filename=True)
    return u.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "source_id",
                    "timestamp", F.col("_src.pos").alias("pos"))


@register("unnest_envelope", UNNEST_SQL)
def q_unnest_envelope(spark, d):
    return _unnested(spark, d, False)


@register("unnest_first", f"SELECT * FROM ({UNNEST_SQL}) WHERE pos = 0")
def q_unnest_first(spark, d):
    return _unnested(spark, d, True)


@register("flatten_struct", """SELECT l_orderkey, l_linenumber,
  round((CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE l_extendedprice * (1 - l_discount) END) * 1.000000000001e0, 4) AS price,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_discount END AS parkingSpacePrice,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linestatus = 'F' END AS hasParkingSpace FROM lineitem""")
def q_flatten_struct(spark, d):
    nl = standins.nested_lineitems(spark, d).select("l_orderkey", "l_linenumber", "price", "parkingSpace")
    return rounded(flatten_struct(nl, "parkingSpace"))


@register("flatten_first", """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag <> 'R' THEN CAST(round(l_tax * 100) AS INTEGER) WHEN l_linestatus <> 'F' THEN l_linenumber
       ELSE l_linenumber * 10 END AS level,
  CASE WHEN l_linestatus <> 'F' THEN l_partkey END AS address_id,
  CASE WHEN l_linestatus <> 'F' THEN l_returnflag END AS zip_code,
  CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS tree_id,
  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS n_warnings,
  l_quantity AS x_coord, l_discount AS y_coord FROM lineitem""")
def q_flatten_first(spark, d):
    nl = standins.nested_lineitems(spark, d).drop("parkingSpace", "price")
    f = flatten_first(flatten_first(nl, "addresses"), "classifications_data")
    return f.select("l_orderkey", "l_linenumber", "level", "address_id", "zip_code", "tree_id",
                    array_count("warnings").alias("n_warnings"),
                    F.col("geo_epgs_25831.x").alias("x_coord"), F.col("geo_epgs_25831.y").alias("y_coord"))


@register("drop_all_null", "SELECT *, CASE WHEN p_size > 25 THEN 'large' END AS p_flag FROM part")
def q_drop_all_null(spark, d):
    p = standins.table(spark, d, "part")
    p = p.select("*", F.lit(None).cast("string").alias("p_comment"),
                 F.when(F.col("p_size") > 25, F.lit("large")).alias("p_flag"))
    return drop_all_null(p)


@register("snapshot_date", """SELECT o_orderkey, fn AS filename, substr(fn, strpos(fn, '_') + 1, 10) AS snapshot FROM (
  SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'orders_' || strftime(o_orderdate, '%Y-%m-%d') || '.json'
    WHEN 1 THEN 'city_market_' || strftime(o_orderdate, '%Y-%m-%d') || '_v2.json'
    ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00.json' END AS fn FROM orders)""")
def q_snapshot_date(spark, d):
    o = standins.table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    m = F.col("o_orderkey") % 3
    fn = (F.when(m == 0, F.concat(F.lit("orders_"), day, F.lit(".json")))
           .when(m == 1, F.concat(F.lit("city_market_"), day, F.lit("_v2.json")))
           .otherwise(F.concat(day, F.lit("T00.json"))))
    return o.select("o_orderkey", fn.alias("filename")).withColumn("snapshot", snapshot_date("filename"))


@register("lookup_split", """WITH blocks AS (SELECT c_custkey // 8 AS b, c_custkey, c_mktsegment, c_name FROM customer),
lastb AS (SELECT max(b) FILTER (WHERE b % 2 = 0) AS me, max(b) FILTER (WHERE b % 2 = 1) AS mo FROM blocks)
SELECT CASE WHEN b % 2 = 0 THEN 'marked' ELSE 'other' END AS side,
  row_number() OVER (PARTITION BY b ORDER BY c_custkey) - 1 AS pos, c_custkey AS "key", c_mktsegment AS district,
  c_name AS neighborhood FROM blocks WHERE b = (SELECT me FROM lastb) OR b = (SELECT mo FROM lastb)""")
def q_lookup_split(spark, d):
    marked, other = read_lookup(standins.lookup_documents(spark, d))
    return (marked.select(F.lit("marked").alias("side"), "*")
                  .unionByName(other.select(F.lit("other").alias("side"), "*")))


@register("union_missing_columns", """SELECT CAST(s_suppkey AS VARCHAR) AS register_id, s_name AS name, s_acctbal AS x_coord
  FROM supplier UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), c_name, CAST(NULL AS DOUBLE) FROM customer""")
def q_union_missing_columns(spark, d):
    """Records that lack a column of the table are appended to it."""
    z = _zone(spark)
    z.overwrite(standins.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("register_id"),
                                                          F.col("s_name").alias("name"), F.col("s_acctbal").alias("x_coord")), "places")
    z.append(standins.table(spark, d, "customer").select(F.col("c_name").alias("name"), F.concat(
        F.lit("c"), F.col("c_custkey").cast("string")).alias("register_id")), "places")
    return z.read("places")


# ---- sinks (K4 K5b K7) -------------------------------------------------------------------------
CUSTOMER_COLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@register("upsert_latest", f"""WITH u AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment, 1 AS seq FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal + 200, c_mktsegment, 2 FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT c_custkey + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment, 1 FROM customer WHERE c_mktsegment = 'MACHINERY'),
latest AS (SELECT {CUSTOMER_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) AS rn FROM u) WHERE rn = 1)
SELECT c_custkey, c_name, c_nationkey, round((c_acctbal) * 1.000000000001e0, 4) AS c_acctbal, c_mktsegment FROM customer
  WHERE c_custkey NOT IN (SELECT c_custkey FROM latest)
UNION ALL SELECT c_custkey, c_name, c_nationkey, round((c_acctbal) * 1.000000000001e0, 4) AS c_acctbal, c_mktsegment FROM latest""")
def q_upsert_latest(spark, d):
    c = standins.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    b = c.where(F.col("c_mktsegment") == "BUILDING")
    updates = (b.withColumn("c_acctbal", F.col("c_acctbal") + 100).withColumn("seq", F.lit(1))
                .unionByName(b.withColumn("c_acctbal", F.col("c_acctbal") + 200).withColumn("seq", F.lit(2)))
                .unionByName(c.where(F.col("c_mktsegment") == "MACHINERY")
                              .withColumn("c_custkey", F.col("c_custkey") + 10_000_000).withColumn("seq", F.lit(1))))
    return rounded(upsert(c, updates, "c_custkey", order="seq").drop("seq"))


def _zone(spark) -> Zone:
    """A new zone in the shared checkpoint folder."""
    return Zone(spark, f"{checkpoint_dir(spark)}/zone-{uuid.uuid4().hex}")


@register("append_mart", _with(GEO, FACILITIES, MVMARKETS) +
          "SELECT 1 AS run, * FROM mvmarkets UNION ALL SELECT 2 AS run, * FROM mvmarkets")
def q_append_mart(spark, d):
    """Two runs of the facility mart appended to one table, partitioned by run."""
    z, m = _zone(spark), marts.facility_mart(standins.facilities(spark, d))
    for run in (1, 2):
        z.append(m.select(F.lit(run).alias("run"), "*"), "mvmarkets", partition_by=["run"])
    return z.read("mvmarkets")


ORDER_COLS = "o_orderkey, o_custkey, o_totalprice, o_orderdate"


@register("zone_overwrite", f"SELECT {ORDER_COLS}, o_orderpriority || '!' AS o_orderpriority FROM orders")
def q_zone_overwrite(spark, d):
    """A partitioned table written, and rebuilt from itself."""
    z = _zone(spark)
    z.overwrite(standins.table(spark, d, "orders").select(*ORDER_COLS.split(", "), "o_orderpriority"), "orders", partition_by=["o_orderpriority"])
    z.overwrite(z.read("orders").withColumn("o_orderpriority", F.concat("o_orderpriority", F.lit("!"))), "orders")
    return z.read("orders")


@register("zone_insert_new", f"SELECT {ORDER_COLS}, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS run FROM orders")
def q_zone_insert_new(spark, d):
    """Created with a primary key, then half of the orders and all of them twice: the first row of a key stays."""
    z, o = _zone(spark), standins.table(spark, d, "orders").select(*ORDER_COLS.split(", "))
    one, two = (o.withColumn("run", F.lit(k)) for k in (1, 2))
    z.ensure_table("orders", one.schema, primary_key=["o_orderkey"])
    z.insert_new("orders", one.where("o_orderkey % 2 = 0"), ["o_orderkey"])
    z.insert_new("orders", two.unionByName(o.withColumn("run", F.lit(3))), ["o_orderkey"], order=["run"])
    return z.read("orders")


@register("zone_upsert", """SELECT o_orderkey, o_orderpriority, o_custkey,
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 2 ELSE o_totalprice END AS o_totalprice FROM orders""")
def q_zone_upsert(spark, d):
    """Upsert into a partitioned table: only the partition that the updates touch is rewritten, the last update wins."""
    z, keys = _zone(spark), ["o_orderkey", "o_orderpriority"]
    o = standins.table(spark, d, "orders").select(*keys, "o_custkey", "o_totalprice")
    z.overwrite(o, "orders", partition_by=["o_orderpriority"], primary_key=keys)
    urgent = o.where("o_orderpriority = '1-URGENT'")
    updates = [urgent.withColumn("o_totalprice", F.col("o_totalprice") + k).withColumn("seq", F.lit(k)) for k in (1, 2)]
    z.upsert("orders", updates[1].unionByName(updates[0]), keys, order=["seq"])
    return z.read("orders")


@register("quality_lineitem", """SELECT count(*) AS "rows", count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates, CAST(0 AS BIGINT) AS unmatched,
  CAST((count(l_returnflag) = 0)::INTEGER + (count(l_shipdate) = 0)::INTEGER AS BIGINT) AS all_null_columns FROM lineitem""")
def q_quality_lineitem(spark, d):
    li = standins.table(spark, d, "lineitem")
    return quality_report(li, ["l_orderkey", "l_linenumber"], null_check=["l_returnflag", "l_shipdate"])


@register("quality_reconcile", RECONCILE_SQL + ", rl AS (" + RECONCILED_SELECT.format(how="LEFT") + """)
SELECT count(*) AS "rows", count(DISTINCT c_custkey) AS distinct_keys, count(*) - count(DISTINCT c_custkey) AS duplicates,
  count(*) FILTER (WHERE neighborhood_id IS NULL) AS unmatched,
  CAST((count(district) = 0)::INTEGER AS BIGINT) AS all_null_columns FROM rl""")
def q_quality_reconcile(spark, d):
    return quality_report(_reconciled(spark, d, "left"), "c_custkey", matched="neighborhood_id",
                          null_check=["district"])


# ---- model (U2 M1-M9 L1 A13): rows-only checks ----------------------------------------------------
@register("random_split", """SELECT CASE WHEN CAST('0x' || substr(md5('42:' || f.neighborhood_id), 1, 8) AS BIGINT) / 4294967296.0 < 0.7
  THEN 'train' ELSE 'test' END AS part, f.* FROM (""" + FEATURE_SQL + ") AS f")
def q_random_split(spark, d):
    feats = rounded(_features(spark, d))
    train_df, test_df = ml.split(feats, seed=42)
    return (train_df.select(F.lit("train").alias("part"), "*")
                    .unionByName(test_df.select(F.lit("test").alias("part"), "*")))


@register("rf_predict")
def q_rf_predict(spark, d):
    model, _, test_df = ml.train(_features(spark, d), seed=42)
    return ml.predict(model, test_df)


@register("rf_evaluate")
def q_rf_evaluate(spark, d):
    model, _, test_df = ml.train(_features(spark, d), seed=42)
    return ml.evaluate(ml.predict(model, test_df))


# ---- formatted zone on whole tables (P1 P2 P3 P9 P10 F1 F2 F4 J1 J1b A9 X1-X5 X12) ----------------
LISTING_RECS = """recs AS (SELECT l.l_orderkey // 4 AS block, CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS propertyCode,
  l.l_extendedprice AS price, l.l_quantity AS size, l.l_linenumber AS rooms, CAST(round(l.l_tax * 100) AS INTEGER) AS bathrooms,
  l.l_extendedprice / l.l_quantity AS priceByArea,
  CASE l.l_partkey % 7 WHEN 0 THEN g.n_name WHEN 1 THEN lower(g.n_name)
    WHEN 2 THEN upper(substr(g.n_name, 1, 1)) || lower(substr(g.n_name, 2)) WHEN 3 THEN g.r_name
    WHEN 4 THEN g.n_name || ' ' WHEN 5 THEN NULL ELSE lower(g.r_name) END AS neighborhood, g.r_name AS district,
  CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE l.l_linestatus = 'F' END AS hasParkingSpace,
  CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE l.l_discount > 0.05 END AS isParkingSpaceIncludedInPrice,
  CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE l.l_tax * 1000 END AS parkingSpacePrice, o.o_orderdate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.n_nationkey)"""
FORMAT_LISTINGS_SQL = _with(GEO, PLACES, f"vals AS (SELECT pos, unnest({LOOKUP_VALUES}) AS v FROM places)", LISTING_RECS,
    """docs AS (SELECT *, 'L' || CAST(block AS VARCHAR) AS source_id,
  strftime(min(o_orderdate) OVER (PARTITION BY block), '%Y-%m-%d') AS "timestamp" FROM recs)""",
    """best AS (SELECT d.*, (SELECT min(v.pos) FROM vals v WHERE v.v = d.neighborhood OR v.v = lower(d.neighborhood)) AS mpos
  FROM docs d)""",
    """firsts AS (SELECT b.*, row_number() OVER (PARTITION BY propertyCode, "timestamp" ORDER BY price, size, rooms, bathrooms,
  priceByArea, neighborhood NULLS FIRST, district, hasParkingSpace NULLS FIRST, isParkingSpaceIncludedInPrice NULLS FIRST,
  parkingSpacePrice NULLS FIRST) AS rn FROM best b WHERE mpos IS NOT NULL)""") + """SELECT f.propertyCode AS id, f."timestamp",
  f.source_id, f.price, f.rooms, f.bathrooms, p.neighborhood, p.district, p.district_id, p.neighborhood_id, f.hasParkingSpace,
  f.isParkingSpaceIncludedInPrice, round((f.parkingSpacePrice) * 1.000000000001e0, 4) AS parkingSpacePrice
FROM firsts f JOIN places p ON p.pos = f.mpos WHERE f.rn = 1"""


@register("format_listings_zone", FORMAT_LISTINGS_SQL)
def q_format_listings_zone(spark, d):
    """Listing documents -> unnest with snapshot date -> reconcile (inner) -> first per (id, date)
    among matched records -> flatten the parking struct."""
    out = city.format_listings(standins.listing_envelopes(spark, d), standins.places(spark, d))
    return rounded(out.select("id", "timestamp", "source_id", "price", "rooms", "bathrooms", "neighborhood", "district",
                              "district_id", "neighborhood_id", "hasParkingSpace", "isParkingSpaceIncludedInPrice",
                              "parkingSpacePrice"))


INCOME_RECS = """recs AS (SELECT 'I' || CAST(o.o_orderkey // 4 AS VARCHAR) AS _id, substr(CAST(o.o_orderdate AS VARCHAR), 1, 4) AS "Any",
  CAST(g.r_regionkey AS VARCHAR) AS Codi_Districte, g.r_name AS Nom_Districte, CAST(g.n_nationkey AS VARCHAR) AS Codi_Barri,
  CASE o.o_orderkey % 7 WHEN 0 THEN g.n_name WHEN 1 THEN lower(g.n_name)
    WHEN 2 THEN upper(substr(g.n_name, 1, 1)) || lower(substr(g.n_name, 2)) WHEN 3 THEN g.r_name
    WHEN 4 THEN g.n_name || ' ' WHEN 5 THEN NULL ELSE lower(g.r_name) END AS Nom_Barri,
  CAST(CAST(round(o.o_totalprice) AS BIGINT) AS VARCHAR) AS pop, CAST(CAST(round(c.c_acctbal) AS BIGINT) AS VARCHAR) AS idx
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey)"""
FORMAT_INCOME_SQL = _with(GEO, PLACES, f"vals AS (SELECT pos, unnest({LOOKUP_VALUES}) AS v FROM places)", INCOME_RECS,
    """best AS (SELECT r.*, (SELECT min(v.pos) FROM vals v WHERE v.v = r.Nom_Barri OR v.v = lower(r.Nom_Barri)) AS mpos
  FROM recs r)""",
    """firsts AS (SELECT b.*, row_number() OVER (PARTITION BY "Any", Codi_Districte, Codi_Barri ORDER BY _id, "Any",
  Codi_Districte, Nom_Districte, Codi_Barri, Nom_Barri NULLS FIRST, pop, idx) AS rn FROM best b WHERE mpos IS NOT NULL)""") + \
    """SELECT f."Any" || f.Codi_Districte || f.Codi_Barri AS id, f."Any" AS "year", f.pop AS population, f.idx AS index_rfd,
  f._id AS source_id, '2023-04-01 10:00:00' AS "timestamp", p.district, p.neighborhood, p.district_id, p.neighborhood_id
FROM firsts f JOIN places p ON p.pos = f.mpos WHERE f.rn = 1"""


@register("format_income_zone", FORMAT_INCOME_SQL)
def q_format_income_zone(spark, d):
    """Income documents -> unnest -> reconcile (inner) -> first per (year, district code,
    neighborhood code) in document order -> source names renamed, codes dropped."""
    return city.format_income(standins.income_envelopes(spark, d), standins.places(spark, d))


LINE_ORDER = ("_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
              "l_returnflag, l_linestatus, l_shipdate")
FACILITY_RECS = """recs AS (SELECT 'M' || CAST(l.l_orderkey // 4 AS VARCHAR) AS _id, l.l_orderkey, l.l_linenumber, l.l_partkey,
  l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate,
  CAST(l.l_suppkey AS VARCHAR) AS register_id, s.s_name AS name, CAST(l.l_shipdate AS VARCHAR) AS created,
  CASE WHEN l.l_quantity > 25 THEN 'big' END AS place, l.l_returnflag <> 'R' AS has_addr, l.l_linestatus <> 'F' AS has_cls,
  'street ' || CAST(l.l_partkey AS VARCHAR) AS address_name, l.l_linenumber AS addr_level,
  CAST(g.r_regionkey AS VARCHAR) AS a_did, g.r_name AS a_dname, CAST(g.n_nationkey AS VARCHAR) AS a_nid,
  CASE WHEN g.r_regionkey = 4 THEN 'New ' ELSE '' END || CASE l.l_partkey % 3 WHEN 0 THEN g.n_name WHEN 1 THEN lower(g.n_name)
    ELSE upper(substr(g.n_name, 1, 1)) || lower(substr(g.n_name, 2)) END AS a_nname,
  CAST(l.l_partkey % 1000 AS VARCHAR) AS asia_s, CAST(round(l.l_tax * 100) AS INTEGER) AS cls_level,
  CASE WHEN l.l_discount > 0.05 THEN 1 ELSE 0 END AS n_warnings, l.l_quantity AS x_coord, l.l_discount AS y_coord
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN geo g ON s.s_nationkey = g.n_nationkey)"""
FORMAT_FACILITIES_SQL = _with(GEO, PLACES, "lk AS (SELECT * FROM places)", FACILITY_RECS,
    f"""dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY register_id, substr(created, 1, 4)
  ORDER BY {LINE_ORDER}) AS rn FROM recs) WHERE rn = 1)""",
    """flat AS (SELECT *, CASE WHEN has_cls THEN cls_level WHEN has_addr THEN addr_level END AS level,
  CASE WHEN has_addr THEN address_name END AS address_name_f, CASE WHEN has_addr THEN a_did END AS district_id,
  CASE WHEN has_addr THEN a_dname END AS district_name, CASE WHEN has_addr THEN a_nid END AS neighborhood_id,
  CASE WHEN has_addr THEN a_nname END AS neighborhood_name, CASE WHEN has_cls THEN '/markets' END AS full_path,
  CASE WHEN has_cls THEN CAST(asia_s AS BIGINT) END AS asia_id FROM dd)""",
    f"vals1 AS (SELECT pos, unnest({LOOKUP_VALUES}) AS v FROM lk)",
    """m1 AS (SELECT f.*, (SELECT min(v.pos) FROM vals1 v WHERE v.v = f.neighborhood_name OR v.v = lower(f.neighborhood_name))
  AS mpos FROM flat f)""",
    f"""firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(neighborhood_name) ORDER BY {LINE_ORDER}) AS r
  FROM m1 WHERE mpos IS NULL AND neighborhood_name IS NOT NULL) WHERE r = 1)""",
    f"""minted AS (SELECT (SELECT max(pos) FROM lk) + row_number() OVER (ORDER BY {LINE_ORDER}, lower(neighborhood_name)) AS pos,
  district_name AS district, neighborhood_name AS neighborhood, district_name AS district_n_reconciled,
  lower(district_name) AS district_n, 'Q' || district_id AS district_id, neighborhood_name AS neighborhood_n_reconciled,
  lower(neighborhood_name) AS neighborhood_n, 'Q' || district_id || neighborhood_id AS neighborhood_id FROM firsts)""",
    "ext AS (SELECT * FROM lk UNION ALL SELECT * FROM minted)",
    f"vals2 AS (SELECT pos, unnest({LOOKUP_VALUES}) AS v FROM ext)",
    """m2 AS (SELECT f.*, (SELECT min(v.pos) FROM vals2 v WHERE v.v = f.neighborhood_name OR v.v = lower(f.neighborhood_name))
  AS mpos2 FROM flat f)""") + """SELECT m.register_id, m.name, m.created, m.place, m.level, m.address_name_f AS address_name,
  m.full_path, m.asia_id, m.n_warnings, m.x_coord, m.y_coord, m._id AS source_id, '2023-03-01 09:00:00' AS "timestamp",
  e.district, e.neighborhood, CASE WHEN m.mpos2 IS NULL THEN m.district_id ELSE e.district_id END AS district_id,
  CASE WHEN m.mpos2 IS NULL THEN m.neighborhood_id ELSE e.neighborhood_id END AS neighborhood_id
FROM m2 m LEFT JOIN ext e ON e.pos = m.mpos2"""


@register("format_facilities_zone", FORMAT_FACILITIES_SQL)
def q_format_facilities_zone(spark, d):
    """Facility documents -> unnest -> first per (register_id, year created) -> flatten first
    address then first classification -> counts/coordinates -> drop fixed and all-NULL columns ->
    mint dictionary rows for unmatched places -> reconcile (left) against the extended dictionary."""
    lookup = standins.places(spark, d)  # the records name places of one region that it lacks
    table, _ = city.format_facilities(standins.facility_envelopes(spark, d), lookup)
    return table.select("register_id", "name", "created", "place", "level", "address_name", "full_path", "asia_id",
                        "n_warnings", "x_coord", "y_coord", "source_id", "timestamp", "district", "neighborhood",
                        "district_id", "neighborhood_id")


FIRST_LISTINGS_SQL = _with(GEO, PLACES, LISTING_RECS,
    """docs AS (SELECT *, 'L' || CAST(block AS VARCHAR) AS source_id,
  'idealista_' || strftime(min(o_orderdate) OVER (PARTITION BY block), '%Y-%m-%d') || '.json' AS filename,
  row_number() OVER (PARTITION BY block ORDER BY propertyCode, price, size, rooms, bathrooms, priceByArea,
    neighborhood NULLS FIRST, district, hasParkingSpace NULLS FIRST, isParkingSpaceIncludedInPrice NULLS FIRST,
    parkingSpacePrice NULLS FIRST) - 1 AS pos FROM recs)""",
    """firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY propertyCode ORDER BY filename, source_id, pos) AS rn
  FROM docs WHERE pos = 0) WHERE rn = 1)""",
    """f AS (SELECT neighborhood AS k, arg_min(neighborhood_id, pos) AS nid, arg_min(district_id, pos) AS did
  FROM places GROUP BY neighborhood)""",
    "cs AS (SELECT district AS k, arg_min(district_id, pos) AS did FROM places GROUP BY district)") + """SELECT r.propertyCode,
  r.source_id, r.neighborhood, r.district, round((r.price) * 1.000000000001e0, 4) AS price,
  CASE WHEN r.neighborhood IS NOT NULL THEN f.nid END AS neighborhood_id,
  CASE WHEN r.neighborhood IS NOT NULL THEN f.did ELSE cs.did END AS district_id
FROM firsts r LEFT JOIN f ON f.k = r.neighborhood LEFT JOIN cs ON cs.k = r.district AND r.neighborhood IS NULL"""


@register("format_listings_first_zone", FIRST_LISTINGS_SQL)
def q_format_listings_first_zone(spark, d):
    """Listing documents -> element 0 of each -> first per propertyCode in document order -> exact
    neighborhood match, district fallback when the neighborhood is missing."""
    out = city.format_listings_first(standins.listing_envelopes(spark, d), standins.places(spark, d))
    return rounded(out.select("propertyCode", "source_id", "neighborhood", "district", "price", "neighborhood_id",
                              "district_id"))


QUALITY_REPORT_SQL = _with(GEO, PLACES, f"vals AS (SELECT pos, unnest({LOOKUP_VALUES}) AS v FROM places)", LISTING_RECS,
    """docs AS (SELECT *, strftime(min(o_orderdate) OVER (PARTITION BY block), '%Y-%m-%d') AS snap FROM recs)""",
    """m AS (SELECT d.*, (SELECT min(v.pos) FROM vals v WHERE v.v = d.neighborhood OR v.v = lower(d.neighborhood)) AS mpos
  FROM docs d)""") + """SELECT count(*) AS "rows", count(DISTINCT (propertyCode, snap)) AS distinct_keys,
  count(*) - count(DISTINCT (propertyCode, snap)) AS duplicates, count(*) FILTER (WHERE mpos IS NULL) AS unmatched,
  CAST((count(neighborhood) = 0)::INTEGER + (count(hasParkingSpace) = 0)::INTEGER AS BIGINT) AS all_null_columns FROM m"""


@register("quality_report", QUALITY_REPORT_SQL)
def q_quality_report(spark, d):
    """Zone-boundary counters for the listing documents: records read, distinct (property code,
    snapshot date) keys, duplicates, records the dictionary does not match, all-NULL columns."""
    rows = unnest_envelope(standins.listing_envelopes(spark, d), snapshot_from_filename=True)
    rows = reconcile(rows, standins.places(spark, d), "neighborhood", take=[], how="left", match_pos="_mp")
    return quality_report(rows, ["propertyCode", "timestamp"], matched="_mp", null_check=["neighborhood", "parkingSpace"])


from citylake.plans import lake_queries  # noqa: E402,F401  (registers its queries)
