"""Stand-in inputs built from the driver's TPC-H-like tables.

Roles: nation = neighborhood, region = district, supplier = facility, customer/orders = income
survey, lineitem/orders = listings. These builders only give rows in the schema each job expects
(renames, casts, joins to dimension tables, packing into documents); the jobs themselves live in
``operators`` and ``plans`` and do not rely on how these rows were made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _geo(spark, d) -> DataFrame:
    """nation + region names (dimension join; both are dimension tables)."""
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_regionkey", "r_name")


def _order_places(spark, d) -> DataFrame:
    """Each order with its customer's nation and region: the smaller side, joined first, so the
    lineitem rows meet one join. At scale neither orders nor customer can be broadcast, and the
    left-deep order (lineitem x orders, then x customer) would shuffle the lineitem-sized result a
    second time; this order shuffles lineitem once. (On one machine, where both are broadcast, it
    measured about 15% slower: one larger hash table instead of two narrow ones.)"""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    g = _geo(spark, d)
    return (o.join(c, o.o_custkey == c.c_custkey).join(g, F.col("c_nationkey") == g.n_nationkey)
             .select("o_orderkey", "o_orderdate", "c_nationkey", "n_nationkey", "n_name", "r_regionkey", "r_name"))


def places(spark: SparkSession, d: str) -> DataFrame:
    """The place dictionary in its landing layout, ``pos`` = nation key."""
    g = _geo(spark, d)
    return g.select(
        F.col("n_nationkey").cast("long").alias("pos"),
        F.col("r_name").alias("district"),
        F.col("n_name").alias("neighborhood"),
        F.col("r_name").alias("district_n_reconciled"),
        F.lower("r_name").alias("district_n"),
        F.col("r_regionkey").cast("string").alias("district_id"),
        F.col("n_name").alias("neighborhood_n_reconciled"),
        F.lower("n_name").alias("neighborhood_n"),
        F.col("n_nationkey").cast("string").alias("neighborhood_id"))


def facilities(spark: SparkSession, d: str) -> DataFrame:
    """Formatted facilities (``table_markets`` columns used downstream)."""
    s = table(spark, d, "supplier")
    g = _geo(spark, d)
    return s.join(g, s.s_nationkey == g.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("register_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("x_coord"),
        F.col("r_name").alias("district"),
        F.col("n_name").alias("neighborhood"),
        F.col("r_regionkey").cast("string").alias("district_id"),
        F.col("n_nationkey").cast("string").alias("neighborhood_id"))


def income(spark: SparkSession, d: str) -> DataFrame:
    """Formatted income records; numbers arrive as text, as in the source."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    g = _geo(spark, d)
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(g, F.col("c_nationkey") == g.n_nationkey)
             .select(F.col("o_orderkey").cast("string").alias("id"),
                     F.substring(F.col("o_orderdate").cast("string"), 1, 4).alias("year"),
                     F.col("o_totalprice").cast("string").alias("population"),
                     F.col("c_acctbal").cast("string").alias("index_rfd"),
                     F.col("o_custkey").cast("string").alias("source_id"),
                     F.col("o_orderdate").cast("string").alias("timestamp"),
                     F.col("r_name").alias("district"),
                     F.col("n_name").alias("neighborhood"),
                     F.col("r_regionkey").cast("string").alias("district_id"),
                     F.col("c_nationkey").cast("string").alias("neighborhood_id")))


def listings(spark: SparkSession, d: str) -> DataFrame:
    """Formatted listings (``table_idealista`` columns used downstream)."""
    li = table(spark, d, "lineitem")
    return (li.join(_order_places(spark, d), li.l_orderkey == F.col("o_orderkey"))
              .select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
                      F.col("l_extendedprice").alias("price"),
                      F.col("l_quantity").alias("size"),
                      F.col("l_linenumber").alias("rooms"),
                      F.round(F.col("l_tax") * 100).cast("int").alias("bathrooms"),
                      (F.col("l_extendedprice") / F.col("l_quantity")).alias("priceByArea"),
                      F.col("o_orderdate").cast("string").alias("timestamp"),
                      F.col("r_name").alias("district"),
                      F.col("n_name").alias("neighborhood"),
                      F.col("r_regionkey").cast("string").alias("district_id"),
                      F.col("c_nationkey").cast("string").alias("neighborhood_id")))


def _by_block(rows: DataFrame, key: str, per_doc: int) -> DataFrame:
    """Hash-partition raw rows by document block before records are built and collected.

    Packing records gains nothing from map-side partial aggregation (``collect_list`` does not
    shrink), so the one shuffle moves plain columns and the record building runs after it, in
    parallel, instead of in the scan tasks.
    """
    block = F.floor(F.col(key) / per_doc).cast("long")
    return rows.withColumn("block", block).repartition("block")


def new_place(name) -> "F.Column":
    """The name, or for a place of region 4 a name that the dictionary lacks."""
    return F.concat(F.when(F.col("r_regionkey") == 4, F.lit("New ")).otherwise(F.lit("")), name)


def name_variant(name, region, k) -> "F.Column":
    """A free-text spelling of a place name: exact, lowercase, capitalised, the region's name,
    trailing space (never matches), missing, lowercase region. ``k`` picks one of the seven."""
    cap = F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substr(name, F.lit(2))))
    m = k % 7
    return (F.when(m == 0, name).when(m == 1, F.lower(name)).when(m == 2, cap).when(m == 3, region)
             .when(m == 4, F.concat(name, F.lit(" "))).when(m == 5, F.lit(None).cast("string"))
             .otherwise(F.lower(region)))


def customer_probe(spark: SparkSession, d: str) -> DataFrame:
    """Customers with a free-text place name (income-survey records before reconciliation)."""
    c = table(spark, d, "customer")
    g = _geo(spark, d)
    return c.join(g, c.c_nationkey == g.n_nationkey).select(
        "c_custkey", name_variant(F.col("n_name"), F.col("r_name"), F.col("c_custkey")).alias("name"))


def order_envelopes(spark: SparkSession, d: str, per_doc: int = 4) -> DataFrame:
    """Orders packed into landing documents of at most ``per_doc`` consecutive order keys.

    ``filename`` carries the date of the block's first order after an ``_``.
    """
    o = table(spark, d, "orders")
    block = F.floor(F.col("o_orderkey") / per_doc).cast("long")
    return (o.groupBy(block.alias("block"))
             .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_custkey", "o_orderstatus",
                                                       "o_totalprice", "o_orderpriority"))).alias("data"),
                  F.min("o_orderdate").alias("_first"), F.max("o_orderdate").alias("_last"))
             .select(F.concat(F.lit("env-"), F.col("block").cast("string")).alias("_id"),
                     F.concat(F.lit("orders_"), F.date_format("_first", "yyyy-MM-dd"), F.lit(".json")).alias("filename"),
                     F.col("_last").cast("string").alias("timestamp"),
                     "data"))


def nested_lineitems(spark: SparkSession, d: str) -> DataFrame:
    """Lineitems as nested facility-like records: an optional struct, two arrays of structs that
    share a field name with each other and with a top-level column, a warnings array and a
    coordinate struct."""
    li = table(spark, d, "lineitem")
    parking = F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.struct(
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price"),
        F.col("l_discount").alias("parkingSpacePrice"),
        (F.col("l_linestatus") == "F").alias("hasParkingSpace")))
    addresses = F.when(F.col("l_linestatus") == "F", F.array().cast(
        "array<struct<address_id:bigint,level:int,zip_code:string>>")).otherwise(F.array(
            F.struct(F.col("l_partkey").alias("address_id"), F.col("l_linenumber").alias("level"),
                     F.col("l_returnflag").alias("zip_code")),
            F.struct(F.col("l_suppkey").alias("address_id"), F.lit(-1).alias("level"),
                     F.lit("second").alias("zip_code"))))
    classes = F.when(F.col("l_returnflag") == "R", F.array().cast(
        "array<struct<tree_id:bigint,level:int>>")).otherwise(F.array(
            F.struct(F.col("l_suppkey").alias("tree_id"),
                     F.round(F.col("l_tax") * 100).cast("int").alias("level"))))
    warnings = F.when(F.col("l_linestatus") == "O", F.array(F.col("l_shipdate").cast("string"))) \
                .otherwise(F.array().cast("array<string>"))
    return li.select("l_orderkey", "l_linenumber",
                     F.col("l_extendedprice").alias("price"),
                     (F.col("l_linenumber") * 10).alias("level"),
                     parking.alias("parkingSpace"),
                     addresses.alias("addresses"),
                     classes.alias("classifications_data"),
                     warnings.alias("warnings"),
                     F.struct(F.col("l_quantity").alias("x"), F.col("l_discount").alias("y")).alias("geo_epgs_25831"))


def lookup_documents(spark: SparkSession, d: str, per_doc: int = 8, marker: str | None = None) -> DataFrame:
    """Customers packed into dictionary documents of ``per_doc`` keys; even blocks carry the
    listings' dictionary file name, odd blocks another one."""
    from citylake.sources.landing import LISTING_LOOKUP_FILE
    c = table(spark, d, "customer")
    block = F.floor(F.col("c_custkey") / per_doc).cast("long")
    docs = c.groupBy(block.alias("_id")).agg(F.sort_array(F.collect_list(F.struct(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("district"),
        F.col("c_name").alias("neighborhood")))).alias("data"))
    return docs.select("_id", F.when(F.col("_id") % 2 == 0, F.lit(marker or LISTING_LOOKUP_FILE))
                       .otherwise(F.lit("lookup_opendata.csv")).alias("filename"), "data")


def listing_envelopes(spark: SparkSession, d: str, per_doc: int = 4) -> DataFrame:
    """Lineitems as property-listing records in landing documents (one per ``per_doc`` order keys).

    ``propertyCode`` is ``orderkey-linenumber`` (repeated keys occur in the table), the place name
    is a free-text spelling of the customer's nation, ``parkingSpace`` an optional struct; the file
    name carries the date of the block's first order.
    """
    li = table(spark, d, "lineitem")
    parking = F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.struct(
        (F.col("l_linestatus") == "F").alias("hasParkingSpace"),
        (F.col("l_discount") > 0.05).alias("isParkingSpaceIncludedInPrice"),
        (F.col("l_tax") * 1000).alias("parkingSpacePrice")))
    rec = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("propertyCode"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("size"),
        F.col("l_linenumber").alias("rooms"),
        F.round(F.col("l_tax") * 100).cast("int").alias("bathrooms"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("priceByArea"),
        name_variant(F.col("n_name"), F.col("r_name"), F.col("l_partkey")).alias("neighborhood"),
        F.col("r_name").alias("district"),
        parking.alias("parkingSpace"))
    # lineitems and orders meet by block, where their records are packed, and only then by key (equality as two comparisons, which don't
    # become join keys): the lineitems are shuffled once, not by key and again by block, and without the names that the orders bring
    li = _by_block(li, "l_orderkey", per_doc)
    places = _by_block(_order_places(spark, d), "o_orderkey", per_doc).withColumnRenamed("block", "_block")
    joined = li.join(places, (F.col("block") == F.col("_block")) & (F.col("l_orderkey") >= F.col("o_orderkey")) & (F.col("l_orderkey") <= F.col("o_orderkey")))
    rows = joined.select("block", "o_orderdate", rec.alias("rec"))
    return (rows.groupBy("block")
                .agg(F.sort_array(F.collect_list("rec")).alias("data"), F.min("o_orderdate").alias("_first"))
                .select(F.concat(F.lit("L"), F.col("block").cast("string")).alias("_id"),
                        F.concat(F.lit("idealista_"), F.date_format("_first", "yyyy-MM-dd"), F.lit(".json")).alias("filename"),
                        F.lit("2023-05-11").alias("timestamp"), "data"))


def income_envelopes(spark: SparkSession, d: str, per_doc: int = 4) -> DataFrame:
    """Orders as income-survey records (source-language names, numbers as text) in documents."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    g = _geo(spark, d)
    rec = F.struct(
        F.substring(F.col("o_orderdate").cast("string"), 1, 4).alias("Any"),
        F.col("r_regionkey").cast("string").alias("Codi_Districte"),
        F.col("r_name").alias("Nom_Districte"),
        F.col("n_nationkey").cast("string").alias("Codi_Barri"),
        name_variant(F.col("n_name"), F.col("r_name"), F.col("o_orderkey")).alias("Nom_Barri"),
        F.round(F.col("o_totalprice")).cast("bigint").cast("string").alias("Població"),
        F.round(F.col("c_acctbal")).cast("bigint").cast("string").alias("Índex RFD Barcelona = 100"))
    rows = (_by_block(o.join(c, o.o_custkey == c.c_custkey).join(g, F.col("c_nationkey") == g.n_nationkey),
                      "o_orderkey", per_doc)
             .select("block", rec.alias("rec")))
    return (rows.groupBy("block").agg(F.sort_array(F.collect_list("rec")).alias("data"))
                .select(F.concat(F.lit("I"), F.col("block").cast("string")).alias("_id"),
                        F.lit("income.json").alias("filename"), F.lit("2023-04-01 10:00:00").alias("timestamp"),
                        "data"))


def facility_envelopes(spark: SparkSession, d: str, per_doc: int = 4) -> DataFrame:
    """Lineitems as facility observations of their supplier, in landing documents.

    Each record starts with ``line`` (the lineitem's columns) so that document order is fully
    defined; ``addresses`` / ``classifications_data`` are arrays of structs that may be empty and
    share the field ``level``; ``body`` is always missing.
    """
    li = table(spark, d, "lineitem")
    s = table(spark, d, "supplier")
    g = _geo(spark, d)
    cap = F.concat(F.upper(F.substring("n_name", 1, 1)), F.lower(F.substr("n_name", F.lit(2))))
    m3 = F.col("l_partkey") % 3
    hood = new_place(F.when(m3 == 0, F.col("n_name")).when(m3 == 1, F.lower("n_name")).otherwise(cap))
    addr_t = ("array<struct<address_name:string,level:int,district_id:string,district_name:string,"
              "neighborhood_id:string,neighborhood_name:string>>")
    cls_t = "array<struct<full_path:string,asia_id:string,level:int>>"
    addresses = F.when(F.col("l_returnflag") == "R", F.array().cast(addr_t)).otherwise(F.array(F.struct(
        F.concat(F.lit("street "), F.col("l_partkey").cast("string")).alias("address_name"),
        F.col("l_linenumber").alias("level"),
        F.col("r_regionkey").cast("string").alias("district_id"),
        F.col("r_name").alias("district_name"),
        F.col("n_nationkey").cast("string").alias("neighborhood_id"),
        hood.alias("neighborhood_name"))))
    classes = F.when(F.col("l_linestatus") == "F", F.array().cast(cls_t)).otherwise(F.array(F.struct(
        F.lit("/markets").alias("full_path"),
        (F.col("l_partkey") % 1000).cast("string").alias("asia_id"),
        F.round(F.col("l_tax") * 100).cast("int").alias("level"))))
    warnings = F.when(F.col("l_discount") > 0.05, F.array(F.struct(F.lit("discount").alias("message")))) \
                .otherwise(F.array().cast("array<struct<message:string>>"))
    rec = F.struct(
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate").alias("line"),
        F.concat(F.lit("f"), F.col("l_orderkey").cast("string")).alias("id"),
        F.col("l_suppkey").cast("string").alias("register_id"),
        F.col("s_name").alias("name"),
        F.col("l_shipdate").cast("string").alias("created"),
        F.lit("active").alias("status_name"),
        addresses.alias("addresses"),
        classes.alias("classifications_data"),
        warnings.alias("warnings"),
        F.struct(F.col("l_quantity").alias("x"), F.col("l_discount").alias("y")).alias("geo_epgs_25831"),
        F.lit(None).cast("string").alias("body"),
        F.when(F.col("l_quantity") > 25, F.lit("big")).alias("place"),
        F.lit(None).cast("string").alias("timetable"))
    rows = (_by_block(li.join(s, li.l_suppkey == s.s_suppkey).join(g, s.s_nationkey == g.n_nationkey), "l_orderkey", per_doc)
              .select("block", rec.alias("rec")))
    return (rows.groupBy("block").agg(F.sort_array(F.collect_list("rec")).alias("data"))
                .select(F.concat(F.lit("M"), F.col("block").cast("string")).alias("_id"),
                        F.lit("markets.json").alias("filename"), F.lit("2023-03-01 09:00:00").alias("timestamp"),
                        "data"))
