"""Registered queries of landing JSON, growing lake tables, label indexes, evaluation and mergeable marts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake import schemas
from citylake.operators.encode import category_maps, class_report, confusion, evaluation, label_index
from citylake.operators.quality import reject_counts
from citylake.operators.schema import union_growing
from citylake.plans import city, mart_state, standins
from citylake.plans.registry import ORACLE, register, rounded
from citylake.session import checkpoint_dir, drop_folder, fresh_path, shuffles_freed
from citylake.sources.landing import read_landing_checked, split_landing
from citylake.sources.tables import Tables


def _tables(spark) -> Tables:
    """A new database in the shared checkpoint folder."""
    name = f"lake_{uuid.uuid4().hex}"
    return Tables(spark, name, f"{checkpoint_dir(spark)}/{name}")


# ---- landing JSON, readable or not (S1 X12 K7) -------------------------------------------------
#: Envelopes of about 8 KB: some 32 MB of text a file.
LINES_PER_FILE = 4000
#: Landing in batches: each reads the tables again, so their number is bounded, and a batch is a fixed share of a large input.
RECORDS_PER_BATCH, MOST_BATCHES = 4_000_000, 16


def _landing_json(spark, envelopes: DataFrame) -> str:
    """The envelopes as JSON lines in a new shared folder, and beside them one broken copy of every second one: cut off, without id, without
    data, with a text in place of the records, or no JSON at all. The files are compressed, as field names repeat in every record, and short,
    since a compressed file is read by one task."""
    path = fresh_path(spark, "landing")
    whole = F.to_json(F.struct("*"))
    k = F.regexp_extract("_id", "[0-9]+", 0).cast("long")
    records = [c for c in envelopes.columns if c not in ("_id", "data")]
    broken = (F.when(k % 10 == 0, F.substring(whole, F.lit(1), F.length(whole) - 2))
              .when(k % 10 == 1, F.to_json(F.struct(*records, "data")))
              .when(k % 10 == 2, F.to_json(F.struct("_id", *records)))
              .when(k % 10 == 3, F.to_json(F.struct("_id", *records, F.lit("no records").alias("data"))))
              .when(k % 10 == 4, F.lit("<html>not found</html>")))
    lines = F.filter(F.array(whole, broken), lambda x: x.isNotNull())
    with shuffles_freed(spark):
        (envelopes.select(F.explode(lines).alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
         .text(path))
    return path


def _landed(spark, envelopes: DataFrame, schema) -> tuple[DataFrame, DataFrame]:
    return split_landing(read_landing_checked(spark, _landing_json(spark, envelopes), schema))


def _landed_batches(spark, envelopes: DataFrame, schema, records: int) -> Iterator[DataFrame]:
    """The accepted envelopes in batches, dealt by a hash of their id. The condition is on the packing key alone, so the rows of other batches
    go before they are shuffled. A batch's landing files are deleted when the next one is asked for."""
    n = max(1, min(MOST_BATCHES, -(-records // RECORDS_PER_BATCH)))
    for k in range(n):
        path = _landing_json(spark, envelopes.where(F.pmod(F.xxhash64("_id"), F.lit(n)) == k) if n > 1 else envelopes)
        try:
            yield split_landing(read_landing_checked(spark, path, schema))[0]
        finally:
            drop_folder(spark, path)


@register("format_income_json", ORACLE["format_income_zone"])
def q_format_income_json(spark, d):
    """Income documents read from JSON lines, broken ones rejected, and formatted."""
    return city.format_income(_landed(spark, standins.income_envelopes(spark, d), schemas.INCOME_ENVELOPE)[0], standins.places(spark, d))


@register("format_listings_json", ORACLE["format_listings_zone"])
def q_format_listings_json(spark, d):
    """Listing documents read from JSON lines, broken ones rejected, and formatted."""
    accepted, _ = _landed(spark, standins.listing_envelopes(spark, d), schemas.LISTING_ENVELOPE)
    out = city.format_listings(accepted, standins.places(spark, d))
    return rounded(out.select("id", "timestamp", "source_id", "price", "rooms", "bathrooms", "neighborhood", "district",
                              "district_id", "neighborhood_id", "hasParkingSpace", "isParkingSpaceIncludedInPrice", "parkingSpacePrice"))


@register("format_facilities_json", ORACLE["format_facilities_zone"])
def q_format_facilities_json(spark, d):
    """Facility documents (their lineitem columns included) read from JSON lines, broken ones rejected, and formatted."""
    given = standins.facility_envelopes(spark, d)
    batches = _landed_batches(spark, given, given.schema, standins.table(spark, d, "lineitem").count())
    table, _ = city.format_facility_batches(batches, standins.places(spark, d))
    return table.select("register_id", "name", "created", "place", "level", "address_name", "full_path", "asia_id",
                        "n_warnings", "x_coord", "y_coord", "source_id", "timestamp", "district", "neighborhood",
                        "district_id", "neighborhood_id")


@register("landing_rejects", """WITH b AS (SELECT DISTINCT o_orderkey // 4 AS k FROM orders),
r AS (SELECT CASE WHEN k % 10 IN (0, 3, 4) THEN 'malformed' WHEN k % 10 = 1 THEN 'missing _id' WHEN k % 10 = 2 THEN 'missing data' END AS reason FROM b)
SELECT reason, count(*) AS rejected FROM r WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'accepted', count(*) FROM b""")
def q_landing_rejects(spark, d):
    """Number of income envelopes rejected by reason, beside those accepted."""
    accepted, rejected = _landed(spark, standins.income_envelopes(spark, d), schemas.INCOME_ENVELOPE)
    return reject_counts(rejected).unionAll(accepted.agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("rejected")))


# ---- tables that grow with their batches (U3 K1) -----------------------------------------------
GROWN = """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_totalprice, o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_custkey AS BIGINT) END AS cust, CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_orderdate AS VARCHAR) END AS ordered,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 100 ELSE o_orderkey * 1000 END AS line FROM orders"""


def _order_batches(spark, d) -> tuple[DataFrame, DataFrame]:
    """Even orders in an early form, odd ones with more fields: a wider number, two nested fields and a column."""
    o = standins.table(spark, d, "orders")
    early = o.where("o_orderkey % 2 = 0").select(
        F.col("o_orderkey").cast("int").alias("o_orderkey"), "o_totalprice", F.struct(F.col("o_orderstatus").alias("status")).alias("info"),
        F.array(F.struct((F.col("o_orderkey") % 100).cast("int").alias("line"))).alias("lines"))
    late = o.where("o_orderkey % 2 = 1").select(
        F.col("o_orderdate").cast("string").alias("ordered"), F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.array(F.struct((F.col("o_orderkey") * 1000).cast("bigint").alias("line"), F.lit(True).alias("late"))).alias("lines"), "o_totalprice",
        F.struct(F.struct(F.col("o_custkey").cast("bigint").alias("cust")).alias("who"), F.col("o_orderpriority").alias("priority"),
                 F.col("o_orderstatus").alias("status")).alias("info"))
    return early, late


def _flat(grown: DataFrame) -> DataFrame:
    return grown.select("o_orderkey", "o_totalprice", "info.status", "info.priority", "info.who.cust", "ordered", F.col("lines")[0]["line"].alias("line"))


@register("grow_table", GROWN)
def q_grow_table(spark, d):
    """Two batches with differing columns, nested fields and number types appended to one catalog table."""
    tables, (early, late) = _tables(spark), _order_batches(spark, d)
    tables.append(early, "orders")
    tables.append(late, "orders")
    return _flat(tables.read("orders"))


@register("union_growing", GROWN)
def q_union_growing(spark, d):
    """The same two batches in one plan, later form first."""
    early, late = _order_batches(spark, d)
    return _flat(union_growing(late, early))


# ---- catalog tables (K1 K2 K3 K5a K5b S3) ------------------------------------------------------
ORDERS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]


@register("table_append", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def q_table_append(spark, d):
    """Created empty with partitions and a key, then two appends whose columns come in another order."""
    tables, o = _tables(spark), standins.table(spark, d, "orders").select(*ORDERS)
    tables.create("orders", o.schema, partition_by=["o_orderstatus"], primary_key=["o_orderkey"])
    for part in (0, 1):
        tables.append(o.where(F.col("o_orderkey") % 2 == part).select(*reversed(ORDERS)), "orders")
    return tables.read("orders").select(*ORDERS)


@register("table_replace", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus || '!' AS o_orderstatus FROM orders")
def q_table_replace(spark, d):
    """A partitioned table rebuilt from itself."""
    tables, o = _tables(spark), standins.table(spark, d, "orders").select(*ORDERS)
    tables.replace(o, "orders", partition_by=["o_orderstatus"])
    tables.replace(tables.read("orders").withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit("!"))), "orders")
    return tables.read("orders").select(*ORDERS)


@register("table_replace_partitions", """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice, o_orderstatus
FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 3 = 0""")
def q_table_replace_partitions(spark, d):
    """One status's partition replaced by a third of its orders; the others stay as they are."""
    tables, o = _tables(spark), standins.table(spark, d, "orders").select(*ORDERS)
    tables.replace(o, "orders", partition_by=["o_orderstatus"])
    tables.replace_partitions(o.where("o_orderstatus = 'F' AND o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(0.0)), "orders")
    return tables.read("orders").select(*ORDERS)


@register("table_insert_new", "SELECT o_orderkey, o_custkey, o_totalprice, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS run FROM orders")
def q_table_insert_new(spark, d):
    """Half of the orders, then all of them, twice: the first row of a key stays."""
    tables, o = _tables(spark), standins.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    for rows in (o.where("o_orderkey % 2 = 0").withColumn("run", F.lit(1)), o.withColumn("run", F.lit(2)), o.withColumn("run", F.lit(3))):
        tables.insert_new(rows, "orders", ["o_orderkey"], order=["run"])
    return tables.read("orders")


@register("table_upsert", """SELECT o_orderstatus, o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_orderstatus = 'O' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
FROM orders""")
def q_table_upsert(spark, d):
    """Updates of one status's orders, each given twice; the later one wins, and only that partition is written."""
    tables, o = _tables(spark), standins.table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    tables.replace(o, "orders", partition_by=["o_orderstatus"], primary_key=["o_orderstatus", "o_orderkey"])
    some = o.where("o_orderkey % 3 = 0 AND o_orderstatus = 'O'")
    updates = some.withColumn("at", F.lit(1)).unionByName(some.withColumn("o_totalprice", -F.col("o_totalprice")).withColumn("at", F.lit(2)))
    tables.upsert(updates, "orders", ["o_orderstatus", "o_orderkey"], order=["at"])
    return tables.read("orders").select("o_orderstatus", "o_orderkey", "o_totalprice")


# ---- marts by mergeable partials (A4 K5b) --------------------------------------------------------
@register("listing_mart_merged", ORACLE["listing_mart"])
def q_listing_mart_merged(spark, d):
    """Three batches of listings merged one after the other into the mart's state."""
    tables, rows = _tables(spark), standins.listings(spark, d)
    for part in range(3):
        batch = rows.where(F.pmod(F.crc32(F.col("id").cast("binary")), F.lit(3)) == part)
        mart_state.add_batch(tables, "listing_state", mart_state.listing_partials(batch), mart_state.LISTING_KEYS, ["Year"])
    return rounded(mart_state.listing_mart(tables.read("listing_state")))


# ---- model steps over data alone (M2 M3 M8 A13) --------------------------------------------------
@register("label_index", """SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS "index", n FROM (
  SELECT l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR) AS label, count(*) AS n FROM lineitem GROUP BY ALL)""")
def q_label_index(spark, d):
    """Labels of lineitems by descending frequency, ties by label."""
    li = standins.table(spark, d, "lineitem")
    return label_index(li.select(F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("label")), "label")


CODED = {"l_quantity": "l_quantity", "l_linenumber": "l_linenumber", "l_discount": "l_discount", "l_tax": "l_tax", "l_extendedprice": "l_extendedprice",
         "flag": "ascii(l_returnflag) - ascii('N')", "status": "ascii(l_linestatus)", "some": "l_linenumber % 4"}


@register("category_maps", "WITH v AS (" + " UNION ALL ".join(
    f"SELECT DISTINCT '{name}' AS \"column\", CAST({sql} AS DOUBLE) AS value FROM lineitem" for name, sql in CODED.items()) + """)
SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value <> 0, value) - 1 AS INTEGER) AS "index"
FROM v WHERE "column" IN (SELECT "column" FROM v GROUP BY "column" HAVING count(*) <= 3)""")
def q_category_maps(spark, d):
    """Which numeric columns of lineitem have at most three values, and the index of each value."""
    li = standins.table(spark, d, "lineitem")
    return category_maps(li.select(*[F.expr(sql).alias(name) for name, sql in CODED.items()]), list(CODED), 3)


GUESSED = """SELECT l_returnflag AS label, CASE WHEN l_quantity > 25 THEN 'N' WHEN l_discount > 0.05 THEN 'R' WHEN l_tax > 0.01 THEN 'A' END AS prediction FROM lineitem"""


def _guessed(spark, d) -> DataFrame:
    """Lineitems with their return flag and a guess of it by fixed rules."""
    guess = F.when(F.col("l_quantity") > 25, "N").when(F.col("l_discount") > 0.05, "R").when(F.col("l_tax") > 0.01, "A")
    return standins.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("label"), guess.alias("prediction"))


@register("confusion_flags", f"SELECT label, prediction, count(*) AS n FROM ({GUESSED}) GROUP BY ALL")
def q_confusion_flags(spark, d):
    return confusion(_guessed(spark, d), "label", "prediction")


@register("evaluation_flags", f"""SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy,
  1.0 - avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS test_error, count(*) AS n_test FROM ({GUESSED})""")
def q_evaluation_flags(spark, d):
    return evaluation(confusion(_guessed(spark, d), "label", "prediction"))


@register("class_report_flags", f"""WITH g AS ({GUESSED}), c AS (SELECT DISTINCT label AS class FROM g UNION SELECT DISTINCT prediction FROM g WHERE prediction IS NOT NULL)
SELECT class, n, n_predicted, n_hit, n_hit / nullif(CAST(n_predicted AS DOUBLE), 0) AS "precision", n_hit / nullif(CAST(n AS DOUBLE), 0) AS recall FROM (
  SELECT class, (SELECT count(*) FROM g WHERE label = class) AS n, (SELECT count(*) FROM g WHERE prediction = class) AS n_predicted,
    (SELECT count(*) FROM g WHERE label = class AND prediction = class) AS n_hit FROM c)""")
def q_class_report_flags(spark, d):
    return class_report(confusion(_guessed(spark, d), "label", "prediction"))
