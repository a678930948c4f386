"""The city configuration: landing documents -> formatted zone -> exploitation zone.

Order of steps per source follows the reference: facilities dedup *before* matching and extend
the shared dictionary; income is matched against that extended dictionary and then deduplicated;
listings are matched first and deduplicated among matched records. Every step is a lazy
DataFrame plan; the facility rows and the extended dictionary are checkpointed because several
jobs read them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake import schemas
from citylake.functions.columns import array_count
from citylake.operators.dedup import dedup_first
from citylake.operators.quality import observe_counts
from citylake.operators.reconcile import extend_lookup, reconcile, reconcile_with_fallback
from citylake.operators.shape import (SRC, drop_all_null, drop_columns, flatten_first, flatten_struct, rename,
                                     unnest_envelope)
from citylake.plans import dashboard, marts
from citylake.plans.features import build_features
from citylake.session import drop_folder, fresh_path, materialize, shuffles_freed, stored
from citylake.sources.landing import read_landing, read_lookup
from citylake.sources.zone import Zone

# Columns the reference removes from facility records after flattening.
FACILITY_DROP = ["id", "geo_epgs_25831", "geo_epgs_23031", "geo_epgs_4326", "addresses", "classifications_data",
                 "secondary_filters_data", "attribute_categories", "entity_types_data", "values", "image_data",
                 "status_name", "location", "gallery_data", "warnings", "sections_data", "tickets_data",
                 "from_relationships", "to_relationships", "timetable"]
FLATTEN_INPUTS = ["addresses", "classifications_data", "warnings", "geo_epgs_25831"]
# Source-language income column names and their formatted names.
INCOME_RENAME = {"Població": "population", "Any": "year", "Índex RFD Barcelona = 100": "index_rfd"}
INCOME_DROP = ["Nom_Districte", "Nom_Barri", "Codi_Districte", "Codi_Barri"]
LISTING_STRUCTS = ["parkingSpace", "detailedType", "suggestedTexts"]


def format_facilities(envelopes: DataFrame, lookup: DataFrame,
                      counters: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """``table_markets`` and the dictionary extended with the facilities' unmatched places."""
    rows = _first_facilities(_facility_records(envelopes, counters))
    return _match_facilities(_flat_facilities(rows), lookup, counters)


def format_facility_batches(batches: Iterable[DataFrame], lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``format_facilities`` of documents that come in batches, in any order. Between batches the first records so far are kept; a batch
    isn't read again once the next one is asked for, so what a batch shuffles and occupies is gone before the next one comes."""
    kept = at = None
    for envelopes in batches:
        spark, rows = envelopes.sparkSession, _facility_records(envelopes)
        path = fresh_path(spark, "facilities")
        with shuffles_freed(spark):
            now = stored(_first_facilities(rows if kept is None else kept.unionByName(rows)), "facilities", path)
        if kept is not None:
            drop_folder(spark, at)
        kept, at = now, path
    if kept is None:
        raise ValueError("format_facility_batches needs at least one batch")
    rows = _flat_facilities(kept)
    drop_folder(kept.sparkSession, at)
    return _match_facilities(rows, lookup)


def _facility_records(envelopes: DataFrame, counters: dict | None = None) -> DataFrame:
    rows = _observe(unnest_envelope(envelopes), counters, "facilities_read")
    # fields the reference deletes and no later step reads leave before the dedup shuffle (the
    # dedup carries whole rows, so the optimizer cannot prune them); the order is total (_src),
    # so the kept rows are the same
    return drop_columns(rows, [c for c in FACILITY_DROP if c not in FLATTEN_INPUTS])


def _first_facilities(rows: DataFrame) -> DataFrame:
    """First record per (register id, year created). The first of firsts is the first of all, so batches can be joined one by one."""
    return dedup_first(rows.withColumn("_created_year", F.substring(F.col("created").cast("string"), 1, 4)),
                       ["register_id", "_created_year"], [SRC]).drop("_created_year")


def _flat_facilities(rows: DataFrame) -> DataFrame:
    rows = flatten_first(rows, "addresses")
    rows = flatten_first(rows, "classifications_data")
    rows = rows.withColumns({
        "n_warnings": array_count("warnings"),
        "x_coord": F.col("geo_epgs_25831.x"),
        "y_coord": F.col("geo_epgs_25831.y"),
        "asia_id": F.col("asia_id").cast("bigint"),
    })
    # the flattened rows feed three consumers (all-NULL scan, dictionary extension, final match):
    # write them once to the checkpoint folder instead of re-running unnest + dedup for each
    return materialize(drop_columns(rows, FACILITY_DROP))


def _match_facilities(rows: DataFrame, lookup: DataFrame, counters: dict | None = None) -> tuple[DataFrame, DataFrame]:
    rows = drop_all_null(rows, [c for c in rows.columns if c != SRC])
    for c in ("district_name", "neighborhood_name", "district_id", "neighborhood_id"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    extended = extend_lookup(lookup, rows, name="neighborhood_name", district="district_name",
                             district_id="district_id", neighborhood_id="neighborhood_id", order=[SRC])
    table = reconcile(rows, extended, "neighborhood_name", how="left", match_pos="_matched")
    table = _observe(table, counters, "facilities_kept", unmatched=F.col("_matched").isNull())
    return table.drop("district_name", "neighborhood_name", SRC, "_matched"), extended


def format_income(envelopes: DataFrame, lookup: DataFrame, counters: dict | None = None) -> DataFrame:
    """``table_income``: matched records, first per (year, district code, neighborhood code)."""
    rows = _observe(unnest_envelope(envelopes), counters, "income_read")
    rows = _observe(reconcile(rows, lookup, "Nom_Barri", how="inner"), counters, "income_matched")
    rows = dedup_first(rows, ["Any", "Codi_Districte", "Codi_Barri"], [SRC])
    rows = rows.withColumn("id", F.concat(F.col("Any").cast("string"), F.col("Codi_Districte").cast("string"),
                                          F.col("Codi_Barri").cast("string")))
    rows = drop_columns(rename(rows, INCOME_RENAME), INCOME_DROP)
    return _observe(rows.select("id", "year", "population", "index_rfd", "source_id", "timestamp", "district",
                                "neighborhood", "district_id", "neighborhood_id"), counters, "income_kept")


def format_listings(envelopes: DataFrame, lookup: DataFrame, counters: dict | None = None) -> DataFrame:
    """``table_idealista``: matched listings, first per (id, snapshot date), structs flattened.

    With ``counters`` (a dict), run counters are attached to the plan (``Observation``) and filled
    by whatever action runs it: records read, records matched, rows kept.
    """
    rows = unnest_envelope(envelopes, snapshot_from_filename=True)
    rows = _observe(rows, counters, "listings_read")
    rows = reconcile(rows, lookup, "neighborhood", how="inner")
    rows = _observe(rows, counters, "listings_matched")
    rows = rows.withColumn("propertyCode", F.col("propertyCode").cast("string")).withColumnRenamed("propertyCode", "id")
    rows = dedup_first(rows, ["id", "timestamp"], [SRC])
    for s in LISTING_STRUCTS:
        if s in rows.columns:
            rows = flatten_struct(rows, s)
    return _observe(rows.drop(SRC), counters, "listings_kept")


def _observe(df: DataFrame, counters: dict | None, name: str, **conditions) -> DataFrame:
    if counters is None:
        return df
    out, obs = observe_counts(df, name, **conditions)
    counters[name] = obs
    return out


def counter_values(counters: dict) -> dict[str, int]:
    """Read observed counters (after the action that ran the plans) and derive duplicates removed."""
    vals = {}
    for name, obs in counters.items():
        got = obs.get
        vals[name] = got.get("rows", 0)
        for k, v in got.items():
            if k != "rows":
                vals[f"{name}_{k}"] = v
    for src in ("listings", "income"):
        if f"{src}_matched" in vals and f"{src}_kept" in vals:
            vals[f"{src}_duplicates_removed"] = vals[f"{src}_matched"] - vals[f"{src}_kept"]
    return vals


def format_listings_first(envelopes: DataFrame, lookup: DataFrame) -> DataFrame:
    """The first formatter's flow: element 0 of each document, first per ``propertyCode`` in
    document order (before any matching, unmatched records stay), then an exact neighborhood
    match for ``neighborhood_id`` / ``district_id``, or, when the neighborhood is missing, the
    district's first dictionary row for ``district_id``."""
    rows = unnest_envelope(envelopes, first_only=True)
    rows = dedup_first(rows.withColumn("propertyCode", F.col("propertyCode").cast("string")), ["propertyCode"], [SRC])
    rows = reconcile_with_fallback(rows, lookup, fine_on="neighborhood", coarse_on="district")
    return rows.drop(SRC)


@dataclass
class LandingPaths:
    lookup: str
    listings: str
    facilities: str
    income: str


def format_zone(spark: SparkSession, landing: LandingPaths, zone: Zone) -> dict:
    """Read the four landing collections and write the three formatted tables.

    Returns the table paths and ``counters``: records read, matched and kept per source, duplicates
    removed, facilities left unmatched; collected by the write jobs themselves (no extra pass).
    """
    counters: dict = {}
    lk_docs = read_landing(spark, landing.lookup, schemas.LOOKUP_ENVELOPE)
    listing_lookup, open_lookup = read_lookup(lk_docs)
    facilities, extended = format_facilities(read_landing(spark, landing.facilities, schemas.FACILITY_ENVELOPE),
                                             open_lookup, counters)
    income = format_income(read_landing(spark, landing.income, schemas.INCOME_ENVELOPE), extended, counters)
    listings = format_listings(read_landing(spark, landing.listings, schemas.LISTING_ENVELOPE), listing_lookup,
                               counters)
    out = {
        "table_markets": zone.overwrite(facilities, "table_markets"),
        "table_income": zone.overwrite(income, "table_income"),
        "table_idealista": zone.overwrite(listings, "table_idealista"),
    }
    out["counters"] = counter_values(counters)
    return out


def exploitation_zone(formatted: Zone, exploitation: Zone) -> dict[str, str]:
    """Feature table (keyed upsert into ``model_data``) and the three marts (replaced)."""
    markets = formatted.read("table_markets")
    income = formatted.read("table_income")
    listings = formatted.read("table_idealista")
    features = build_features(markets, income, listings)
    exploitation.ensure_table("model_data", schemas.MODEL_DATA_SCHEMA, primary_key=["neighborhood_id"])
    out = {"model_data": exploitation.upsert("model_data", features, ["neighborhood_id"])}
    out["mvidealista"] = exploitation.overwrite(marts.listing_mart(listings), "mvidealista")
    out["mvmarkets"] = exploitation.overwrite(marts.facility_mart(markets), "mvmarkets")
    out["mvincome"] = exploitation.overwrite(marts.income_mart(income), "mvincome")
    return out


def dashboard_data(exploitation: Zone) -> dict[str, DataFrame]:
    """The data behind the four charts."""
    mvi, mvm, mvinc = (exploitation.read(n) for n in ("mvidealista", "mvmarkets", "mvincome"))
    per_place = dashboard.markets_vs_income(mvm, mvinc)
    return {
        "markets_vs_income": per_place,
        "markets_by_district": dashboard.markets_by_district(per_place),
        "rooms_vs_price": dashboard.rooms_vs_price(mvi),
        "price_per_room": dashboard.price_per_room(mvi),
        "size_by_district": dashboard.size_by_district(mvi),
    }


__all__ = ["FACILITY_DROP", "INCOME_DROP", "INCOME_RENAME", "LandingPaths", "counter_values", "dashboard_data",
           "exploitation_zone", "format_facilities", "format_facility_batches", "format_income", "format_listings",
           "format_listings_first", "format_zone"]
