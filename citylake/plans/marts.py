"""The three yearly / per-place marts of the exploitation zone.

Each is one ``groupBy().agg()``: partial aggregation runs before the shuffle, so the shuffle
carries one row per (partition, group) whatever the input size or key skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions.columns import to_double, year_text


def listing_mart(listings: DataFrame, *, key: str = "neighborhood_id", ts: str = "timestamp",
                 district: str = "district") -> DataFrame:
    """``mvidealista``: per (place, year of snapshot, district) means, counts and sums."""
    return listings.groupBy(F.col(key), year_text(ts).alias("Year"), F.col(district)).agg(
        F.avg("price").alias("price"),
        F.avg("rooms").alias("rooms"),
        F.avg("bathrooms").alias("bathrooms"),
        F.count("rooms").alias("count"),
        F.avg("priceByArea").alias("pba"),
        F.sum("rooms").alias("totalrooms"),
        F.sum("bathrooms").alias("totalbathrooms"),
        F.avg("size").alias("mean_size"))


def facility_mart(facilities: DataFrame, *, key: str = "neighborhood_id", district: str = "district",
                  id_col: str = "register_id") -> DataFrame:
    """``mvmarkets``: facilities per (place, district)."""
    return facilities.groupBy(key, district).agg(F.count(id_col).alias("numMarkets"))


def income_mart(income: DataFrame, *, key: str = "neighborhood_id", ts: str = "timestamp",
                value: str = "index_rfd", mode: str = "strict") -> DataFrame:
    """``mvincome``: mean income index (text cast to double) per (place, year).

    The year comes from ``ts``; the reference uses the ingestion timestamp there (pass
    ``ts="year"`` for the survey year).
    """
    return income.groupBy(F.col(key), year_text(ts).alias("Year")).agg(
        F.avg(to_double(value, mode)).alias("average"))
