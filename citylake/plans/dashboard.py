"""The four dashboard queries over the marts, as DataFrames (the data behind each chart)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions.columns import safe_ratio


def markets_vs_income(mvmarkets: DataFrame, mvincome: DataFrame, *, key: str = "neighborhood_id") -> DataFrame:
    """Per place: its district and facility count, and the mean income index over the join.

    The SQL form joins every facility row of a place with every income row of it and averages
    over those pairs. Each income row appears once per facility row, so that average equals the
    mean over the place's income rows; both sides are therefore reduced to one row per place
    first and joined 1:1 — no pair is ever produced. The SQL's bare ``district, numMarkets``
    columns are pinned to the facility row with the smallest district.
    """
    m = mvmarkets.groupBy(key).agg(F.min("district").alias("district"),
                                   F.min_by("numMarkets", "district").alias("numMarkets"))
    i = mvincome.groupBy(key).agg(F.avg("average").alias("average"))
    return m.join(i, key, "inner").select(key, "district", "numMarkets", "average")


def markets_by_district(per_place: DataFrame) -> DataFrame:
    """Bar heights of the facilities chart: mean facility count per district."""
    return per_place.groupBy("district").agg(F.avg("numMarkets").alias("numMarkets"))


def rooms_vs_price(mvidealista: DataFrame) -> DataFrame:
    """Scatter data: rooms + bathrooms against mean price per area, coloured by district."""
    return mvidealista.select((F.col("rooms") + F.col("bathrooms")).alias("rooms_bathrooms"),
                              F.col("pba").alias("rph"), F.col("district"))


def price_per_room(mvidealista: DataFrame, *, clip: tuple[float, float] | None = None) -> DataFrame:
    """Per district: mean of price / (total rooms + total bathrooms), zero denominators skipped,
    and mean price per area. ``clip`` keeps only districts whose value lies in the range (the
    chart's x-axis limits)."""
    out = mvidealista.groupBy("district").agg(
        F.avg(safe_ratio("price", F.col("totalrooms") + F.col("totalbathrooms"))).alias("PricePerRoom"),
        F.avg("pba").alias("pba"))
    if clip is not None:
        out = out.where(F.col("PricePerRoom").between(clip[0], clip[1]))
    return out


def size_by_district(mvidealista: DataFrame) -> DataFrame:
    """Mean of the per-place mean sizes, per district (unweighted)."""
    return mvidealista.groupBy("district").agg(F.avg("mean_size").alias("mean_size"))


def run_sql(spark, statement: str, **marts: DataFrame) -> DataFrame:
    """Run a caller's statement, in which ``{name}`` stands for the mart given under that name. The
    session's own views are left alone."""
    return spark.sql(statement, **marts)
