"""The model feature table: facility counts, listing means and income terciles per place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.operators.aggregate import count_by, mean_by
from citylake.operators.rank import rank_bucket

# The reference's feature columns (listing means, then income fields).
LISTING_FEATURES = ["price", "size", "rooms", "bathrooms", "priceByArea"]
INCOME_FIELDS = ["index_rfd", "population"]
FEATURE_COLUMNS = ["neighborhood_id", "n_markets", *LISTING_FEATURES, "index_rfd", "population"]


def build_features(markets: DataFrame, income: DataFrame, listings: DataFrame, *,
                   key: str = "neighborhood_id", mode: str = "strict") -> DataFrame:
    """``model_data``: one row per place present in all three inputs.

    ``n_markets`` counts facilities; listing columns are means; ``index_rfd`` is the tercile label
    (Low/Medium/High) of the place's mean income index among all places, ``population`` the mean
    population. Every aggregate is keyed and combined map-side; the ranking is the distributed
    ``global_rank``; the two joins are 1:1 on the key.
    """
    n_markets = count_by(markets, key, out="n_markets")
    lmeans = mean_by(listings, key, LISTING_FEATURES, mode=mode)
    imeans = mean_by(income, key, INCOME_FIELDS, mode=mode, prefix="_mean_")
    labelled = (rank_bucket(imeans, "_mean_index_rfd", key, out="index_rfd")
                .select(key, "index_rfd", F.col("_mean_population").alias("population")))
    return (n_markets.join(lmeans, key, "inner")
                     .join(labelled, key, "inner")
                     .select(*FEATURE_COLUMNS))
