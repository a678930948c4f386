"""Marts kept by mergeable partials: sums and counts per group, into which a new batch is merged.

A mean can't be merged, its sum and count can. The state of a mart is one row per group; a batch is reduced to such rows, and only the
state's partitions that the batch touches are read and written again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions.columns import year_text
from citylake.sources.tables import Tables

#: Output columns of the listing mart by source column: means, sums, and the count.
LISTING_MEANS = {"price": "price", "rooms": "rooms", "bathrooms": "bathrooms", "pba": "priceByArea", "mean_size": "size"}
LISTING_SUMS = {"totalrooms": "rooms", "totalbathrooms": "bathrooms"}


def partials(df: DataFrame, keys: Sequence, values: Sequence[str]) -> DataFrame:
    """Per group and value its sum and its number of non-NULL values, partially aggregated before the shuffle."""
    return df.groupBy(*keys).agg(*[f for v in dict.fromkeys(values) for f in (F.sum(f"`{v}`").alias(f"sum_{v}"), F.count(f"`{v}`").alias(f"n_{v}"))])


def merge(*states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state of several over different rows; the order of the states doesn't matter."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    return both.groupBy(*keys).agg(*[F.sum(f"`{c}`").cast(both.schema[c].dataType).alias(c) for c in both.columns if c not in keys])


def means(state: DataFrame, keys: Sequence[str], mean: dict[str, str], total: dict[str, str] | None = None, count: dict[str, str] | None = None) -> DataFrame:
    """The mart: means, sums and counts by output name."""
    return state.select(*keys, *[F.try_divide(F.col(f"sum_{v}").cast("double"), F.col(f"n_{v}")).alias(k) for k, v in mean.items()],
                        *[F.col(f"sum_{v}").alias(k) for k, v in (total or {}).items()], *[F.col(f"n_{v}").alias(k) for k, v in (count or {}).items()])


def add_batch(tables: Tables, table: str, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Merge a batch's partials into the state table. Only partitions with groups of the batch are read and replaced. A batch must be
    given once: sums don't know which rows they hold."""
    keys = list(keys)
    if not tables.exists(table):
        tables.append(batch, table, partition_by=partition_by)
        return
    touched = batch.select(*[F.col(f"`{c}`").alias(f"_t{i}") for i, c in enumerate(partition_by)]).distinct()
    state = tables.read(table).join(touched, [F.col(f"`{c}`").eqNullSafe(F.col(f"_t{i}")) for i, c in enumerate(partition_by)], "left_semi")
    tables.rewrite_partitions(merge(state, batch, keys=keys), table)


LISTING_KEYS = ("neighborhood_id", "Year", "district")


def listing_partials(listings: DataFrame, *, key: str = "neighborhood_id", ts: str = "timestamp", district: str = "district") -> DataFrame:
    """The listing mart's state over one batch."""
    return partials(listings, [F.col(key).alias("neighborhood_id"), year_text(ts).alias("Year"), F.col(district).alias("district")],
                    [*LISTING_MEANS.values(), *LISTING_SUMS.values()])


def listing_mart(state: DataFrame) -> DataFrame:
    """``mvidealista`` from its state."""
    return means(state, LISTING_KEYS, LISTING_MEANS, LISTING_SUMS, {"count": "rooms"})
