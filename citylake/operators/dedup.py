"""First-wins deduplication with a fixed order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def dedup_first(df: DataFrame, keys, order, *, keep: str = "first") -> DataFrame:
    """Keep, per key, the row that comes first (``keep="last"``: last) in ``order``.

    NULL keys form one group. Ties in ``order`` are broken by the rest of the row's content, so
    the kept row never depends on partitioning. The plan is one aggregation of
    ``min(struct(order..., other columns))``: it combines map-side before the shuffle, so a key holding a
    third of the table still reaches the shuffle as one row per input partition.
    """
    keys, order = _names(keys), _names(order)
    if not keys:
        raise ValueError("dedup_first needs at least one key")
    cols = df.columns
    # pack (order..., other columns); keys come back from the grouping, order columns from the
    # pack, so no column is carried twice through the sort and the shuffle
    rest = [c for c in cols if c not in keys and c not in order]
    if not rest and not order:
        return df.distinct()
    packed = F.struct(*[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(f"`{c}`").alias(f"_r{i}") for i, c in enumerate(rest)])
    pick = F.min(packed) if keep == "first" else F.max(packed)
    src = {**{c: f"_m._o{i}" for i, c in enumerate(order)}, **{c: f"_m._r{i}" for i, c in enumerate(rest)}}
    grouped = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(pick.alias("_m"))
    return grouped.select(*[F.col(f"`{c}`") if c in keys else F.col(src[c]).alias(c) for c in cols])


def dedup_first_window(df: DataFrame, keys, order, *, keep: str = "first") -> DataFrame:
    """Same result through ``row_number``; kept as the cross-check used by the tests.

    Spark keeps one row per key and task before the exchange here too.
    """
    keys, order = _names(keys), _names(order)
    cols = df.columns
    ob = [F.col(c) for c in order] + [F.col(f"`{c}`") for c in cols]
    if keep != "first":
        ob = [c.desc_nulls_last() for c in ob]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*ob)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def duplicate_count(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """One row: ``rows``, ``keys`` (distinct, NULL-safe) and ``duplicates`` = rows - keys."""
    keys = _names(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("keys")) \
                  .select(F.coalesce("rows", F.lit(0)).alias("rows"), "keys",
                          (F.coalesce("rows", F.lit(0)) - F.col("keys")).alias("duplicates"))
