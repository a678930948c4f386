"""Keyed upsert (``INSERT OR REPLACE`` by primary key), set-based."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.operators.dedup import dedup_first


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def unique_rows(rows: DataFrame, keys) -> DataFrame:
    """``rows`` as they are; running the plan fails when a key occurs twice (one partially
    aggregated grouping, no job while the plan is built)."""
    keys = _names(keys)
    rest = [c for c in rows.columns if c not in keys]
    packed = F.min(F.struct(*[F.col(f"`{c}`").alias(f"_r{i}") for i, c in enumerate(rest)])) if rest else F.lit(None)
    grouped = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_n"), packed.alias("_m"))
    checked = grouped.where(F.assert_true(F.col("_n") == 1, F.lit(f"a key of {keys} occurs twice and no order is given")).isNull())
    return checked.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_m._r{rest.index(c)}").alias(c) for c in rows.columns])


def last_rows(rows: DataFrame, keys, order, columns: Sequence[str] | None = None) -> DataFrame:
    """The last row per key in ``order``, or, without an order, the rows checked to be unique.
    ``order`` columns that are not among ``columns`` (the table's) are dropped."""
    if order is None:
        return unique_rows(rows, keys)
    out = dedup_first(rows, _names(keys), _names(order), keep="last")
    return out if columns is None else out.drop(*[c for c in _names(order) if c not in columns])


def upsert(target: DataFrame, updates: DataFrame, keys, *, order: Sequence[str] | str | None = None) -> DataFrame:
    """Rows of ``target`` whose key is not in ``updates``, plus ``updates`` (last per key wins).

    ``order`` is the statement order inside ``updates``; among updates with one key the one that
    comes last wins, and an order column that the target lacks is not carried over. Without an order
    the updates' keys must be unique, else the query fails. The target is filtered with an anti join on the update keys; which
    side is broadcast, if any, is the engine's choice by size. Columns are matched by name; a
    column missing on one side is NULL there.
    """
    keys = _names(keys)
    updates = last_rows(updates, keys, order, target.columns)
    update_keys = updates.select(*[F.col(f"`{k}`").alias(f"_u{i}") for i, k in enumerate(keys)])
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"_u{i}")) for i, k in enumerate(keys)]
    return target.join(update_keys, on, "left_anti").unionByName(updates, allowMissingColumns=True)


def check_unique(df: DataFrame, keys) -> None:
    """Primary-key check: raises when any key appears twice (one aggregation, one row back)."""
    keys = _names(keys)
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {tuple(dup[0][k] for k in keys)} in {keys}")
