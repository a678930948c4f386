"""Keyed counts and means (the reference's ``map((k, 1)).reduceByKey`` and vector-mean reducers)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions.columns import to_double


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def count_by(df: DataFrame, key, *, out: str = "count") -> DataFrame:
    """Rows per key (partial counts are combined map-side)."""
    return df.groupBy(*_names(key)).agg(F.count(F.lit(1)).alias(out))


def mean_by(df: DataFrame, key, cols: Sequence[str], *, sums: Sequence[str] = (), mode: str = "strict",
            prefix: str = "", count_col: str | None = None) -> DataFrame:
    """Per key: mean of each of ``cols`` and sum of each of ``sums``, all as double.

    Text numbers are cast (``mode="strict"`` fails on malformed text, ``"lenient"`` skips it as
    NULL); NULLs are skipped by the mean.
    """
    aggs = [F.avg(to_double(c, mode)).alias(f"{prefix}{c}") for c in cols]
    aggs += [F.sum(to_double(c, mode)).alias(f"{prefix}{c}") for c in sums]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(*_names(key)).agg(*aggs)
