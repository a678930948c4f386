"""Run counters at zone boundaries: duplicates removed, records unmatched, rejected, all-null columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def quality_report(df: DataFrame, keys, *, matched: str | None = None,
                   null_check: Sequence[str] | None = None) -> DataFrame:
    """One-row report over ``df`` computed in one pass plus one keyed aggregation.

    Columns: ``rows``, ``distinct_keys`` (NULL-safe), ``duplicates`` (= rows - distinct_keys),
    ``unmatched`` (rows where ``matched`` is NULL; 0 without it) and ``all_null_columns`` (how many
    of ``null_check`` hold only NULLs).
    """
    keys = _names(keys)
    checks = list(null_check or [])
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        (F.count_if(F.col(matched).isNull()) if matched else F.lit(0)).alias("_u"),
        *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(checks)])
    agg = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum("_u"), F.lit(0)).cast("long").alias("unmatched"),
        *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(checks))])
    nulls = sum((F.when(F.col(f"_c{i}") == 0, 1).otherwise(0) for i in range(len(checks))), F.lit(0))
    return agg.select("rows", "distinct_keys", (F.col("rows") - F.col("distinct_keys")).alias("duplicates"),
                      "unmatched", nulls.cast("long").alias("all_null_columns"))


def observe_counts(df: DataFrame, name: str, **conditions) -> tuple[DataFrame, Observation]:
    """Attach run counters to a plan without an extra job (``Observation``); read them after an action.

    ``conditions`` maps a counter name to a boolean column; ``rows`` is always counted.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(cond).alias(k) for k, cond in conditions.items()]
    return df.observe(obs, *metrics), obs


def reject_counts(rejected: DataFrame, reason: str = "reject_reason") -> DataFrame:
    """(reason, rejected): number of rejected rows by reason, counted in each task before the shuffle."""
    return rejected.groupBy(F.col(reason).alias("reason")).agg(F.count(F.lit(1)).alias("rejected"))
