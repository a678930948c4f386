"""Reconcile free-text place names against an ordered dictionary, and extend the dictionary.

The reference scans the dictionary row by row for every record and takes the first row where the
name, or its lowercase form, equals *any* of the row's values. Here that nested loop becomes:

1. a value table: every dictionary value with the smallest position it occurs at, plus the
   columns to take from that row (one aggregation over the dictionary, which is small);
2. two equi left joins of the records against it, on the name and on ``lower(name)``; the smaller of the two positions
   wins. The records are evaluated once. It is one plan at every size: the value table is written once, so that its size is
   known before the records move (an estimate of it is far too large, and they would be shuffled whole by name); the
   engine broadcasts it by its bytes, and then the records aren't shuffled; a larger one meets them by name, hot names
   split by AQE, and records without a name are spread over the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.operators.rank import global_rank
from citylake.session import materialize, stored

# The place dictionary's row layout, the columns a match copies onto a record, and the
# prefix of minted identifiers.
LOOKUP_COLUMNS = ["district", "neighborhood", "district_n_reconciled", "district_n", "district_id",
                  "neighborhood_n_reconciled", "neighborhood_n", "neighborhood_id"]
TAKE_COLUMNS = ["district", "neighborhood", "district_id", "neighborhood_id"]
MINT_PREFIX = "Q"


def _value_table(lookup: DataFrame, match_cols: Sequence[str], take: Sequence[str], pos: str) -> DataFrame:
    vals = lookup.select(
        F.col(pos).alias("_pos"),
        F.explode(F.array(*[F.col(f"`{c}`").cast("string") for c in match_cols])).alias("_v"),
        *[F.col(f"`{c}`").alias(f"_t_{c}") for c in take])
    return (vals.where(F.col("_v").isNotNull())
                .groupBy("_v")
                .agg(F.min(F.struct("_pos", *[f"_t_{c}" for c in take])).alias("_m")))


def _best_match(df: DataFrame, name, vt: DataFrame, valid=None) -> DataFrame:
    """Join on the name and on its lowercase form, where ``valid``; keep the match with the smaller position."""
    exact = vt.select(F.col("_v").alias("_v1"), F.col("_m").alias("_m1"))
    lower = vt.select(F.col("_v").alias("_v2"), F.col("_m").alias("_m2"))
    also = F.lit(True) if valid is None else valid
    j = df.join(exact, (name == F.col("_v1")) & also, "left").join(lower, (F.lower(name) == F.col("_v2")) & also, "left")
    best = (F.when(F.col("_m1").isNull(), F.col("_m2"))
             .when(F.col("_m2").isNull(), F.col("_m1"))
             .when(F.col("_m1._pos") <= F.col("_m2._pos"), F.col("_m1"))
             .otherwise(F.col("_m2")))
    return j.withColumn("_best", best).drop("_v1", "_m1", "_v2", "_m2")


def reconcile(df: DataFrame, lookup: DataFrame, on: str, *, columns: Sequence[str] | None = None,
              take: Sequence[str] = TAKE_COLUMNS, how: str = "inner", pos: str = "pos",
              match_pos: str | None = None) -> DataFrame:
    """Attach dictionary columns to each record of ``df`` by its name column ``on``.

    A record matches dictionary row ``k`` when ``on`` or ``lower(on)`` equals any value of ``k``
    among ``columns`` (default: every column but ``pos``); the match with the smallest ``pos``
    wins. NULL never matches. Taken columns overwrite same-named record columns (also with a NULL
    dictionary value). ``how="inner"`` drops unmatched records; ``how="left"`` keeps them with
    their own values. ``match_pos`` names an output column with the winning position (NULL when
    unmatched).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    match_cols = list(columns) if columns is not None else [c for c in lookup.columns if c != pos]
    vt = stored(_value_table(lookup, match_cols, take, pos), "values")
    name = F.col(f"`{on}`")
    # a record without a name gets a key that no value has: a flag keeps it apart, a number spreads such records over the tasks
    spread = F.concat(F.lit("no name "), (F.monotonically_increasing_id() % 1024).cast("string"))
    keyed = df.withColumn("_named", name.isNotNull()).withColumn("_key", F.coalesce(name.cast("string"), spread))
    j = _best_match(keyed, F.col("_key"), vt, F.col("_named"))
    if how == "inner":
        j = j.where(F.col("_best").isNotNull())
    matched = F.col("_best").isNotNull()
    out = []
    for c in df.columns:
        if c in take:
            out.append(F.when(matched, F.col(f"_best._t_{c}")).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    out += [F.col(f"_best._t_{c}").alias(c) for c in take if c not in df.columns]
    if match_pos:
        out.append(F.col("_best._pos").alias(match_pos))
    return j.select(*out)


def extend_lookup(lookup: DataFrame, df: DataFrame, *, name: str, district: str, district_id: str,
                  neighborhood_id: str, order: Iterable[str], pos: str = "pos",
                  prefix: str = MINT_PREFIX, checkpoint: bool = True) -> DataFrame:
    """Append one minted dictionary row per name of ``df`` that matches nothing.

    Names are grouped by their lowercase form; each new row comes from the first record of its
    group in ``order`` and gets ``prefix + district_id`` / ``prefix + district_id + neighborhood_id``
    as ids. New rows are placed after the existing ones, in order of their first record, so a
    later ``reconcile`` against the result matches every record of those names.

    The result is a dictionary (small, read several times by the next ``reconcile``: size check
    and two joins), so by default it is checkpointed to the session's checkpoint folder, which
    also cuts the lineage back to the records it was derived from.
    """
    order = list(order)
    probe = reconcile(df.select(*{name, district, district_id, neighborhood_id, *order}), lookup, name,
                      take=[], how="left", pos=pos, match_pos="_mp")
    unmatched = probe.where(F.col("_mp").isNull() & F.col(f"`{name}`").isNotNull())
    first = (unmatched
             .groupBy(F.lower(F.col(f"`{name}`")).alias("_key"))
             .agg(F.min(F.struct(*[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)],
                                 F.col(f"`{name}`").alias("_name"),
                                 F.col(f"`{district}`").cast("string").alias("_district"),
                                 F.col(f"`{district_id}`").cast("string").alias("_did"),
                                 F.col(f"`{neighborhood_id}`").cast("string").alias("_nid"))).alias("_f"))
             .select("_key", "_f.*"))
    first = _mint_in_order(materialize(first), [f"_o{i}" for i in range(len(order))] + ["_key"])
    ranked = global_rank(first, [f"_o{i}" for i in range(len(order))] + ["_key"], rank_col="_r")
    top = lookup.agg(F.max(pos).alias("_max")).first()["_max"]
    base = -1 if top is None else int(top)
    minted = ranked.select(
        (F.lit(base + 1) + F.col("_r")).cast(lookup.schema[pos].dataType).alias(pos),
        F.col("_district").alias("district"),
        F.col("_name").alias("neighborhood"),
        F.col("_district").alias("district_n_reconciled"),
        F.lower("_district").alias("district_n"),
        F.concat(F.lit(prefix), "_did").alias("district_id"),
        F.col("_name").alias("neighborhood_n_reconciled"),
        F.lower("_name").alias("neighborhood_n"),
        F.concat(F.lit(prefix), "_did", "_nid").alias("neighborhood_id"))
    extended = lookup.unionByName(minted, allowMissingColumns=True)
    return materialize(extended) if checkpoint else extended


def _mint_in_order(first: DataFrame, order: Sequence[str]) -> DataFrame:
    """The candidates that a record-by-record run would mint: not those whose name is the district of a
    row minted before them.

    A candidate that no earlier candidate blocks is minted; one that a minted row blocks is dropped;
    the rest waits for the next round. Most inputs have no blocked name and need no round; others one per
    link of a chain of names.
    """
    at = F.struct(*[F.col(c) for c in order])
    rows = first.withColumn("_at", at)
    # per district, the earliest candidate that has it: if that one is minted, it blocks the name
    blocks = rows.select("_key", F.lower("_district").alias("_blocks"), "_at").where(F.col("_blocks").isNotNull())
    links = blocks.alias("b").join(rows.select(F.col("_key").alias("_name_key"), F.col("_at").alias("_name_at")).alias("n"),
                                   (F.col("_blocks") == F.col("_name_key")) & (F.col("b._at") < F.col("_name_at"))).select("_key", "_name_key")
    links = materialize(links)
    if links.isEmpty():
        return first
    minted = rows.select("_key").join(links.select(F.col("_name_key").alias("_key")), "_key", "left_anti")
    dropped = minted.limit(0)
    while True:
        by = minted.withColumnRenamed("_key", "_m")
        dropped = materialize(links.join(by, links["_key"] == by["_m"], "left_semi").select(F.col("_name_key").alias("_key")).distinct())
        gone = dropped.withColumnRenamed("_key", "_d")
        open_ = links.join(gone, links["_key"] == gone["_d"], "left_anti").select(F.col("_name_key").alias("_key")).distinct()
        now = materialize(rows.select("_key").join(open_, "_key", "left_anti"))  # every blocker is dropped
        if now.join(minted, "_key", "left_anti").isEmpty():
            return first.join(now, "_key", "left_semi")
        minted = now


def reconcile_with_fallback(df: DataFrame, lookup: DataFrame, *, fine_on: str, coarse_on: str,
                            fine_col: str = "neighborhood", coarse_col: str = "district",
                            fine_ids: Sequence[str] = ("neighborhood_id", "district_id"),
                            coarse_ids: Sequence[str] = ("district_id",), pos: str = "pos") -> DataFrame:
    """Exact-name match on one column, and a coarse fallback when the fine name is missing.

    When ``fine_on`` is present the first dictionary row whose ``fine_col`` equals it gives
    ``fine_ids`` (NULL when none does, no fallback). When ``fine_on`` is NULL the first row whose
    ``coarse_col`` equals ``coarse_on`` gives ``coarse_ids``; the other ids stay NULL.
    """
    def first_by(col: str, ids: Sequence[str], tag: str):
        return (lookup.where(F.col(col).isNotNull())
                      .groupBy(F.col(col).alias(f"_{tag}k"))
                      .agg(F.min(F.struct(F.col(pos).alias("_pos"), *[F.col(i).alias(i) for i in ids])).alias(f"_{tag}")))

    fine, coarse = first_by(fine_col, fine_ids, "f"), first_by(coarse_col, coarse_ids, "c")
    fcol, ccol = F.col(f"`{fine_on}`"), F.col(f"`{coarse_on}`")

    # each distinct (fine, coarse) pair is resolved once, then the records meet the pairs in one null-safe join
    pairs = df.select(fcol.alias("_fn"), ccol.alias("_cn")).distinct()
    resolved = (pairs.join(fine, F.col("_fn") == F.col("_fk"), "left")
                .join(coarse, F.col("_fn").isNull() & (F.col("_cn") == F.col("_ck")), "left").select("_fn", "_cn", "_f", "_c"))
    j = df.join(resolved, fcol.eqNullSafe(F.col("_fn")) & ccol.eqNullSafe(F.col("_cn")), "left")
    ids = list(dict.fromkeys([*fine_ids, *coarse_ids]))
    out = [F.col(f"`{c}`") for c in df.columns if c not in ids]
    for i in ids:
        fine_v = F.col(f"_f.{i}") if i in fine_ids else F.lit(None)
        coarse_v = F.col(f"_c.{i}") if i in coarse_ids else F.lit(None)
        out.append(F.when(fcol.isNotNull(), fine_v).otherwise(coarse_v).alias(i))
    return j.select(*out)
