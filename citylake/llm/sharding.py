"""Sharding by rendezvous hashing over weighted shards.

Every shard bids for a record with a hash of (record key, shard) scaled by the shard's weight, and
the best bid wins. A new shard can only win records from others, so growth moves just the records
that the new shard takes, and removing a shard moves only its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import numbered

#: Stands for a null key, which is a key of its own.
NULL_KEY = "\x00null"


def rendezvous(key: Column, weights: dict[int, float]) -> Column:
    """The winning shard of ``weights`` (shard -> weight above 0) for the key.

    The bid is -ln(u) / weight with u in (0, 1) from 53 bits of xxhash64(key, shard); the smallest
    wins and shares follow the weights. A bid depends on the key and that shard alone. Equal bids go
    to the lower shard.
    """
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("weights: at least one shard, all weights above 0")
    text = F.coalesce(key.cast("string"), F.lit(NULL_KEY))
    bids = []
    for shard, weight in sorted(weights.items()):
        u = (F.shiftrightunsigned(F.xxhash64(text, F.lit(int(shard))), 11).cast("double") + 0.5) / float(1 << 53)
        bids.append(F.struct((-F.log(u) / float(weight)).alias("bid"), F.lit(int(shard)).alias("shard")))
    return (F.least(*bids) if len(bids) > 1 else bids[0])["shard"]


def assign_shards(df: DataFrame, key_col: str, weights: dict[int, float], shard: str = "shard") -> DataFrame:
    """``df`` with the shard of every row. No shuffle; rows with equal keys, null included, share a
    shard; an empty table stays empty."""
    return df.withColumn(shard, rendezvous(F.col(f"`{key_col}`"), weights))


def shard_slots(docs: DataFrame, weights: dict[int, float], grown: dict[int, float] | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``size`` (UTF-8 bytes of the text plus 1, null: 1), ``text_crc32``
    (unsigned; null as for the empty text), ``shard``, ``slot`` (gapless from 0 in each shard, in the
    order of the id) and ``grown_shard`` (the shard under the weights ``grown``).

    The text is read once and not shuffled. Rows repeated under one id keep an order by their
    checksum and then by their place in the input, so that a hot id spreads over partitions.
    """
    key, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    small = docs.select(
        key.alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), rendezvous(key, weights).alias("shard"),
        (rendezvous(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_place"))
    return (numbered(small, "shard", ["id", "text_crc32", "_place"], "slot").drop("_place")
            .withColumnRenamed("id", id_col))


def write_shards(docs: DataFrame, path: str, key_col: str, weights: dict[int, float], shard: str = "shard",
                 max_rows_per_file: int = 1_000_000) -> None:
    """Write the rows as parquet, one folder per shard. Tasks write what they hold, so no shard has
    to pass through one task."""
    (assign_shards(docs, key_col, weights, shard).write.option("maxRecordsPerFile", max_rows_per_file)
     .partitionBy(shard).parquet(path))
