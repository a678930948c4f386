"""Packing of token sequences by cutting-stock column generation.

Documents longer than the window give full windows; the remainders are the items of a cutting-stock
problem whose demand is the histogram of remainder lengths (at most window - 1 counts reach the driver).
A linear program over patterns, with columns priced by a knapsack, is rounded down and solved anew for what that leaves, and the
documents of each length, ranked, fill the rounded patterns. What the last round leaves over, and lengths that no tight pattern takes, are
laid end to end and cut at the window, so that only the last sequence is short.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import numbered, short_batches, staged
from citylake.llm.cutting_stock import plan
from citylake.llm.token_files import binary_rows, encode_documents
from citylake.llm.tokens import drop_encoders

ALLOCATION = "length int, lo long, hi long, copies int, first long, at int, left boolean"


def allocation_rows(histogram: dict[int, int], window: int, max_padding: int, max_columns: int | None) -> tuple[list[tuple], int]:
    """Where the ranked remainders go, and the number of sequences that takes. Rows with ``left`` hold
    in ``first`` the place of their first token, as sequence * window + offset."""
    allocations, given, sequences = plan(histogram, window, max_padding, max_columns)
    rows = [(length, lo, hi, n, first, at, False) for length, lo, hi, n, first, at in allocations]
    place = sequences * window
    for length in sorted(histogram, reverse=True):
        n = histogram[length] - given[length]
        if n:
            rows.append((length, given[length], histogram[length], 1, place, 0, True))
            place += n * length
    return rows, -(-place // window)


def pack_lengths(docs: DataFrame, window: int = 1024, max_padding: int = 2, max_columns: int | None = None) -> DataFrame:
    """(rid, n) -> (rid, n, pieces): where each of a document's tokens goes, as
    array<struct<start, length, sequence_id, offset>>. ``rid`` is unique; a document with n = 0 gets
    no piece. Only these two columns are shuffled, and the broadcast table has at most a row per
    length and pattern of each round of the program (each round below 2 * window patterns)."""
    spark = docs.sparkSession
    small = docs.select("rid", "n", (F.col("n") % window).cast("int").alias("rest"), F.expr(f"n div {window}").alias("full"), F.lit(0).alias("all"))
    counts = {r["rest"]: r["k"] for r in small.groupBy("rest").agg(F.count("*").alias("k")).collect()}
    counts.pop(0, None)
    rows, used = allocation_rows(counts, window, max_padding, max_columns)
    table = spark.createDataFrame(rows, ALLOCATION)
    ranked = numbered(small, "rest", ["rid"], "rank")
    placed = numbered(ranked, "all", ["rid"], "before", weight="full")
    t = F.broadcast(table)
    joined = placed.join(t, (F.col("rest") == F.col("length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")), "left")
    nth, start = F.col("rank") - F.col("lo"), F.col("full") * window

    def piece(start, length, sequence, offset):
        return F.struct(start.cast("long").alias("start"), length.cast("long").alias("length"),
                        sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))

    whole = F.when(F.col("full") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("full") - 1), lambda k: piece(
        k * window, F.lit(window), F.lit(used) + F.col("before") + k, F.lit(0)))).otherwise(F.array().cast("array<struct<start:long,length:long,sequence_id:long,offset:long>>"))
    place = F.col("first") + nth * F.col("length")
    head = F.least(F.col("rest"), F.lit(window) - place % window)
    sequence = F.expr(f"(first + (rank - lo) * length) div {window}")
    rest = (F.when(F.col("length").isNull(), F.array())
            .when(~F.col("left"), F.array(piece(start, F.col("rest"), F.col("first") + F.expr("(rank - lo) div copies"),
                                                F.col("at") + nth % F.col("copies") * F.col("length"))))
            .when(head == F.col("rest"), F.array(piece(start, F.col("rest"), sequence, place % window)))
            .otherwise(F.array(piece(start, head, sequence, place % window), piece(start + head, F.col("rest") - head, sequence + 1, F.lit(0)))))
    return joined.select("rid", "n", F.concat(whole, rest).alias("pieces"))


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = 1024, id_col: str = "doc_id", text_col: str = "text",
                   end_id: int = 0, max_padding: int = 2, max_columns: int | None = None, digest: bool = False) -> DataFrame:
    """One row per piece: id, ``start`` (the document's ids before it), ``length``, its ids as ``ids``
    (binary, little-endian unsigned 32 bits) or, with ``digest``, their crc32 ``ids_crc32``,
    ``doc_tokens`` (with ``end_id``), ``sequence_id`` and ``offset`` there.

    Texts are tokenized once, whole, into a staged table (null: empty, so just ``end_id``). Rows
    repeated under one id are packed each by itself; an empty table gives no rows; other columns are
    ignored. Sequences have ``window`` tokens but for the last of the leftovers and at most
    ``max_padding`` missing in a pattern.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    with short_batches(docs.sparkSession):
        tokens = staged(encode_documents(docs, tokenizer_path, "bytes", id_col, text_col, end_id)
                        .select("id", "ids", F.expr("octet_length(ids) div 2").cast("long").alias("n"), F.monotonically_increasing_id().alias("rid")), "tokens")
    plan_of = pack_lengths(tokens.select("rid", "n"), window, max_padding, max_columns)
    whole = tokens.select("rid", "id", "ids").join(plan_of, "rid").select("id", "ids", "n", "pieces")

    def cut(batches):
        drop_encoders()  # all texts have been encoded
        for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
            pieces = batch.column(3)
            sizes = pa.compute.list_value_length(pieces).to_numpy(zero_copy_only=False)
            flat = pieces.flatten()
            start, length = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            ids = [np.frombuffer(v, "<u2").astype("<u4") for v in batch.column(1).to_pylist()]
            parts = [ids[r][s:s + n] for r, s, n in zip(row, start, length, strict=True)]
            if digest:
                value = pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64())
            else:
                value = binary_rows(np.concatenate([np.zeros(0, "<u4"), *parts]), length)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), flat.field(0), flat.field(1), value,
                                              batch.column(2).take(pa.array(row)), flat.field(2), flat.field(3)],
                                             ["id", "start", "length", "value", "doc_tokens", "sequence_id", "offset"])

    schema = (f"id {id_type}, start long, length long, value {'long' if digest else 'binary'}, doc_tokens long, "
              "sequence_id long, offset long")
    return whole.mapInArrow(cut, schema).withColumnsRenamed({"id": id_col, "value": "ids_crc32" if digest else "ids"})
