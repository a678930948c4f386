"""Fingerprints of documents by improbable features, and their likeness to edited and neighbouring texts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm import improbable as I


def entropy_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rank of every entropy by its number of windows in all texts. Only one row per entropy and task is shuffled,
    and ``LEVELS`` sums reach the driver."""
    def count(batches):
        total = np.zeros(I.LEVELS, np.int64)
        for batch in batches:
            total += I.entropy_counts([t.encode("utf-8", "surrogatepass") for t in batch.column(0).to_pylist() if t])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["level", "n"])

    counts = np.zeros(I.LEVELS, np.int64)
    rows = docs.select(F.col(f"`{text_col}`")).mapInArrow(count, "level int, n long").groupBy("level").agg(F.sum("n").alias("n"))
    for r in rows.collect():  # at most LEVELS rows
        counts[r["level"]] = r["n"]
    return I.ranks_of(counts)


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, guest) by descending id, in one range of ids per partition, sorted; each partition ends with a copy of the row that comes
    next (``guest``), the last one with the first row of all.

    The texts are shuffled once. Splitters come from a sketch over the ids and the rows that begin a range from one
    aggregate, both as long as the number of partitions. Rows of one id are ordered by a hash of their texts and lie in one
    partition, which is streamed; null ids come last.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    cuts = given.agg(F.percentile_approx("id", [k / n for k in range(1, n)] or [0.5], 100 * n).alias("cuts")).collect()[0]["cuts"] or []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def place(ids):
        some = ids.notna().to_numpy()
        out = np.full(len(ids), len(cuts), np.int64)  # null ids share the last range
        out[some] = len(cuts) - np.searchsorted(cuts, ids[some].to_numpy().astype(np.int64), "right")
        return _series(out.astype(np.int32))

    placed = given.withColumn("range", place("id")).withColumn("tie", F.xxhash64("text"))
    heads = sorted(placed.groupBy("range").agg(F.max(F.struct("id", "tie")).alias("m")).select("range", "m.id", "m.tie").collect())
    copies = [(heads[k]["id"], heads[k]["tie"], heads[k - 1]["range"]) for k in range(len(heads))]  # at most one row per range
    heads = spark.createDataFrame(copies, "head_id long, head_tie long, before int")
    both = placed.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")), "left")
    own = F.struct(F.col("range").alias("to"), F.lit(False).alias("guest"))
    rows = both.select("id", "text", "tie", F.explode(F.when(F.col("before").isNull(), F.array(own))
                                                     .otherwise(F.array(own, F.struct(F.col("before").alias("to"), F.lit(True).alias("guest"))))).alias("x"))
    return (rows.select("id", "text", "tie", "x.to", "x.guest").repartitionById(max(len(cuts) + 1, 1), F.col("to"))
            .sortWithinPartitions("guest", F.desc_nulls_last("id"), F.desc("tie")).select("id", "text", "guest"))


def _series(values):
    import pandas as pd
    return pd.Series(values)


def edited(text: str, following: str) -> str:
    """The text with its last third (in code points, rounded down) replaced by as many first ones of the following text, or all."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: np.ndarray | None = None) -> DataFrame:
    """One row per input row: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    ``edited`` says what the edited text is; the next document is that of the next smaller id, after the last the first, so a single
    document follows itself. Equal texts have equal fingerprints. A null text counts as empty and has the empty fingerprint. Rows of
    one id follow each other in order of a hash of their texts; a row with a null id comes last. Other columns are ignored; an empty table
    gives no rows. ``ranks`` are those of ``entropy_ranks`` over ``docs`` unless given: fingerprints of different
    tables compare only under the same ranks.
    """
    ranks = entropy_ranks(docs, text_col) if ranks is None else ranks

    def run(batches):
        last = None  # the row that waits for its follower: id, text, guest, digest
        for batch in batches:
            ids, texts, guests = (batch.column(k).to_pylist() for k in range(3))
            digests = I.digests([t.encode("utf-8", "surrogatepass") for t in texts], ranks)
            rows = ([last] if last else []) + list(zip(ids, texts, guests, digests))
            last = rows[-1] if rows else last
            go = [k for k in range(len(rows) - 1) if not rows[k][2]]
            for first in range(0, len(go), 512):
                yield _report([(rows[k], rows[k + 1]) for k in go[first:first + 512]], ranks)

    schema = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return in_order(docs, id_col, text_col).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _report(pairs, ranks: np.ndarray) -> pa.RecordBatch:
    changed = [edited(a[1], b[1]).encode("utf-8", "surrogatepass") for a, b in pairs]
    other = I.digests(changed, ranks)
    return pa.RecordBatch.from_arrays(
        [pa.array([a[0] for a, _ in pairs], pa.int64()), pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
         pa.array([hashlib.sha256(c).hexdigest() for c in changed]), pa.array([I.as_text(a[3]) for a, _ in pairs]), pa.array([I.as_text(d) for d in other]),
         pa.array([I.likeness(a[3], d) for (a, _), d in zip(pairs, other)], pa.float64()),
         pa.array([I.likeness(a[3], b[3]) for a, b in pairs], pa.float64())],
        ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
