"""Toxicity scores of whole texts by the recurrent network of ``toxic_net``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm import toxic_net
from citylake.llm.common import column_slices

#: Rows used for fitting, at most, of either label: those of the least xxhash64(id).
FIT_ONES, FIT_ZEROS = 600, 1200
#: Longer texts aren't used for fitting (they are scored like all others).
FIT_CHARS = 60_000


def held_out(key) -> F.Column:
    """crc32 of the id as text, modulo 5, is 0; false for a null id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, ones: int = FIT_ONES, zeros: int = FIT_ZEROS, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", steps: int = 300) -> toxic_net.Net:
    """Train on at most ``ones`` + ``zeros`` labelled rows outside the held-out fifth. Null ids, labels
    and texts are left out; only the text and the label reach the network."""
    key = F.col(f"`{id_col}`")
    known = labels.where(key.isNotNull() & F.col(f"`{label_col}`").isNotNull() & ~held_out(key)).select(key.alias("_label_id"), F.col(f"`{label_col}`").cast("int").alias("_label"))
    share = known.agg(F.avg((F.col("_label") == 1).cast("double")).alias("s")).collect()[0]["s"]
    order = (F.xxhash64("_label_id"), "_label_id")
    picked = known.where("_label = 1").distinct().orderBy(*order).limit(ones).unionAll(known.where("_label = 0").distinct().orderBy(*order).limit(zeros))
    text = F.col(f"`{text_col}`")
    rows = (docs.where(F.length(text) <= FIT_CHARS).select(key.alias("_id"), text.alias("_text"))
            .join(F.broadcast(picked), F.col("_id") == F.col("_label_id")).select("_id", "_text", "_label")
            .orderBy(F.xxhash64("_id"), "_id", "_text").limit(ones + zeros).collect())
    return toxic_net.train([r["_text"].encode("utf-8", "surrogatepass") for r in rows], np.array([r["_label"] for r in rows]),
                           0.0 if share is None else share, steps)


def _scorer(net: toxic_net.Net, column: int):
    def run(batch):
        out = np.zeros(batch.num_rows)
        for first, last, texts in column_slices(batch.column(column), 300_000):
            out[first:last] = net.probability([t.encode("utf-8", "surrogatepass") for t in texts])
        return out
    return run


def toxicity_report(docs: DataFrame, net: toxic_net.Net, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``held_out``, ``score`` (probability of label 1, the highest of all
    overlapping windows of the whole text) and ``predicted``. Null and empty texts get the score of an empty window. No
    shuffle; equal texts get equal scores; other columns are ignored."""
    score = _scorer(net, 2)

    def run(batches):
        for batch in batches:
            p = score(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             ["id", "held_out", "score", "predicted"])

    id_type = docs.schema[id_col].dataType.simpleString()
    key = F.col(f"`{id_col}`")
    return (docs.select(key.alias("id"), held_out(key).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
            .mapInArrow(run, f"id {id_type}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col))


def drop_toxic(docs: DataFrame, net: toxic_net.Net, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``. One pass, no shuffle."""
    score = _scorer(net, docs.columns.index(text_col))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(score(batch) < threshold))

    return docs.mapInArrow(run, docs.schema)
