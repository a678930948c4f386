"""Ranked lexical search of items over all documents, by presence masks."""

from __future__ import annotations

import math
import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm import presence as P
from citylake.llm.common import dropped, staged

#: Terms of the items that are searched in one pass over the documents, about; more items go round again.
MOST_TERMS = 200_000
#: Bytes: A-Z in lower case, digits, a-z and all beyond ASCII as they are, all else a separator.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _lengths(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """The documents' m; in Python integers where 64 bits would not do."""
    if len(n) and int(n.max()) * 25 * n_docs >= 1 << 62:
        return np.array([75 + (25 * int(x) * n_docs) // total for x in n], np.int64)
    return 75 + (25 * n.astype(np.int64) * n_docs) // max(total, 1)


def _postings(vocabulary):
    """Per document with a term: its number of terms, and the ids and counts of those in the vocabulary."""
    def run(batches):
        number = vocabulary.value.get
        for batch in batches:
            kept, sizes, flat, ends = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = terms_of(text) if text else ()
                if words:
                    kept.append(i)
                    sizes.append(len(words))
                    flat.extend(x for x in map(number, words) if x is not None)
                    ends.append(len(flat))
            term = np.array(flat, np.int64)
            doc = np.searchsorted(np.array(ends, np.int64), np.arange(len(term)), "right")
            span = len(vocabulary.value) + 1
            both, tf = np.unique(doc * span + term, return_counts=True)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(both // span, minlength=len(kept)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array((both % span).astype(np.int32))), pa.ListArray.from_arrays(pa.array(offsets), pa.array(tf.astype(np.int32)))],
                ["id", "n", "terms", "tfs"])
    return run


def _top(queries, n_docs: int, total: int, top: int, n_terms: int):
    """The best documents of each item in a task."""
    def run(batches):
        best = [P.Best(top) for _ in queries.value]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id")
            terms, tfs = batch.column("terms"), batch.column("tfs")
            doc = np.repeat(np.arange(batch.num_rows), np.diff(terms.offsets.to_numpy()))
            block = P.Block(ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), _lengths(batch.column("n").to_numpy(), n_docs, total), doc,
                            terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64), n_terms)
            for (_, term, value), b in zip(queries.value, best):
                P.search(block, term, value, b)
        for k, b in enumerate(best):
            if len(b.score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.score), k, np.int32)), pa.array(b.id, mask=~b.some), pa.array(b.score)], ["item", "id", "score"])
    return run


def _item_terms(batches):
    for batch in batches:
        counts = [Counter(terms_of(t or b"")) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), batch.column("hash"), pa.array([list(c) for c in counts], pa.list_(pa.binary())),
             pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))], ["item", "hash", "terms", "counts"])


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", most_terms: int = MOST_TERMS) -> DataFrame:
    """(item, rank, id, score): the ``top`` highest-scoring documents of each item, scores above 0, equal ones by ascending id.

    Terms are runs of ASCII letters and digits and characters beyond ASCII, A-Z in lower case. With N documents that have terms, L
    terms in them, n in one document and df documents with a term, its weight w is floor(1000 * ln((2N + 2) / (2df + 1))); a document's score sums
    w * ((10**9 * tf) div (1000 * tf + 12 * m)) over the item's terms, repeats included, m = 75 + (25 * n * N) div L.

    Items are searched in blocks of about ``most_terms`` terms, which tasks get by broadcast. For a block the documents are read once into
    postings of the block's terms (written, since statistics of all documents come before scores), and every task keeps its own ``top`` of each item,
    so only these are shuffled, first by item and a part of the tasks. A null text has no terms and isn't counted; an item without terms, or an empty
    table, gives no rows. Repeated document rows are documents each; each distinct (id, text) of items is one item; a null id is
    the least. Other columns are ignored.
    """
    spark = docs.sparkSession
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    text = F.col(f"`{item_text_col}`").cast("binary")
    wanted = staged(items.select(F.col(f"`{item_col}`").alias("item"), text.alias("text"), F.xxhash64(F.col(f"`{item_col}`"), text).alias("hash")).distinct()
                    .mapInArrow(_item_terms, f"item {item_type}, hash long, terms array<binary>, counts array<long>"), "search-items")
    blocks = max(1, -(-int(wanted.agg(F.sum(F.size("terms"))).collect()[0][0] or 0) // most_terms))
    given = docs.where(F.col(f"`{text_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    found = None
    for block in range(blocks):
        rows = wanted.where(F.pmod("hash", F.lit(blocks)) == block).orderBy("item", "hash").collect()  # about most_terms terms
        numbers: dict[bytes, int] = {}
        for r in rows:
            for t in r["terms"]:
                numbers.setdefault(bytes(t), len(numbers))
        vocabulary = spark.sparkContext.broadcast(numbers)
        postings = staged(given.mapInArrow(_postings(vocabulary), f"id {id_type}, n long, terms array<int>, tfs array<int>"), "postings")
        whole = postings.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).collect()[0]
        df = {r["t"]: r["c"] for r in postings.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("c")).collect()}  # the vocabulary's terms
        queries = []
        for r in rows:
            pairs = [(numbers[bytes(t)], c) for t, c in zip(r["terms"], r["counts"])]
            value = [(t, c * weight(whole["docs"], df[t])) for t, c in pairs if t in df]
            value = [(t, v) for t, v in value if v > 0]
            queries.append((r["item"], np.array([t for t, _ in value], np.int64), np.array([v for _, v in value], np.int64)))
        sent = spark.sparkContext.broadcast(queries)
        tops = postings.mapInArrow(_top(sent, whole["docs"], whole["total"], top, len(numbers)), f"item int, id {id_type}, score long")
        best = [F.desc("score"), F.asc_nulls_first("id")]
        part = tops.withColumn("part", F.spark_partition_id() % 16)
        first = part.withColumn("k", F.row_number().over(Window.partitionBy("item", "part").orderBy(*best))).where(F.col("k") <= top)
        ranked = (first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(F.col("rank") <= top)
                  .select("item", "rank", "id", "score"))
        names = spark.createDataFrame([(k, q[0]) for k, q in enumerate(queries)], f"item int, name {item_type}")
        one = staged(ranked.join(names, "item").select(F.col("name").alias("item"), "rank", "id", "score"), "search-result")
        dropped(postings)
        found = one if found is None else found.unionAll(one)
    return found


def search_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", **options) -> DataFrame:
    """``ranked_search`` with columns (item id, ``rank``, document id, ``score``)."""
    return (ranked_search(docs, items, id_col=id_col, item_col=item_col, **options)
            .select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"))


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
n AS (SELECT row, doc_id, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
parts AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))) AS part
  FROM p JOIN n USING (row) JOIN w USING (term), s),
scores AS (SELECT item_id, row, doc_id, CAST(sum(times * part) AS BIGINT) AS score FROM q JOIN parts USING (term) GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
