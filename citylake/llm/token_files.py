"""Token ids in Huffman-coded files.

A written folder has ``codebook`` (one row: the code length of every id, the block size) and
``segments``. A segment is a row with the bits of consecutive documents, the bit offset of every
block of ids (blocks decode independently), the document ids and their numbers of ids. ``file`` and
``first`` give the order of segments, which is the ascending order of the document ids. The bits stand in
parquet rows because Spark's writer commits them safely when an executor is lost.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylake.llm.common import _partitions, column_slices, short_batches, staged
from citylake.llm.huffman import Code, code_lengths
from citylake.llm.tokens import tokenizers_encoder

BLOCK = 512
SEGMENT = 512 * 1024
LIMIT = 16


def binary_rows(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per document, of its share of the array ``ids``."""
    width = ids.dtype.itemsize
    offsets = np.concatenate([[0], np.cumsum(counts)]) * width
    return pa.Array.from_buffers(pa.large_binary(), len(counts),
                                 [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids.tobytes())]).cast(pa.binary())


def encode_documents(docs: DataFrame, tokenizer_path: str, kind: str, id_col: str, text_col: str, end_id: int, vocabulary: int | None = None) -> DataFrame:
    """(id, ids) with the ids of the whole text and ``end_id`` as little-endian unsigned 16 bits; a null
    text is empty. With ``vocabulary``, ``used`` holds in the last row of each task how often its ids occur, see ``id_counts``."""
    def encode(batches):
        encoder = tokenizers_encoder(tokenizer_path, kind)
        for batch in batches:
            for first, last, texts in column_slices(batch.column(1), 1_000_000):
                ids, counts = encoder.encode(texts)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, np.uint16(end_id)).astype("<u2")
                yield ids, [batch.column(0).slice(first, last - first), binary_rows(ids, counts + 1)]

    def rows(batches):
        for _, columns in encode(batches):
            yield pa.RecordBatch.from_arrays(columns, ["id", "ids"])

    def counted(batches):
        def out(columns, used=None):
            n = len(columns[0])
            return pa.RecordBatch.from_arrays([*columns, pa.array([None] * (n - 1) + [used], pa.binary())], ["id", "ids", "used"])

        total, held = np.zeros(vocabulary, np.int64), None
        for ids, columns in encode(batches):
            total += np.bincount(ids, minlength=vocabulary)
            if held:
                yield out(held)
            held = columns
        if held:
            used = np.flatnonzero(total)
            yield out(held, np.stack([used, total[used]]).astype("<i8").tobytes())

    id_type = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return narrow.mapInArrow(rows if vocabulary is None else counted, f"id {id_type}, ids binary" + (", used binary" if vocabulary else ""))


def id_counts(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs, from what the tasks that encoded have counted: only their ``used`` is read. At most one row
    per id and task is shuffled and one per id (the vocabulary bounds them) reaches the driver."""
    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for used in batch.column(0).to_pylist():
                ids, n = np.frombuffer(used, "<i8").reshape(2, -1)
                total[ids] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["id", "n"])

    rows = tokens.where("used IS NOT NULL").select("used").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, kind: str = "words", id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 1, vocabulary: int = 1 << 16, block: int = BLOCK,
                 segment: int = SEGMENT) -> None:
    """Encode every document, count ids over all of them, and write the files in ascending id order.

    The text is range-partitioned by id (ties by place, so that a hot id splits) and tokenized once
    into a staged table; the code comes from its global counts. A null text is empty, every document ends with
    ``end_id``, documents with a null id come first, repeated rows are each written, an empty table
    gives a codebook without codes and no segments. Other columns are ignored.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.monotonically_increasing_id().alias("place"))
    ordered = narrow.repartitionByRange(_partitions(docs), "id", "place").sortWithinPartitions("id", "place")
    with short_batches(spark):
        tokens = staged(encode_documents(ordered, tokenizer_path, kind, "id", "text", end_id, vocabulary)
                        .withColumn("seq", F.monotonically_increasing_id()), "tokens")
    lengths = code_lengths(id_counts(tokens, vocabulary), LIMIT)
    spark.createDataFrame([(bytearray(lengths.tobytes()), LIMIT, block)], "lengths binary, bits int, block int").write.parquet(f"{path}/codebook")

    def pack(batches):
        code = Code(lengths, LIMIT)
        held, size, follows = [], 0, None

        def out():
            ids = np.concatenate([np.frombuffer(v, "<u2") for _, v, _ in held])
            bits, offsets = code.encode(ids, block)
            return pa.RecordBatch.from_arrays(
                [pa.array([held[0][2] >> 33], pa.int64()), pa.array([held[0][2]], pa.int64()),
                 pa.array([[d for d, _, _ in held]], pa.list_(id_arrow)), pa.array([[len(v) // 2 for _, v, _ in held]], pa.list_(pa.int64())),
                 pa.array([len(ids)], pa.int64()), pa.array([offsets.tolist()], pa.list_(pa.int64())), pa.array([bits], pa.binary())],
                ["file", "first", "ids", "counts", "n", "offsets", "bits"])

        for batch in batches:
            id_arrow = batch.column(0).type
            for d, v, seq in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (size >= segment or seq != follows):  # a segment never spans files
                    yield out()
                    held, size = [], 0
                held.append((d, v, seq))
                size, follows = size + len(v) // 2, seq + 1
        if held:
            yield out()

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"file long, first long, ids array<{id_type}>, counts array<long>, n long, offsets array<long>, bits binary"
    (tokens.select("id", "ids", "seq").mapInArrow(pack, schema).write.option("compression", "uncompressed")
     .parquet(f"{path}/segments"))


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id", digest: bool = False) -> DataFrame:
    """Decode every document: id, ``start`` (ids before it in the files), ``n_tokens``, and its ids as
    ``ids`` (binary, little-endian unsigned 32 bits) or, with ``digest``, their crc32 ``ids_crc32``."""
    book = spark.read.parquet(f"{path}/codebook").collect()[0]
    lengths, limit, block = np.frombuffer(bytes(book["lengths"]), np.uint8), book["bits"], book["block"]
    segments = spark.read.parquet(f"{path}/segments")
    id_type = segments.schema["ids"].dataType.elementType.simpleString()

    def unpack(batches):
        code = Code(lengths, limit)
        for batch in batches:
            for row in range(batch.num_rows):
                first, ids, counts, n, offsets, bits = (batch.column(k)[row] for k in range(6))
                counts = counts.values.to_numpy()
                flat = code.decode(bits.as_py(), offsets.values.to_numpy(), n.as_py(), block).astype("<u4")
                ends = np.cumsum(counts)
                starts = ends - counts
                if digest:
                    raw = memoryview(flat.tobytes())
                    last = pa.array([zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(starts, ends, strict=True)], pa.int64())
                else:
                    last = binary_rows(flat, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), first.as_py())), ids.values, pa.array(starts), pa.array(counts), last],
                    ["first", "id", "inside", "n_tokens", "value"])

    value = "long" if digest else "binary"
    rows = (segments.select("first", "ids", "counts", "n", "offsets", "bits")
            .mapInArrow(unpack, f"first long, id {id_type}, inside long, n_tokens long, value {value}"))
    # ids before a segment: one row per file, then the segments of each file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    files = segments.groupBy("file").agg(F.sum("n").alias("total")).withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0)))
    starts = (segments.select("file", "first", "n").withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .join(files, "file").select("first", (F.col("base") + F.col("before")).alias("base")))
    return rows.join(starts, "first").select(F.col("id").alias(id_col), (F.col("base") + F.col("inside")).alias("start"), "n_tokens",
                                             F.col("value").alias("ids_crc32" if digest else "ids"))
