"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.session import checkpoint_dir

#: A filter of hashes has at least 32 bits a hash: a power of two from 2 ** 12 to 2 ** 26 bits (8 MB). With more hashes than fit there it lets
#: more through to the exact join after it.
MIN_FILTER_BITS, MAX_FILTER_BITS = 12, 26


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/llm-staged/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once as parquet in the shared checkpoint folder and read it back.

    The written table cuts lineage and survives lost executors. The folder is the one the session
    names in ``spark.checkpoint.dir``; ``drop_staged`` removes what a session has staged.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int = 1000):
    """Jobs started inside move at most ``rows`` rows at a time to Python: a batch of whole texts lies in the memory of
    the JVM and of the Python worker, of each task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def dropped(*frames: DataFrame) -> None:
    """Delete the written tables that ``staged`` returned, once nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/llm-staged/" in name:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete every table this session has staged (call it when the results have been written)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/llm-staged")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def byte_slices(texts: list[str], most: int = 4_000_000, rows: int = 1 << 30):
    """Consecutive (first, last) ranges of about ``most`` characters and at most ``rows`` texts, at least one text each."""
    first = total = 0
    for i, t in enumerate(texts):
        if i > first and (total + len(t) > most or i - first >= rows):
            yield first, i
            first, total = i, 0
        total += len(t)
    if first < len(texts):
        yield first, len(texts)


def column_slices(column, most: int, rows: int = 1 << 30):
    """(first, last, texts) of consecutive slices of an Arrow text column, of about ``most`` bytes and at most ``rows`` texts each, at
    least one; only one slice at a time is held as Python strings. A null is an empty text."""
    import pyarrow.compute as pc

    first = total = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if i > first and (total + n > most or i - first >= rows):
            yield first, i, [t or "" for t in column.slice(first, i - first).to_pylist()]
            first, total = i, 0
        total += n
    if first < len(column):
        yield first, len(column), [t or "" for t in column.slice(first).to_pylist()]


def filter_bits(n: int) -> int:
    """log2 of the filter's bits for ``n`` hashes."""
    return min(max((32 * n - 1).bit_length(), MIN_FILTER_BITS), MAX_FILTER_BITS)


def hash_filter(hashes: DataFrame):
    """A Bloom filter with two probes over the column ``h``, as a test of a hash column, sized by the number of
    hashes. It only thins out what is shuffled; the join after it is exact. Its longs are one value of a
    written table of one row, which plans read by a scalar subquery."""
    spark = hashes.sparkSession
    distinct = hashes.select("h").distinct()
    bits = filter_bits(distinct.count())
    mask = (1 << bits) - 1
    places = distinct.select(F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask))).alias("b"))
    words = places.groupBy(F.shiftright("b", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 AS int)))").alias("bits"))
    dense = words.unionAll(spark.range(1 << bits - 6).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("bits")))
    dense = dense.groupBy("w").agg(F.expr("bit_or(bits)").alias("bits"))
    row = dense.agg(F.sort_array(F.collect_list(F.struct("w", "bits"))).alias("all")).select(F.col("all.bits").alias("bits"))
    table = staged(row, "filter").scalar()

    def bit(at: Column) -> Column:
        return F.getbit(F.get(table, F.shiftright(at, 6).cast("int")), at.bitwiseAND(63).cast("int")) == 1

    def test(h: Column) -> Column:
        return bit(h.bitwiseAND(mask)) & bit(F.shiftrightunsigned(h, 32).bitwiseAND(mask))
    return test


def numbered(df: DataFrame, group: str, order: list[str], number: str, weight: str | None = None) -> DataFrame:
    """Gapless numbers from 0 in each ``group``, in the order of ``order``; with ``weight``, the sum
    of the weights before the row instead.

    One range exchange over (group, order) splits a hot group, the sorted rows are written once, and
    a second pass adds each range partition's offset. Offsets hold one row per group and partition
    that the group reaches, and only rows of (group, partition) meet, so nothing unbounded gets
    into one task. ``order`` should be unique in a group, else ties keep the order they were written in.
    """
    w = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    from pyspark.sql import Window

    ranged = df.withColumn("_w", w).repartitionByRange(_partitions(df), group, *order).sortWithinPartitions(group, *order)
    rows = staged(ranged.withColumn("_mid", F.monotonically_increasing_id())
                  .withColumn("_part", F.shiftright("_mid", 33).cast("int")), "numbered")
    sums = rows.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(F.sum("_w").alias("_n"))
    by_group = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_before", F.coalesce(F.sum("_n").over(by_group), F.lit(0).cast("long"))).drop("_n")
    inner = Window.partitionBy(group, "_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_in", F.coalesce(F.sum("_w").over(inner), F.lit(0).cast("long")))
            .join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
            .withColumn(number, F.col("_before") + F.col("_in"))
            .drop("_w", "_mid", "_part", "_g", "_p", "_before", "_in"))


def _partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
