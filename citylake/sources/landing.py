"""Landing-zone sources: collections of JSON document envelopes, and the place dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the file name that marks the listings' dictionary among the lookup documents.
LISTING_LOOKUP_FILE = "lookup_idealista_extended_2023-05-11-11:31:49.csv"


def read_landing(spark: SparkSession, path: str, schema: T.StructType | None = None, *, fmt: str = "json",
                 options: dict | None = None) -> DataFrame:
    """One row per envelope ``{_id, filename, timestamp, data: [record...]}``.

    ``fmt`` is any Spark source name: ``json`` (one envelope per line, or ``multiLine``),
    ``parquet``, or a document-store connector such as ``mongodb`` when its jar is on the classpath
    (then ``path`` is ignored and ``options`` carry the connection). Pass ``schema`` to skip
    inference (required at scale: inference reads the data twice).
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    if fmt in ("mongodb", "mongo"):
        return reader.load()
    return reader.load(path)


def _last_doc(docs: DataFrame, cond, order: Sequence[str]) -> DataFrame:
    chosen = docs.where(cond)
    last = chosen.agg(F.max(F.struct(*order)).alias("_last"))  # one row: broadcast is bounded
    return chosen.join(F.broadcast(last), F.struct(*order) == F.col("_last"), "left_semi")


def explode_lookup(doc: DataFrame, data: str = "data", pos: str = "pos") -> DataFrame:
    """Dictionary rows of lookup document(s) with their array position as ``pos``."""
    fields = doc.schema[data].dataType.elementType.fieldNames()
    return (doc.select(F.posexplode(data).alias("_p", "_r"))
               .select(F.col("_p").cast("long").alias(pos), *[F.col(f"_r.{f}").alias(f) for f in fields]))


def read_lookup(docs: DataFrame, *, marker: str = LISTING_LOOKUP_FILE, filename: str = "filename",
                order: Sequence[str] = ("_id",), data: str = "data") -> tuple[DataFrame, DataFrame]:
    """Split lookup documents into (marked dictionary, other dictionary).

    The marked one is the document whose file name equals ``marker``; the other one is any other
    document. When several qualify, the last in ``order`` wins (a scan that keeps overwriting).
    Each dictionary comes back as rows with ``pos``.
    """
    is_marked = F.col(filename) == F.lit(marker)
    marked = _last_doc(docs, is_marked, list(order))
    other = _last_doc(docs, ~is_marked | F.col(filename).isNull(), list(order))
    return explode_lookup(marked, data), explode_lookup(other, data)


CORRUPT = "_corrupt_record"


def read_landing_checked(spark: SparkSession, path: str, schema: T.StructType, *, required: Sequence[str] = ("_id", "data"),
                         multi_line: bool = False) -> DataFrame:
    """Every JSON envelope under ``path``, readable or not, with ``reject_reason``: NULL for an accepted one, ``malformed`` for text
    that isn't JSON or doesn't fit ``schema``, ``missing <field>`` for the first required field that is absent or NULL.
    ``raw`` holds a malformed envelope's text. Fields that ``schema`` lacks are ignored; absent optional ones are NULL. Empty lines are no
    records. One scan, and no inference."""
    fields = T.StructType([f for f in schema.fields if f.name != CORRUPT] + [T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.schema(fields).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("multiLine", multi_line).json(path))
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
    for name in required:
        reason = reason.when(F.col(f"`{name}`").isNull(), F.lit(f"missing {name}"))
    return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields if f.name != CORRUPT], F.col(CORRUPT).alias("raw"), reason.alias("reject_reason"))


def split_landing(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted envelopes, rejected ones with ``raw`` and ``reject_reason``) of ``read_landing_checked``."""
    accepted = checked.where(F.col("reject_reason").isNull()).drop("raw", "reject_reason")
    return accepted, checked.where(F.col("reject_reason").isNotNull())
