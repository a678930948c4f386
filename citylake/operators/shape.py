"""Structure operators: unnest document envelopes, flatten nested fields, drop columns.

All of them are narrow (no shuffle): each is a projection or an explode over one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.functions.columns import first_element, snapshot_date

SRC = "_src"  # struct(<doc order columns>, pos): the definition of "first" for dedup_first


def _q(name: str):
    """Column by exact name (dots, spaces and backticks in names are literal)."""
    return F.col("`" + name.replace("`", "``") + "`")


def unnest_envelope(df: DataFrame, data: str = "data", *, id_col: str = "_id", filename: str = "filename",
                    timestamp: str = "timestamp", doc_order: Iterable[str] | None = None,
                    first_only: bool = False, snapshot_from_filename: bool = False,
                    keep_src: bool = True) -> DataFrame:
    """One row per element of the ``data`` array, carrying envelope provenance.

    Output: every record field, ``source_id`` (= envelope id as text), ``timestamp`` (envelope
    timestamp, or the date taken from the file name with ``snapshot_from_filename``) and ``_src``,
    a struct ``(doc order columns..., pos)`` that orders records the way a scan of the collection
    would meet them. Envelopes with an empty or NULL ``data`` yield no rows. ``first_only`` keeps
    element 0 only (no explode at all).
    """
    order = list(doc_order) if doc_order is not None else [filename, id_col]
    rec_type = df.schema[data].dataType
    if not isinstance(rec_type, T.ArrayType) or not isinstance(rec_type.elementType, T.StructType):
        raise TypeError(f"{data!r} must be array<struct<...>>, got {rec_type.simpleString()}")
    fields = rec_type.elementType.fieldNames()
    ts = snapshot_date(_q(filename)) if snapshot_from_filename else _q(timestamp).cast("string")
    env = [_q(c).alias(f"_env_{c}") for c in order]
    if first_only:
        base = (df.where(F.size(_q(data)) > 0)
                  .select(*env, _q(id_col).cast("string").alias("_sid"), ts.alias("_ts"),
                          F.lit(0).alias("_pos"), first_element(_q(data)).alias("_rec")))
    else:
        base = df.select(*env, _q(id_col).cast("string").alias("_sid"), ts.alias("_ts"),
                         F.posexplode(_q(data)).alias("_pos", "_rec"))
    cols = [F.col("_rec").getField(f).alias(f) for f in fields if f not in ("source_id", "timestamp", SRC)]
    cols += [F.col("_sid").alias("source_id"), F.col("_ts").alias("timestamp")]
    if keep_src:
        cols.append(F.struct(*[_q(f"_env_{c}").alias(c) for c in order],
                             F.col("_pos").cast("long").alias("pos")).alias(SRC))
    return base.select(*cols)


def flatten_struct(df: DataFrame, struct_col: str, *, drop: bool = True) -> DataFrame:
    """Lift the fields of an optional struct to the top level; the child overwrites a same-named
    top-level column. A NULL struct (absent in the document) leaves existing values untouched
    and gives NULL for fields that did not exist before."""
    st = df.schema[struct_col].dataType
    if not isinstance(st, T.StructType):
        raise TypeError(f"{struct_col!r} is not a struct")
    present = _q(struct_col).isNotNull()
    child = {f: _q(struct_col).getField(f) for f in st.fieldNames()}
    out = []
    for c in df.columns:
        if c == struct_col:
            continue
        if c in child:
            out.append(F.when(present, child.pop(c)).otherwise(_q(c)).alias(c))
        else:
            out.append(_q(c))
    out += [v.alias(k) for k, v in child.items()]
    res = df.select(*out)
    if not drop:
        res = res.withColumn(struct_col, df[f"`{struct_col}`"])
    return res


def flatten_first(df: DataFrame, array_col: str, *, drop: bool = False) -> DataFrame:
    """Lift the fields of element 0 of an array of structs; empty/NULL array keeps existing values.

    Applied in sequence (``addresses`` then ``classifications_data``) the later call wins on a
    shared field name, as in the reference.
    """
    at = df.schema[array_col].dataType
    if not isinstance(at, T.ArrayType) or not isinstance(at.elementType, T.StructType):
        raise TypeError(f"{array_col!r} is not array<struct>")
    nonempty = F.coalesce(F.size(_q(array_col)) > 0, F.lit(False))
    head = first_element(_q(array_col))
    child = {f: head.getField(f) for f in at.elementType.fieldNames()}
    out = []
    for c in df.columns:
        if c in child and c != array_col:
            out.append(F.when(nonempty, child.pop(c)).otherwise(_q(c)).alias(c))
        elif c == array_col and drop:
            continue
        else:
            out.append(_q(c))
    out += [F.when(nonempty, v).alias(k) for k, v in child.items()]
    return df.select(*out)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop a fixed list of columns; names that are not present are ignored."""
    return df.drop(*[c for c in cols if c in df.columns])


def all_null_columns(df: DataFrame, candidates: Iterable[str] | None = None) -> list[str]:
    """Columns whose every value is NULL, found in one aggregation pass (one row to the driver)."""
    cols = list(candidates) if candidates is not None else df.columns
    if not cols:
        return []
    counts = df.agg(*[F.count(_q(c)).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    total = None
    if all(counts[f"c{i}"] == 0 for i in range(len(cols))):
        total = df.limit(1).count()
        if total == 0:  # empty table: keep every column
            return []
    return [c for i, c in enumerate(cols) if counts[f"c{i}"] == 0]


def drop_all_null(df: DataFrame, candidates: Iterable[str] | None = None) -> DataFrame:
    """Drop columns that hold only NULLs. An empty table keeps all its columns."""
    return df.drop(*all_null_columns(df, candidates))
