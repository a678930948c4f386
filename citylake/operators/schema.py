"""Schemas that grow: the common schema of two batches, nested fields included, and rows brought to it.

A field that one side lacks is NULL in its rows, at any depth. A field that both have gets the narrower type
that holds both sides' values (int and bigint give bigint). All of this is expressions over columns: no row is looked at
while a schema is merged, and conforming rows adds neither a pass nor a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_NUMBERS = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)


def merge_types(a: T.DataType, b: T.DataType, where: str = "value") -> T.DataType:
    """The type that holds values of both; types with nothing in common (a struct and a text) are an error that names the field."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_schemas(a, b, where)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType, f"{where}[]"), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(merge_types(a.keyType, b.keyType, f"{where} key"), merge_types(a.valueType, b.valueType, f"{where} value"), True)
    if isinstance(a, _NUMBERS) and isinstance(b, _NUMBERS):
        if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
            return max(a, b, key=lambda t: _DIGITS[type(t)])
        if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        (p, s), (q, r) = ((t.precision, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b))
        scale, digits = max(s, r), max(p - s, q - r)
        if digits + scale > 38:
            raise ValueError(f"{where}: no decimal holds both {a.simpleString()} and {b.simpleString()}")
        return T.DecimalType(digits + scale, scale)
    if {type(a), type(b)} <= {T.DateType, T.TimestampType, T.TimestampNTZType} and type(a) is not type(b):
        return b if isinstance(a, T.DateType) else a if isinstance(b, T.DateType) else T.TimestampType()
    raise ValueError(f"{where}: {a.simpleString()} and {b.simpleString()} have no common type")


def merge_schemas(a: T.StructType, b: T.StructType, where: str = "") -> T.StructType:
    """Fields of ``a`` in their order, then those only ``b`` has; names compare without case and keep ``a``'s spelling."""
    theirs = {f.name.lower(): f for f in b.fields}
    out = []
    for f in a.fields:
        g = theirs.pop(f.name.lower(), None)
        name = f"{where}.{f.name}".lstrip(".")
        out.append(T.StructField(f.name, merge_types(f.dataType, g.dataType, name) if g else f.dataType, True))
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name.lower() in theirs])


def _plain(t: T.DataType) -> T.DataType:
    """The type with every part nullable, for comparison and casts."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_plain(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(_plain(t.keyType), _plain(t.valueType), True)
    return t


def same_schema(a: T.StructType, b: T.StructType) -> bool:
    return _plain(a) == _plain(b)


def conform_column(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """The column as ``want``: missing nested fields NULL, others by name, a NULL struct stays NULL."""
    if _plain(have) == _plain(want):
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = {f.name.lower(): f for f in have.fields}
        parts = []
        for f in want.fields:
            mine = fields.get(f.name.lower())
            value = conform_column(c.getField(mine.name), mine.dataType, f.dataType) if mine else F.lit(None).cast(f.dataType)
            parts.append(value.alias(f.name))
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda e: conform_column(e, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        values = F.transform_values(c, lambda _, v: conform_column(v, have.valueType, want.valueType))
        return values if have.keyType == want.keyType else F.transform_keys(values, lambda k, _: conform_column(k, have.keyType, want.keyType))
    return c.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of ``df`` with exactly the fields of ``schema``; a field of ``df`` that ``schema`` lacks is an error."""
    have = {f.name.lower(): f for f in df.schema.fields}
    extra = [f.name for k, f in have.items() if k not in {f.name.lower() for f in schema.fields}]
    if extra:
        raise ValueError(f"columns {extra} are not in the schema")
    out = []
    for f in schema.fields:
        mine = have.get(f.name.lower())
        out.append((conform_column(F.col(f"`{mine.name}`"), mine.dataType, f.dataType) if mine else F.lit(None).cast(f.dataType)).alias(f.name))
    return df.select(*out)


def union_growing(*batches: DataFrame) -> DataFrame:
    """All rows of the batches under their common schema."""
    schema = batches[0].schema
    for b in batches[1:]:
        schema = merge_schemas(schema, b.schema)
    out = conform(batches[0], schema)
    for b in batches[1:]:
        out = out.unionAll(conform(b, schema))
    return out
