"""Schema drift below the top level: fields of structs, elements of arrays, keys and values of maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schema import WHOLE_NUMBERS, is_lossless, safe_cast

_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds all values of both, at any depth.

    Structs have the fields of both, by name in any case, those of the first in front. Numbers widen
    to a number that loses nothing; what no number or time holds becomes text. A struct, array or map
    beside something else is refused.
    """
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _common_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType), True)
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    for have, want in ((a, b), (b, a)):
        if not isinstance(want, T.StringType) and is_lossless(have, want):
            return want
    exact = [_as_decimal(x) for x in (a, b)]
    if all(exact):
        scale = max(x.scale for x in exact)
        whole = max(x.precision - x.scale for x in exact)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if {type(a), type(b)} <= {T.ByteType, T.ShortType, T.IntegerType, T.FloatType}:
        return T.DoubleType()
    if all(is_lossless(x, T.StringType()) for x in (a, b)):
        return T.StringType()
    raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def _as_decimal(x: T.DataType) -> T.DecimalType | None:
    return T.DecimalType(_DIGITS[type(x)], 0) if isinstance(x, WHOLE_NUMBERS) else x if isinstance(x, T.DecimalType) else None


def _common_struct(a: T.StructType, b: T.StructType) -> T.StructType:
    other = {f.name.lower(): f for f in b.fields}
    fields = []
    for f in a.fields:
        twin = other.pop(f.name.lower(), None)
        fields.append(T.StructField(f.name, common_type(f.dataType, twin.dataType) if twin else f.dataType))
    left = [f for f in b.fields if f.name.lower() in other]
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in left])


def common_schema(*schemas: T.StructType) -> T.StructType:
    """The least schema for the rows of all."""
    return reduce(_common_struct, schemas)


def cast_nested(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast at any depth: fields go by name, a field that the value lacks is NULL, one that is not wanted
    is dropped, and a NULL struct, array or map stays NULL. All of it is one expression."""
    if have == want:
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = [
            (cast_nested(column.getField(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType)
             if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: cast_nested(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keys = F.transform_keys(column, lambda k, v: cast_nested(k, have.keyType, want.keyType))
        return F.transform_values(keys, lambda k, v: cast_nested(v, have.valueType, want.valueType))
    return safe_cast(column, have, want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows in a wider schema, in one projection; columns they lack are NULL."""
    own = {f.name.lower(): f for f in df.schema.fields}
    return df.select(*[
        (cast_nested(F.col(f"`{own[f.name.lower()].name}`"), own[f.name.lower()].dataType, f.dataType)
         if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def union_widened(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames of different schema versions, in the least schema that holds them."""
    schema = common_schema(*[f.schema for f in frames])
    return reduce(DataFrame.union, [conform(f, schema) for f in frames])
