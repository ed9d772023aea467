"""Schema drift: cast one side to the other, report what differs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def safe_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that yields NULL for a value that does not fit.

    Text such as ``12.7`` becomes 12 for whole-number targets, as a lenient cast does.
    """
    cast = column.try_cast(target)
    if isinstance(source, T.StringType) and isinstance(target, WHOLE_NUMBERS):
        whole = F.regexp_extract(column, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
        cast = F.coalesce(cast, F.nullif(whole, F.lit("")).try_cast(target))
    return cast


def type_changes(df: DataFrame, like: T.StructType) -> dict[str, tuple[T.DataType, T.DataType]]:
    """Columns common to both whose type differs: name in ``df`` -> (type, wanted type)."""
    wanted = {f.name.lower(): f.dataType for f in like.fields}
    return {
        f.name: (f.dataType, wanted[f.name.lower()])
        for f in df.schema.fields
        if f.name.lower() in wanted and f.dataType != wanted[f.name.lower()]
    }


def cast_like(df: DataFrame, like: T.StructType) -> DataFrame:
    """Cast the common columns of ``df`` to the types of ``like``, in one projection."""
    changes = type_changes(df, like)
    if not changes:
        return df
    return df.withColumns(
        {c: safe_cast(F.col(f"`{c}`"), have, want) for c, (have, want) in changes.items()}
    )


def align_to_target(source: DataFrame, target: DataFrame) -> DataFrame:
    """Give incoming rows the column types the target already has."""
    return cast_like(source, target.schema)


def is_lossless(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of one type has an equal one in the other."""
    if isinstance(want, T.StringType):
        return not isinstance(have, (T.StructType, T.ArrayType, T.MapType, T.BinaryType))
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    if isinstance(have, WHOLE_NUMBERS):
        if isinstance(want, WHOLE_NUMBERS):
            return digits[type(have)] <= digits[type(want)]
        if isinstance(want, T.DecimalType):
            return want.precision - want.scale >= digits[type(have)]
        most = {T.FloatType: 5, T.DoubleType: 10}
        return digits[type(have)] <= most.get(type(want), 0)
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return want.scale >= have.scale and want.precision - want.scale >= have.precision - have.scale
    pairs = ((T.FloatType, T.DoubleType), (T.DateType, T.TimestampType), (T.DateType, T.TimestampNTZType))
    return any(isinstance(have, a) and isinstance(want, b) for a, b in pairs)


def align_target_to_source(target: DataFrame, source: DataFrame, compat: bool = True) -> DataFrame:
    """Give the target the column types of the newest source schema.

    A change that can lose stored values is refused with ``compat=False``; else such values
    become NULL.
    """
    lossy = [
        f"{c}: {have.simpleString()} to {want.simpleString()}"
        for c, (have, want) in type_changes(target, source.schema).items()
        if not is_lossless(have, want)
    ]
    if lossy and not compat:
        raise ValueError("values may be lost by a change of type of " + ", ".join(lossy))
    return cast_like(target, source.schema)


def spelled_like(df: DataFrame, like: T.StructType) -> DataFrame:
    """Rename columns that differ from ``like`` only in case."""
    wanted = {f.name.lower(): f.name for f in like.fields}
    renames = {
        c: wanted[c.lower()]
        for c in df.columns
        if c.lower() in wanted and wanted[c.lower()] != c
    }
    return df.withColumnsRenamed(renames) if renames else df


def union_aligned(frames: list[DataFrame]) -> DataFrame:
    """Union frames of different schema versions; the LAST frame sets the types."""
    like = frames[-1].schema
    out = frames[-1]
    for frame in reversed(frames[:-1]):
        frame = cast_like(spelled_like(frame, out.schema), out.schema)
        out = frame.unionByName(out, allowMissingColumns=True)
    order = [f.name for f in like.fields]
    return out.select(*order, *[c for c in out.columns if c not in order])
