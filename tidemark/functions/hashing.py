"""Row hashes for keys and change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "\u0001"
NULL_MARK = "\u0002"


def row_hash(columns: Sequence[str], compat: bool = False) -> Column:
    """MD5 over the text of ``columns`` in the given order.

    By default values are kept apart by a separator and NULL differs from ''. With
    ``compat`` the texts are joined as they are and NULL counts as ''.
    """
    if not columns:
        raise ValueError("a row hash needs at least one column")
    text = [F.col(f"`{c}`").cast("string") for c in columns]
    if compat:
        return F.md5(F.concat(*[F.coalesce(t, F.lit("")) for t in text]))
    return F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(t, F.lit(NULL_MARK)) for t in text]))


def content_hash(df: DataFrame) -> Column:
    """Hash of the whole row; it orders rows that tie on everything else, so that a
    recomputed task picks the same winner."""
    hashable = [f.name for f in df.schema.fields if not _holds_map(f.dataType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in hashable])


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return False
