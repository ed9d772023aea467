"""Dense surrogate keys without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import names as n


def assign_surrogate(
    df: DataFrame,
    surrogate: str,
    start: int | Column = 0,
    key_hash: str = n.KEY_HASH,
    prefix: int = 3,
    ranges: Column | None = None,
) -> DataFrame:
    """Number rows ``start + 1 .. start + N`` in the order of their key hash.

    The hash is uniform hex text, so its first ``prefix`` digits cut the rows into
    16 ** prefix even, ordered ranges. Each range is numbered by its own task and shifted by
    the count of all earlier ranges; that count table has at most 16 ** prefix rows, which is
    also what bounds the broadcast. ``key_hash`` must be unique, and the numbering depends on
    its values only, so a recomputed task assigns the same numbers. Values that are no hash tell their
    range by ``ranges``, ``prefix`` hex digits made of them; then no hash moves with them. A hash
    may be text or its bytes.
    """
    if not 1 <= prefix <= 4:
        raise ValueError("prefix must be 1..4 hex digits")
    packed = isinstance(df.schema[key_hash].dataType, T.BinaryType)
    digits = F.substring(F.hex(key_hash) if packed else key_hash, 1, prefix) if ranges is None else ranges
    bucketed = df.drop(surrogate).withColumn("_range", digits)
    sizes = bucketed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    numbered = bucketed.join(F.broadcast(offsets), "_range")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(key_hash))
    start = start if isinstance(start, Column) else F.lit(start)
    return numbered.withColumn(
        surrogate, (start + F.col("_offset") + within).cast("bigint")
    ).drop("_range", "_offset")


def highest(df: DataFrame, surrogate: str) -> Column:
    """Largest surrogate in use, 0 for an empty table, as a scalar subquery."""
    return F.coalesce(df.agg(F.max(surrogate)).scalar(), F.lit(0)).cast("bigint")


def number_new_rows(df: DataFrame, surrogate: str, prefix: int = 3) -> DataFrame:
    """Give rows whose surrogate is 0 the next free numbers; other rows keep theirs."""
    old = df.filter(F.col(surrogate) != 0)
    new = df.filter(F.col(surrogate) == 0)
    numbered = assign_surrogate(new, surrogate, highest(df, surrogate), prefix=prefix)
    return old.withColumn(surrogate, F.col(surrogate).cast("bigint")).unionByName(numbered)
