"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.hashing import content_hash


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = n.RECENCY,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row of each key that is greatest in ``order`` (NULL sorts last).

    Rows that tie are ordered by a hash of the columns in ``tie_break``, by default of all, which
    reads them all. Where ``order`` leaves no ties, an empty ``tie_break`` reads none of them.

    Spark cuts every map partition to one row per key before the shuffle
    (``WindowGroupLimit ... Partial``), so a key that holds a large share of the rows
    reaches its reducer as one row per map task.
    """
    ties = list(df.columns if tie_break is None else tie_break)
    last = [content_hash(df.select(*[F.col(f"`{c}`") for c in ties]))] if ties else []
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order], *last)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_per_key_in_batch(
    df: DataFrame, keys: Sequence[str] = ("id",), order: Sequence[str] = n.RECENCY
) -> DataFrame:
    """Latest row per key and schema fingerprint."""
    return latest_per_key(df, [*keys, n.FINGERPRINT], order)


def unique_source(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per business key for a history load; rows with a NULL key are left out."""
    return latest_per_key(df.dropna(subset=list(keys)), keys, order)


def split_ops(df: DataFrame, initial: bool = False) -> tuple[DataFrame, DataFrame]:
    """(deletes, upserts). An initial load keeps every non-delete code."""
    op = F.col(n.OPERATION)
    upserts = op != n.OP_DELETE if initial else op.isin(*n.UPSERT_OPS)
    return df.filter(op == n.OP_DELETE), df.filter(upserts)
