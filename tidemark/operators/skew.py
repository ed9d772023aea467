"""Left join that spreads keys shared by a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key counts as hot when it holds more than 1/HOT_PARTS of the rows, so at most
# HOT_PARTS - 1 keys can be hot: that is the bound of the broadcast below.
HOT_PARTS = 1000


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that hold more than 1/HOT_PARTS of all rows: column ``_hot``.

    Counts are combined before the shuffle; only the key column is read.
    """
    counts = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.filter(F.col("_hot").isNotNull() & (F.col("_n") * HOT_PARTS > total)).select("_hot")


def skew_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_by: Column,
    salts: int = 32,
) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` in which the rows of a hot key, and rows
    without a key, go to ``salts`` tasks instead of one.

    Rows of a hot key are split by a hash of ``spread_by`` and the matching right row, of which
    there is one per key, is repeated once per part. The result is the same as that of the
    plain join.
    """
    hot = hot_keys(left, left_key)
    part = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    marked = left.join(F.broadcast(hot), F.col(left_key) == F.col("_hot"), "left")
    spread = F.col("_hot").isNotNull() | F.col(left_key).isNull()
    salted = marked.withColumn("_salt", F.when(spread, part).otherwise(0)).drop("_hot")
    copies = right.join(F.broadcast(hot), F.col(right_key) == F.col("_hot"), "left")
    numbers = F.when(
        F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))
    ).otherwise(F.array(F.lit(0)))
    repeated = copies.withColumn("_part", F.explode(numbers)).drop("_hot")
    condition = [F.col(left_key) == F.col(right_key), F.col("_salt") == F.col("_part")]
    return salted.join(repeated, condition, "left").drop("_salt", "_part")
