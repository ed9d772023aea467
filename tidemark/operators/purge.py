"""Old versions out of a history table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.columns import as_timestamp
from tidemark.operators.scd2 import is_active


def join_adjacent(closed: DataFrame) -> DataFrame:
    """Make one version of neighbours of a key that say the same: equal change hash, and one begins when
    the other ends. It has the values of the last, and the begin and creation of the first."""
    window = Window.partitionBy(n.KEY_HASH).orderBy(n.EFFECTIVE, n.EXPIRY, n.CHANGE_HASH)
    before = F.lag(F.struct(F.col(n.CHANGE_HASH).alias("h"), F.col(n.EXPIRY).alias("end"))).over(window)
    goes_on = F.coalesce((before["h"] == F.col(n.CHANGE_HASH)) & (before["end"] == F.col(n.EFFECTIVE)), F.lit(False))
    marked = closed.withColumn("_begins", (~goes_on).cast("int"))
    numbered = marked.withColumn("_run", F.sum("_begins").over(window))
    row = F.struct(*[F.col(f"`{c}`") for c in closed.columns])
    runs = numbered.groupBy(n.KEY_HASH, "_run").agg(
        F.max_by(row, F.struct(n.EFFECTIVE, n.EXPIRY)).alias("_row"),
        F.min(n.EFFECTIVE).alias("_from"), F.min(n.CREATED).alias("_made"),
    )
    # The key is the group's own column, so that the rows are known to lie by it.
    own = {n.EFFECTIVE: "_from", n.CREATED: "_made", n.KEY_HASH: n.KEY_HASH}
    return runs.select(*[F.col(own[c]).alias(c) if c in own else F.col("_row")[c].alias(c) for c in closed.columns])


def purge_closed(closed: DataFrame, before) -> DataFrame:
    """Closed versions without those that ended before a time, but the last one of each key stays.

    Versions are joined first, so a state that went on past the time stays whole. Versions without an
    end or begin stay. Window and aggregate share one shuffle, by key."""
    joined = join_adjacent(closed)
    latest = Window.partitionBy(n.KEY_HASH).orderBy(F.desc(n.EFFECTIVE), F.desc(n.EXPIRY), n.CHANGE_HASH)
    kept = joined.withColumn("_nth", F.row_number().over(latest))
    old = F.coalesce(F.col(n.EXPIRY) < as_timestamp(before), F.lit(False))
    return kept.where(~old | (F.col("_nth") == 1)).drop("_nth")


def purge_history(history: DataFrame, before) -> DataFrame:
    """The table after a purge: open versions as they are, in no shuffle, and what is left of the closed
    ones. The active flag reaches the scan, so each side reads its own partition."""
    closed = purge_closed(history.where(~is_active()), before)
    return history.where(is_active()).unionByName(closed)
