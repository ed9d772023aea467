"""Latest state per key as a fold: an aggregate that merges, delivery by delivery.

The state after some deliveries is what their own states merge to, in any order and with repeats, so
a new delivery meets the state, and the deliveries of the past are not read again. It is the row that
``latest_per_key`` keeps of all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.hashing import content_hash


def recency(df: DataFrame, order: Sequence[str]) -> Column:
    """What the rows of a key are compared by: NULL comes first, ties go by content."""
    return F.struct(*[F.col(f"`{c}`") for c in order], F.bitwise_not(content_hash(df)).alias("_tie"))


def latest_state(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = n.RECENCY, per: Sequence[str] = ()
) -> DataFrame:
    """The row of each key that is greatest in ``order``, with ``per`` the one of each key and value of
    these columns (a state per delivery, say). Every map task sends one row a key."""
    group = list(dict.fromkeys([*keys, *per]))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    best = df.groupBy(*[F.col(f"`{c}`") for c in group]).agg(F.max_by(row, recency(df, order)).alias("_row"))
    return best.select("_row.*")


def merge_states(states: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = n.RECENCY) -> DataFrame:
    """The state of all deliveries that the given states hold."""
    rows = states[0]
    for more in states[1:]:
        rows = rows.unionByName(more)
    return latest_state(rows, keys, order)


def state_at(states: DataFrame, keys: Sequence[str], cutoff: int, order: Sequence[str] = n.RECENCY, delivery: str = n.DELIVERY) -> DataFrame:
    """The state at a delivery time, from states per delivery; later ones are not read if the table is
    laid out by delivery."""
    return latest_state(states.where(F.col(f"`{delivery}`").cast("bigint") <= cutoff), keys, order)
