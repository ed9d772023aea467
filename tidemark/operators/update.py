"""UPDATE ... WHERE key IN (...) as a projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.columns import named
from tidemark.functions.hashing import content_hash
from tidemark.operators.skew import skew_left_join


def assign(df: DataFrame, hit: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set ``values`` on the rows where ``hit`` is true; other rows stay as they are."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for wanted, value in values.items():
        column = named(df, wanted)
        if column is None:
            raise ValueError(f"no column {wanted!r} to update")
        changed[column] = F.when(hit, value.cast(types[column])).otherwise(F.col(f"`{column}`"))
    return df.withColumns(changed)


def update_where_in(
    df: DataFrame,
    keys_df: DataFrame,
    on: Sequence[tuple[Column, Column]],
    values: Mapping[str, Column],
    guard: Column | None = None,
    salts: int = 0,
) -> DataFrame:
    """Update rows whose key occurs in ``keys_df``.

    ``on`` pairs an expression over ``df`` with one over ``keys_df``. The key side is made
    unique first, so the join neither multiplies rows nor loses any; NULL keys never hit.
    ``salts`` > 1 spreads a single key that many rows of ``df`` share over that many tasks.
    """
    names = [f"_k{i}" for i in range(len(on))]
    wanted = keys_df.select(*[right.alias(k) for (_, right), k in zip(on, names)]).distinct()
    wanted = wanted.dropna().withColumn("_hit", F.lit(True))
    left = df.withColumns({f"_l{i}": expr for i, (expr, _) in enumerate(on)})
    if salts > 1 and len(on) == 1:
        joined = skew_left_join(left, wanted, "_l0", "_k0", content_hash(df), salts)
    else:
        condition = [F.col(f"_l{i}") == F.col(f"_k{i}") for i in range(len(on))]
        joined = left.join(wanted, condition, "left")
    hit = F.col("_hit").isNotNull()
    if guard is not None:
        hit = hit & guard
    return assign(joined, hit, values).select(*[F.col(f"`{c}`") for c in df.columns])


def soft_delete(
    target: DataFrame, deletes: DataFrame, run_sk: int, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """Flag deleted keys; rows are never removed and unknown keys are ignored."""
    return update_where_in(
        target,
        deletes,
        [(F.col(k), F.col(k)) for k in keys],
        {n.SOFT_DELETE: F.lit("Y"), n.RUN: F.lit(run_sk)},
    )


def flag_failed(
    target: DataFrame, failed: DataFrame, primary_key: str, run_sk: int
) -> DataFrame:
    """Set the validation flag 'F' on rows of this run whose key failed a rule."""
    return update_where_in(
        target,
        failed,
        [(F.col(primary_key), F.col(primary_key))],
        {n.VALIDATION: F.lit("F")},
        guard=F.col(n.RUN) == run_sk,
    )
