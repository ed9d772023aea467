"""Upsert and soft delete of change batches into a replica table.

A change set holds ONE row per key, whatever number of schema versions the run
delivered, so the target is read and moved once per run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import names as n
from tidemark.functions.columns import named
from tidemark.functions.schema import cast_like, spelled_like

UPSERT = "_upsert"
DELETE = "_delete"
IGNORED = "_ignored"


@dataclass(frozen=True)
class ChangeSet:
    """Net effect of a run per key.

    ``rows``: key columns, value columns, ``_upsert``/``_delete`` (final outcome),
    ``_ignored`` (batch rows with another code). ``present`` names, for columns that
    only some batches carry, the flag telling whether the key's value was delivered.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    present: Mapping[str, str] = field(default_factory=dict)

    @property
    def value_columns(self) -> list[str]:
        control = {UPSERT, DELETE, IGNORED, *self.present.values()}
        return [c for c in self.rows.columns if c not in control and c not in self.keys]

    def staged(self, staging, name: str) -> ChangeSet:
        return ChangeSet(staging.put(self.rows, name), self.keys, self.present)


def _kinds(op: Column) -> dict[str, Column]:
    upsert = F.coalesce(op.isin(*n.UPSERT_OPS), F.lit(False))
    delete = F.coalesce(op == n.OP_DELETE, F.lit(False))
    return {
        UPSERT: upsert,
        DELETE: delete,
        IGNORED: (~upsert & ~delete).cast("long"),
    }


def change_set(
    batches: Sequence[DataFrame], target: T.StructType, keys: Sequence[str] = ("id",)
) -> ChangeSet:
    """Combine batches (one row per key each, oldest first) into their net effect.

    Every batch is cast to the column types known so far: those of the target, then those
    first seen in an earlier batch. Later upserts win column by column, a column missing in a
    later batch keeps the earlier value, and a delete counts only after the last upsert.
    """
    known = {f.name.lower(): f for f in target.fields}
    aligned = []
    for batch in batches:
        like = T.StructType(list(known.values()))
        batch = cast_like(spelled_like(batch, like), like)
        known.update({f.name.lower(): f for f in batch.schema.fields if f.name.lower() not in known})
        aligned.append(batch)
    keys = tuple(named(aligned[0], k) or k for k in keys)
    if len(aligned) == 1:
        return ChangeSet(aligned[0].withColumns(_kinds(F.col(n.OPERATION))), keys)
    return _net_effect(aligned, keys)


def _net_effect(batches: Sequence[DataFrame], keys: tuple[str, ...]) -> ChangeSet:
    carriers: dict[str, tuple[int, ...]] = {}
    for i, batch in enumerate(batches):
        for c in batch.columns:
            if c not in keys:
                carriers[c] = (*carriers.get(c, ()), i)
    groups: dict[tuple[int, ...], list[str]] = {}
    for c, where in carriers.items():
        groups.setdefault(where, []).append(c)

    stacked = None
    for i, batch in enumerate(batches):
        batch = batch.withColumns({**_kinds(F.col(n.OPERATION)), "_seq": F.lit(i)})
        stacked = batch if stacked is None else stacked.unionByName(batch, allowMissingColumns=True)

    seq = F.col("_seq")
    aggregates = [
        F.max(F.when(F.col(UPSERT), seq)).alias("_last_upsert"),
        F.max(F.when(F.col(DELETE), seq)).alias("_last_delete"),
        F.sum(IGNORED).alias(IGNORED),
    ]
    for g, (where, columns) in enumerate(groups.items()):
        newest = F.when(F.col(UPSERT) & seq.isin(*where), seq)
        packed = F.struct(*[F.col(f"`{c}`") for c in columns])
        aggregates.append(F.max_by(packed, newest).alias(f"_v{g}"))
    net = stacked.groupBy(*keys).agg(*aggregates)

    present, values = {}, []
    for g, (where, columns) in enumerate(groups.items()):
        values += [F.col(f"_v{g}.`{c}`").alias(c) for c in columns]
        if len(where) < len(batches):
            present.update({c: f"_has{g}" for c in columns})
            values.append(F.col(f"_v{g}").isNotNull().alias(f"_has{g}"))
    rows = net.select(
        *keys,
        *values,
        F.col("_last_upsert").isNotNull().alias(UPSERT),
        (F.coalesce("_last_delete", F.lit(-1)) > F.coalesce("_last_upsert", F.lit(-1))).alias(DELETE),
        IGNORED,
    )
    return ChangeSet(rows, keys, present)


def apply_changes(
    target: DataFrame, changes: ChangeSet, run_sk: int, broadcast_changes: bool = False
) -> DataFrame:
    """New state of ``target`` after a change set.

    Upserted keys take all delivered columns and become live again; deleted keys keep their
    values and get ``Soft_Delete`` 'Y' with this run id; a delete of an unknown key is ignored.

    By default one full outer join moves the target once. ``broadcast_changes`` is for a
    change set whose size the caller has checked: the target is then streamed in place, and
    only its key column is read a second time to find the new keys.
    """
    rows = changes.rows
    prefixed = {c: f"_s_{c}" for c in rows.columns}
    source = rows.withColumnsRenamed(prefixed).withColumn("_s", F.lit(True))
    old = target.withColumn("_t", F.lit(True))
    match = [F.col(k) == F.col(f"_s_{k}") for k in changes.keys]
    if not broadcast_changes:
        joined = old.join(source, match, "full_outer")
    else:
        matched = old.join(F.broadcast(source), match, "left")
        probe = F.broadcast(rows.select(*changes.keys))
        found = target.select(*changes.keys).join(probe, list(changes.keys), "left_semi")
        fresh = source.join(found, match, "left_anti")
        joined = matched.unionByName(fresh, allowMissingColumns=True)
    return _resolve(joined, target, changes, run_sk)


def _resolve(joined: DataFrame, target: DataFrame, changes: ChangeSet, run_sk: int) -> DataFrame:
    upsert = F.coalesce(F.col(f"_s_{UPSERT}"), F.lit(False))
    delete = F.coalesce(F.col(f"_s_{DELETE}"), F.lit(False))
    exists = F.col("_t").isNotNull()
    delivered = set(changes.value_columns)
    types = {f.name: f.dataType for f in target.schema.fields}
    new = [c for c in changes.value_columns if c not in types]

    def value(c: str) -> Column:
        old = F.col(f"`{c}`") if c in types else F.lit(None)
        if c in changes.keys:
            return F.coalesce(old, F.col(f"`_s_{c}`"))
        if c.lower() == n.SOFT_DELETE.lower():
            return F.when(delete, "Y").when(upsert, "N").otherwise(old)
        if c.lower() == n.RUN.lower():
            return F.when(upsert | delete, F.lit(run_sk).cast("int")).otherwise(old)
        if c not in delivered:
            return old
        take = upsert
        if c in changes.present:
            take = take & F.coalesce(F.col(f"_s_{changes.present[c]}"), F.lit(False))
        return F.when(take, F.col(f"`_s_{c}`")).otherwise(old)

    kept = joined.filter(exists | upsert)
    return kept.select(*[value(c).alias(c) for c in [*target.columns, *new]])


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = ("id",),
    broadcast_source: bool = False,
) -> DataFrame:
    """Insert or overwrite by key; ``source`` must be unique on ``keys``.

    Columns the source lacks keep the target's value, new source columns are added.
    """
    source = cast_like(spelled_like(source, target.schema), target.schema)
    values = [c for c in source.columns if c not in keys]
    added = [c for c in values if named(target, c) is None]
    right = source.withColumnsRenamed({c: f"_s_{c}" for c in source.columns})
    right = right.withColumn("_s", F.lit(True))
    match = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    if broadcast_source:
        matched = target.join(F.broadcast(right), match, "left")
        probe = F.broadcast(source.select(*keys))
        found = target.select(*keys).join(probe, list(keys), "left_semi")
        fresh = right.join(found, match, "left_anti")
        joined = matched.unionByName(fresh, allowMissingColumns=True)
    else:
        joined = target.join(right, match, "full_outer")
    hit = F.col("_s").isNotNull()

    def value(c: str) -> Column:
        old = F.col(f"`{c}`") if c not in added else F.lit(None)
        if c in keys:
            return F.coalesce(old, F.col(f"`_s_{c}`"))
        return F.when(hit, F.col(f"`_s_{c}`")).otherwise(old) if c in values else old

    return joined.select(*[value(c).alias(c) for c in [*target.columns, *added]])
