"""Change feed to replica: initial load, incremental load, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.columns import spatial_to_hex, with_audit
from tidemark.functions.schema import union_aligned
from tidemark.operators.dedup import latest_per_key, latest_per_key_in_batch, split_ops
from tidemark.operators.merge import (
    DELETE,
    IGNORED,
    ChangeSet,
    apply_changes,
    change_set,
)


@dataclass(frozen=True)
class Batch:
    """All pending rows of one schema fingerprint and its newest delivery time."""

    fingerprint: str
    last_delivery: str
    rows: DataFrame


def in_delivery_order(batches: Sequence[Batch]) -> list[Batch]:
    return sorted(batches, key=lambda b: (int(b.last_delivery), b.fingerprint))


def cdc_initial(
    raw: DataFrame | Sequence[DataFrame], run_sk: int, run_ts, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """First state of a replica: latest row per key over all deliveries, deletes left out.

    ``raw`` carries the fingerprint and delivery columns. Several frames (one per schema
    version, oldest first) are aligned to the newest column types.
    """
    return split_ops(initial_latest(raw, run_sk, run_ts, keys), initial=True)[1]


def initial_latest(
    raw: DataFrame | Sequence[DataFrame], run_sk: int, run_ts, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """Latest row per key of an initial load, deletes included."""
    frames = [raw] if isinstance(raw, DataFrame) else list(raw)
    latest = latest_per_key(union_aligned([spatial_to_hex(f) for f in frames]), keys)
    return with_audit(latest, run_sk, run_ts)


def prepare_batch(
    batch: Batch, run_sk: int, run_ts, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """Latest row per key of one fingerprint, stamped with its newest delivery time."""
    rows = batch.rows.drop(n.FINGERPRINT, n.DELIVERY)
    rows = spatial_to_hex(rows).withColumns(
        {n.FINGERPRINT: F.lit(batch.fingerprint), n.DELIVERY: F.lit(batch.last_delivery)}
    )
    latest = latest_per_key_in_batch(rows, keys, (n.PAYLOAD_TS, n.SEQUENCE))
    return with_audit(latest, run_sk, run_ts, soft_delete=False)


def incremental_changes(
    target: DataFrame,
    batches: Sequence[Batch],
    run_sk: int,
    run_ts,
    keys: Sequence[str] = ("id",),
) -> ChangeSet:
    """Net effect of all pending batches, one row per key."""
    prepared = [prepare_batch(b, run_sk, run_ts, keys) for b in in_delivery_order(batches)]
    return change_set(prepared, target.schema, keys)


def cdc_incremental(
    target: DataFrame,
    batches: Sequence[Batch],
    run_sk: int,
    run_ts,
    keys: Sequence[str] = ("id",),
    broadcast_changes: bool = False,
) -> DataFrame:
    """New replica state after the pending batches of one run."""
    changes = incremental_changes(target, batches, run_sk, run_ts, keys)
    return apply_changes(target, changes, run_sk, broadcast_changes)


def change_counts(changes: ChangeSet) -> DataFrame:
    """One row: distinct keys, keys whose final outcome is a delete, ignored rows."""
    return changes.rows.agg(
        F.count(F.lit(1)).alias("rows_dedup"),
        F.count_if(F.col(DELETE)).alias("rows_deleted"),
        F.coalesce(F.sum(IGNORED), F.lit(0)).alias("rows_ignored"),
    )


def load_counts(run_sk: int) -> dict[str, Column]:
    """Counts over the rows a run wrote, as aggregates of the whole table or of a write.

    The plain inserted/updated counts include rows this run soft-deleted; the ``live``
    variants do not.
    """
    mine = F.col(n.RUN) == run_sk
    live = mine & (F.col(n.SOFT_DELETE) == "N")
    inserted = F.col(n.OPERATION).isin(n.OP_INSERT, n.OP_AFTER_IMAGE)
    updated = F.col(n.OPERATION) == n.OP_UPDATE
    return {
        "target_rows_loaded": F.count_if(live),
        "rows_inserted": F.count_if(mine & inserted),
        "rows_updated": F.count_if(mine & updated),
        "rows_inserted_live": F.count_if(inserted & live),
        "rows_updated_live": F.count_if(updated & live),
    }


def loaded_counts(target: DataFrame, run_sk: int) -> DataFrame:
    """One row of ``load_counts`` over a stored table."""
    mine = target.filter(F.col(n.RUN) == run_sk)
    return mine.agg(*[c.alias(name) for name, c in load_counts(run_sk).items()])


def reconcile_counts(
    rows_raw: DataFrame, deduped: DataFrame, loaded: DataFrame
) -> DataFrame:
    """Balance of a load from three one-row frames: ``rows_raw``; ``rows_dedup`` and
    ``rows_deleted``; the output of ``loaded_counts``.

    Read equals target rows + duplicates + deletes, else the load failed.
    """

    def one(df: DataFrame, column: str):
        return F.coalesce(df.select(column).scalar(), F.lit(0)).cast("long")

    base = loaded.withColumns(
        {
            "rows_read": one(rows_raw, "rows_raw"),
            "rows_deleted": one(deduped, "rows_deleted"),
            "rows_dedup": one(deduped, "rows_dedup"),
        }
    )
    duplicate = F.col("rows_read") - F.col("rows_dedup")
    counted = base.withColumn("rows_duplicate", duplicate).withColumn(
        "rows_loaded", F.col("target_rows_loaded") + F.col("rows_duplicate") + F.col("rows_deleted")
    )
    return counted.select(
        "rows_read",
        "rows_duplicate",
        "target_rows_loaded",
        "rows_inserted",
        "rows_updated",
        "rows_deleted",
        "rows_loaded",
        F.when(F.col("rows_read") == F.col("rows_loaded"), "S").otherwise("F").alias("status"),
    )


def cdc_reconcile(
    raw: DataFrame, changes: ChangeSet, target: DataFrame, run_sk: int, loaded: DataFrame | None = None
) -> DataFrame:
    """Reconciliation row of an incremental load; ``loaded`` has the counts of the load if they were
    taken while it was written."""
    return reconcile_counts(
        raw.agg(F.count(F.lit(1)).alias("rows_raw")),
        change_counts(changes),
        loaded_counts(target, run_sk) if loaded is None else loaded,
    )


def cdc_reconcile_initial(
    raw: DataFrame, latest: DataFrame, target: DataFrame, run_sk: int, loaded: DataFrame | None = None
) -> DataFrame:
    """Reconciliation row of an initial load; ``latest`` still holds the deletes; ``loaded`` as in
    ``cdc_reconcile``."""
    deduped = latest.agg(
        F.count(F.lit(1)).alias("rows_dedup"),
        F.count_if(F.col(n.OPERATION) == n.OP_DELETE).alias("rows_deleted"),
    )
    return reconcile_counts(
        raw.agg(F.count(F.lit(1)).alias("rows_raw")), deduped,
        loaded_counts(target, run_sk) if loaded is None else loaded,
    )
