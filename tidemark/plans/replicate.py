"""Raw zone to replica of one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.columns import spatial_to_hex
from tidemark.functions.schema import align_target_to_source
from tidemark.operators.cdc import (
    Batch,
    cdc_reconcile,
    cdc_reconcile_initial,
    in_delivery_order,
    incremental_changes,
    initial_latest,
    load_counts,
)
from tidemark.operators.control import job_metrics
from tidemark.operators.dedup import split_ops
from tidemark.operators.merge import apply_changes
from tidemark.plans.warehouse import Warehouse
from tidemark.session import Staging, fits_broadcast
from tidemark.sources import deliveries
from tidemark.sources.counting import Counting

# A change set of at most this many rows (and 64 MB) goes to every task that scans the replica.
BROADCAST_ROWS = 200_000


def table_batches(wh: Warehouse, table: str, folders: DataFrame) -> list[Batch]:
    """One batch per schema fingerprint of the given folders, oldest first.

    Only folder names come to the driver: a scan is given its paths.
    """
    by_fingerprint: dict[str, list[str]] = {}
    for row in folders.select("gw_fingerprint", "gw_timestamp").distinct().collect():
        by_fingerprint.setdefault(row["gw_fingerprint"], []).append(row["gw_timestamp"])
    batches = []
    for fingerprint, times in by_fingerprint.items():
        times = sorted(times, key=int)
        paths = [deliveries.folder(wh.raw, table, fingerprint, t, raw=True) for t in times]
        rows = deliveries.read_folders(wh.spark, paths)
        batches.append(Batch(fingerprint, times[-1], rows))
    return in_delivery_order(batches)


def _count(batches: list[Batch]) -> DataFrame:
    """All rows of the batches as a frame without columns of interest (a footer count)."""
    rows = None
    for batch in batches:
        one = batch.rows.select(F.lit(1).alias("one"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def waiting_deliveries(wh: Warehouse, xcenter: str) -> DataFrame:
    """Landed deliveries of a centre that no replica holds yet, whichever run landed them."""
    identity = ["_t", "gw_fingerprint", "gw_timestamp"]
    mine = F.col("xcenter") == xcenter
    named = F.upper("table_name").alias("_t")
    applied = wh.control_rows("replica_load").filter(mine).select(named, *identity[1:])
    landed = wh.control_rows("raw_table_load").filter(mine).withColumn("_t", named)
    return landed.join(applied.distinct(), identity, "left_anti")


def waiting_tables(wh: Warehouse, xcenter: str) -> list[str]:
    """Names, in lower case, of the tables with deliveries to apply."""
    names = waiting_deliveries(wh, xcenter).select(F.lower("table_name").alias("t")).distinct()
    return sorted(r["t"] for r in names.collect())


def failed_job(wh: Warehouse, table: str, error: Exception, job_sk: int = 0) -> DataFrame:
    """Metrics row of a job that ended with an error; its deliveries stay waiting."""
    none = wh.spark.range(1).select(
        *[F.lit(0).cast("long").alias(f"rows_{x}") for x in ("read", "loaded", "inserted", "updated")],
        F.lit("F").alias("status"),
    )
    row = job_metrics(none, job_sk, table).withColumn("error_msg", F.lit(str(error)[:500]))
    return wh.spark.createDataFrame(row.collect(), row.schema)


def replicate(
    wh: Warehouse,
    table: str,
    run_sk: int,
    run_ts,
    xcenter: str,
    job_sk: int = 0,
    broadcast_rows: int = BROADCAST_ROWS,
    compat: bool = False,
) -> DataFrame:
    """Create or update the replica and return the metrics row of the job.

    First run: every landed delivery. Later runs: those that no earlier run applied, so what a
    failed run left behind is taken up again. Applying a delivery twice gives the same rows.
    The deduplicated changes are staged, so they are computed once, their size is known
    before a broadcast is chosen, and every count reads them instead of the raw files; the counts of
    the new state are taken while it is written.
    """
    waiting = waiting_deliveries(wh, xcenter).filter(F.col("_t") == table.upper())
    with Staging(wh.spark) as staging:
        waiting = staging.put(waiting.drop("_t"), "waiting")
        metrics = apply_deliveries(
            wh, table, waiting, staging, run_sk, run_ts, job_sk, broadcast_rows, compat
        )
        wh.control("replica_load").append(waiting.withColumn("cyc_run_sk", F.lit(run_sk)))
        return metrics


def apply_deliveries(
    wh: Warehouse,
    table: str,
    waiting: DataFrame,
    staging: Staging,
    run_sk: int,
    run_ts,
    job_sk: int = 0,
    broadcast_rows: int = BROADCAST_ROWS,
    compat: bool = False,
    notes: dict | None = None,
) -> DataFrame:
    """Bring the replica up to date with the folders of ``waiting``; the metrics row of the job.
    ``notes`` are committed together with the new state."""
    replica = wh.replica(table)
    counting = Counting(load_counts(run_sk))
    batches = table_batches(wh, table, waiting)
    if not batches:
        raise LookupError(f"no delivery of {table} waits to be applied")
    if not replica.exists():
        latest = initial_latest([b.rows for b in batches], run_sk, run_ts)
        latest = staging.put(latest, "latest")
        state = replica.write(
            split_ops(latest, initial=True)[1], counting, notes, staging.bytes_of("latest")
        )
        balance = cdc_reconcile_initial(_count(batches), latest, state, run_sk, counting.row(wh.spark))
    else:
        newest = spatial_to_hex(batches[-1].rows)
        stored = replica.read()
        target = align_target_to_source(stored, newest, compat)
        changes = incremental_changes(target, batches, run_sk, run_ts)
        changes = changes.staged(staging, "changes")
        small = fits_broadcast(changes.rows, broadcast_rows)
        if target.schema == stored.schema:  # only the buckets of changed keys
            buckets = replica.touched(changes.rows)
            part = apply_changes(replica.read(buckets), changes, run_sk, broadcast_changes=small)
            state = replica.write_buckets(part, buckets, counting, notes)
        else:
            state = replica.write(
                apply_changes(target, changes, run_sk, broadcast_changes=small), counting, notes
            )
        balance = cdc_reconcile(_count(batches), changes, state, run_sk, counting.row(wh.spark))
    metrics = job_metrics(balance, job_sk, table)
    # The staged tables go away, so the one metrics row is fetched before that.
    return wh.spark.createDataFrame(metrics.collect(), metrics.schema)
