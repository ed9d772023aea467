"""Replication of a table as a stream over its raw delivery folders.

The file source of Structured Streaming finds the folders that landed since the last trigger and
keeps that in its checkpoint; each micro-batch brings the replica up to date with its folders. A
trigger takes all that is there and ends, so a cycle can call it where it calls the batch job.

A stream has one schema, but deliveries do not: the stream therefore reads only the partition values
of the files, and the folders of a micro-batch are read with the schema of their fingerprint.

Exactly once: the number of the micro-batch is committed in the same rename as the new state of the
replica. If a job dies after that and the checkpoint gives the micro-batch out again, it finds its
number there and leaves the replica as it is. Run numbers follow from the number of the micro-batch,
so a repeat after a failed write gives the same rows as the first try would have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.plans.replicate import apply_deliveries
from tidemark.plans.warehouse import Warehouse
from tidemark.session import Staging

#: Note of the replica that holds the number of the last micro-batch applied.
BATCH = "stream_batch"


def delivery_stream(wh: Warehouse, table: str, most_files: int | None = None) -> DataFrame:
    """Stream of the fingerprint and time of each row that lands; no column of the files is read."""
    reader = wh.spark.readStream.schema(f"{n.FINGERPRINT} string, {n.DELIVERY} string")
    if most_files:
        reader = reader.option("maxFilesPerTrigger", most_files)
    return reader.parquet(f"{wh.raw}/{table}")


def apply_batch(
    wh: Warehouse, table: str, rows: DataFrame, batch: int, run_sk: int, run_ts, xcenter: str
) -> bool:
    """Apply the folders that ``rows`` come from; False if micro-batch ``batch`` was applied before.
    The load log is brought up to date in both cases."""
    replica, spark = wh.replica(table), wh.spark
    pairs = rows.select(n.FINGERPRINT, n.DELIVERY).distinct().collect()  # folder names
    if not pairs:
        return False
    folders = spark.createDataFrame(
        [(table.upper(), r[0], r[1], xcenter) for r in pairs],
        "table_name string, gw_fingerprint string, gw_timestamp string, xcenter string",
    )
    fresh = replica.note(BATCH, -1) < batch
    with Staging(spark) as staging:
        if fresh:
            apply_deliveries(wh, table, folders, staging, run_sk, run_ts, notes={BATCH: batch})
        identity = ["table_name", "gw_fingerprint", "gw_timestamp"]
        logged = wh.control_rows("replica_load").withColumn("table_name", F.upper("table_name"))
        missing = folders.join(logged, identity, "left_anti").select(
            *identity, F.lit(None).cast("string").alias("cloud_path"), "xcenter", F.lit(run_sk).alias("cyc_run_sk")
        )
        missing = staging.put(missing, "missing")
        if not missing.isEmpty():
            wh.control("replica_load").append(missing)
    return fresh


def replicate_stream(
    wh: Warehouse,
    table: str,
    run_of: Callable[[int], int],
    run_ts,
    xcenter: str,
    most_files: int | None = None,
) -> list[int]:
    """Apply what has landed since the last call; returns the numbers of the micro-batches applied.

    ``run_of`` gives the run of a micro-batch and must always give the same. ``most_files`` bounds the
    files of a micro-batch; a folder that this splits is applied whole with its first file and once
    more with each further batch, which changes no value of its rows but their run.
    """
    applied: list[int] = []

    def each(rows: DataFrame, batch: int) -> None:
        if apply_batch(wh, table, rows, batch, run_of(batch), run_ts, xcenter):
            applied.append(batch)

    stream = delivery_stream(wh, table, most_files).writeStream.foreachBatch(each)
    stream = stream.option("checkpointLocation", f"{wh.root}/streams/{table}").trigger(availableNow=True)
    stream.start().awaitTermination()
    return applied
