"""Landing zone to raw zone: find new deliveries, register them, bring them in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import as_timestamp
from tidemark.operators import control
from tidemark.operators.surrogate import assign_surrogate
from tidemark.plans.parallel import for_each
from tidemark.plans.warehouse import Warehouse
from tidemark.sources import deliveries
from tidemark.sources.manifest import read_manifest

RAW_STEP, REPLICA_STEP = 10110, 10120
RAW_JOB, REPLICA_JOB = "stage_raw", "raw_replica"


def load_manifest(
    wh: Warehouse, landing: str, xcenter: str, run_sk: int, run_ts
) -> DataFrame:
    """Replace the manifest rows of a centre (old ones are archived) and shift the metadata."""
    fresh = read_manifest(wh.spark, f"{landing}/manifest.json", xcenter, run_sk, run_ts)
    current, archive = control.archive_then_replace(
        wh.control_rows("manifest"), wh.control_rows("manifest_archive"), fresh, xcenter
    )
    wh.control("manifest_archive").write(archive)
    manifest = wh.control("manifest").write(current)
    metadata = _with_new_tables(wh.control_rows("table_load_metadata"), manifest, xcenter, run_ts)
    shifted = control.shift_load_metadata(metadata, manifest, run_sk, run_ts, xcenter)
    wh.control("table_load_metadata").write(shifted)
    return manifest


def _with_new_tables(metadata: DataFrame, manifest: DataFrame, xcenter: str, run_ts) -> DataFrame:
    missing = control.new_table_metadata(metadata, manifest, xcenter)
    highest = F.coalesce(metadata.agg(F.max("table_id")).scalar(), F.lit(0))
    # One row per source table: a single-task numbering is bounded by the table list.
    position = F.row_number().over(Window.orderBy("table_name"))
    added = missing.select(
        (highest + position).cast("int").alias("table_id"),
        "table_name",
        F.lit("C").alias("load_status"),
        as_timestamp(run_ts).alias("insert_date_time"),
        F.lit(xcenter).alias("xcenter"),
    )
    return metadata.unionByName(added, allowMissingColumns=True)


def register_files(
    wh: Warehouse, landing: str, manifest: DataFrame, xcenter: str, run_sk: int, run_ts
) -> DataFrame:
    """Add the delivery folders that are new to the file table.

    After the first run only the folders of tables with news are listed, and of those only the
    ones newer than the table's previous write; names and times of those tables come to the
    driver for that.
    """
    files = wh.control_rows("file_loads")
    # What was moved to the archive is known as well, or a run would register it again.
    known = files.unionByName(wh.control_rows("file_loads_archive"))
    metadata = wh.control_rows("table_load_metadata")
    mine = F.col("xcenter") == xcenter
    news = control.tables_with_news(metadata.filter(mine), known.filter(mine))
    previous = F.col("previous_lastsuccessfulwritetimestamp").try_cast("bigint").alias("after")
    after = {r[0].lower(): r[1] or -1 for r in news.select("table_name", previous).collect()}
    listed = deliveries.list_deliveries(
        wh.spark, landing, xcenter, list(after), after if known.limit(1).count() else None
    )
    found = control.detect_new(
        listed,
        metadata.filter(mine),
        known.filter(mine),
        control.schema_history(manifest.filter(mine)),
    )
    fresh = control.new_files(found, metadata, known, run_sk)
    keyed = fresh.withColumn("_h", F.md5(F.concat_ws("/", "xcenter", "cloud_path")))
    start = F.coalesce(known.agg(F.max("file_load_id")).scalar(), F.lit(0))
    now = as_timestamp(run_ts)
    rows = assign_surrogate(keyed, "file_load_id", start, key_hash="_h", prefix=1).withColumns(
        {"is_loaded": F.lit(False), "insert_date_time": now, "update_date_time": now}
    )
    return wh.control("file_loads").write(files.unionByName(rows.drop("_h")))


def sync_jobs(wh: Warehouse, xcenter: str, run_ts) -> DataFrame:
    """Raw and replica jobs of every table, valid where the table has news."""
    jobs = wh.control_rows("jobs")
    metadata = wh.control_rows("table_load_metadata")
    for step, kind, name in ((RAW_STEP, "RAW", RAW_JOB), (REPLICA_STEP, "RPL", REPLICA_JOB)):
        jobs = control.sync_job_list(jobs, metadata, step, kind, name, xcenter, run_ts)
    return wh.control("jobs").write(jobs)


def land(
    wh: Warehouse, landing: str, xcenter: str, run_sk: int, run_ts, workers: int = 8
) -> list[str]:
    """Bring every pending delivery into the raw zone; returns the tables that succeeded.

    Tables are landed side by side. The names of the pending folders come to the driver in one
    small job, because a scan needs its paths; rows never do. A table is marked loaded only
    when both zones hold the same rows.
    """
    files = wh.control_rows("file_loads")
    window = control.pending_window(wh.control_rows("jobs"), files, RAW_STEP, xcenter)
    window = window.select(F.col("table_name").alias("_t"), "start_timestamp", "end_timestamp")
    waiting = files.filter(~F.col("is_loaded") & (F.col("xcenter") == xcenter)).join(
        window, F.lower("table_name") == F.col("_t")
    )
    pending: dict[str, list[tuple[str, str]]] = {}
    ends: dict[str, int] = {}
    for row in waiting.select("_t", "gw_fingerprint", "gw_timestamp", "end_timestamp").collect():
        pending.setdefault(row["_t"], []).append((row["gw_fingerprint"], row["gw_timestamp"]))
        ends[row["_t"]] = row["end_timestamp"]

    def land_one(table: str) -> bool:
        deliveries.land_to_raw(wh.spark, pending[table], landing, wh.raw, table)
        return _rows_agree(wh, pending[table], landing, table)

    tables = sorted(pending)
    loaded = [t for t, ok in zip(tables, for_each(wh.spark, land_one, tables, workers)) if ok]
    if not loaded:
        return []
    done = wh.spark.createDataFrame(
        [(t, ends[t]) for t in loaded], "table_name string, end_timestamp bigint"
    )
    landed = waiting.filter(F.col("_t").isin(loaded)).select(
        "table_name",
        "gw_fingerprint",
        "gw_timestamp",
        "cloud_path",
        "xcenter",
        F.lit(run_sk).alias("cyc_run_sk"),
    )
    wh.control("raw_table_load").append(landed)
    wh.control("file_loads").write(control.mark_loaded_until(files, done, xcenter, run_ts))
    metadata = wh.control_rows("table_load_metadata")
    wh.control("table_load_metadata").write(
        control.mark_complete(metadata, loaded, xcenter, run_ts)
    )
    return loaded


def _rows_agree(wh: Warehouse, pairs, landing: str, table: str) -> bool:
    """Same number of rows per delivery in both zones (parquet footers answer this)."""
    spark = wh.spark
    source = [deliveries.folder(landing, table, *p) for p in pairs]
    target = [deliveries.folder(wh.raw, table, *p, raw=True) for p in pairs]
    checked = deliveries.rows_reconcile(
        deliveries.folder_rows(deliveries.read_folders(spark, source)),
        deliveries.folder_rows(deliveries.read_folders(spark, target)),
    )
    verdict = checked.agg(F.bool_and(F.col("status") == "S").alias("ok")).first()
    return bool(verdict["ok"])


def ingest(
    wh: Warehouse, landing: str, xcenter: str, run_sk: int, run_ts, workers: int = 8
) -> list[str]:
    """Manifest, detection, registration and landing of one cycle."""
    manifest = load_manifest(wh, landing, xcenter, run_sk, run_ts)
    register_files(wh, landing, manifest, xcenter, run_sk, run_ts)
    sync_jobs(wh, xcenter, run_ts)
    return land(wh, landing, xcenter, run_sk, run_ts, workers)
