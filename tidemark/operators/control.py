"""Control tables: what is new, what is pending, what ran.

Table names compare without case, delivery times compare as numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import as_timestamp, epoch, last_segment

FULL, INCREMENTAL = "FULL", "INCREMENTAL"


# --------------------------------------------------------------------------- manifest


def schema_history(manifest: DataFrame) -> DataFrame:
    """One row per table and fingerprint with the time it was first seen."""
    return manifest.select(
        last_segment(F.col("datafilespath")).alias("table_name"),
        F.explode("schemahistory").alias("fingerprint", "first_seen_ts"),
    )


def fingerprint_in_text(column: str):
    """First fingerprint of a history kept as text, such as ``{'<32 hex digits>': 17}``."""
    return F.regexp_extract(F.col(column), "'([^']{32})", 1)


def latest_fingerprint(compat: bool = False):
    """Newest fingerprint of a history map; ``compat`` takes its first entry instead."""
    entries = F.map_entries("schemahistory")
    if compat:
        return F.element_at(entries, 1)["key"]
    newest = F.sort_array(
        F.transform(entries, lambda e: F.struct(epoch(e["value"]).alias("ts"), e["key"].alias("fp"))),
        asc=False,
    )
    return F.get(newest, 0)["fp"]


def shift_load_metadata(
    metadata: DataFrame,
    manifest: DataFrame,
    run_sk: int,
    run_ts,
    xcenter: str,
    compat: bool = False,
) -> DataFrame:
    """Move LATEST to PREVIOUS and take the new LATEST from the manifest; status 'I'.

    A table whose manifest time did not change is left alone, so running the step twice in
    one cycle is harmless; ``compat`` shifts every table named in the manifest.
    """
    new = manifest.filter(F.col("xcenter") == xcenter).select(
        last_segment(F.col("datafilespath")).alias("_t"),
        F.col("lastsuccessfulwritetimestamp").alias("_ts"),
        latest_fingerprint(compat).alias("_fp"),
    )
    latest = "latest_lastsuccessfulwritetimestamp"
    same = F.upper("table_name") == F.col("_t")
    if not compat:  # a table name may occur in several centres
        same = same & (F.col("xcenter") == xcenter)
    joined = metadata.join(new, same, "left")
    hit = F.col("_t").isNotNull()
    if not compat:
        hit = hit & ~epoch("_ts").eqNullSafe(epoch(latest))
    shifted = {
        "previous_lastsuccessfulwritetimestamp": F.col(latest),
        "previous_fingerprint": F.col("latest_fingerprint"),
        latest: F.col("_ts"),
        "latest_fingerprint": F.col("_fp"),
        "load_status": F.lit("I"),
        "update_date_time": as_timestamp(run_ts),
        "cyc_run_sk": F.lit(run_sk),
    }
    return joined.select(
        *[
            F.when(hit, shifted[c]).otherwise(F.col(c)).alias(c) if c in shifted else F.col(c)
            for c in metadata.columns
        ]
    )


def new_table_metadata(metadata: DataFrame, manifest: DataFrame, xcenter: str) -> DataFrame:
    """Names of manifest tables that have no load metadata yet."""
    named = manifest.filter(F.col("xcenter") == xcenter).select(
        last_segment(F.col("datafilespath")).alias("table_name")
    )
    mine = metadata.filter(F.col("xcenter") == xcenter)
    return named.join(mine.select(F.upper("table_name").alias("table_name")), "table_name", "left_anti")


# -------------------------------------------------------------------------- detection


def tables_with_news(metadata: DataFrame, files: DataFrame) -> DataFrame:
    """Tables whose latest write is newer than every known delivery (default 0)."""
    known = files.groupBy(F.upper("table_name").alias("_t")).agg(
        F.max(epoch("gw_timestamp")).alias("_known")
    )
    joined = metadata.join(known, F.upper("table_name") == F.col("_t"), "left")
    newer = epoch("latest_lastsuccessfulwritetimestamp") > F.coalesce("_known", F.lit(0))
    return joined.filter(newer).select(*metadata.columns)


def detect_new(
    listed: DataFrame, metadata: DataFrame, files: DataFrame, history: DataFrame
) -> DataFrame:
    """Delivery folders to register.

    With an empty ``files`` table: every listed folder of a (table, fingerprint) the manifest
    knows. Otherwise only folders of tables with news, newer than the table's previous write.
    The choice is part of the plan, so nothing is collected.
    """
    first_run = files.agg((F.count(F.lit(1)) == 0)).scalar()
    in_manifest = history.select(
        F.lower("table_name").alias("_t"), F.col("fingerprint").alias("_fp")
    ).distinct()
    candidates = listed.join(
        in_manifest,
        (F.lower("table_name") == F.col("_t")) & (F.col("gw_fingerprint") == F.col("_fp")),
        "left_semi",
    )
    news = tables_with_news(metadata, files).select(
        F.lower("table_name").alias("_n"),
        F.coalesce(epoch("previous_lastsuccessfulwritetimestamp"), F.lit(0)).alias("_prev"),
    )
    joined = candidates.join(news, F.lower("table_name") == F.col("_n"), "left")
    wanted = F.col("_n").isNotNull() & (epoch("gw_timestamp") > F.col("_prev"))
    picked = joined.filter(first_run | wanted)
    return picked.select(*listed.columns).distinct()


def load_type(files: DataFrame) -> DataFrame:
    """One row: FULL when no file was ever registered, else INCREMENTAL."""
    empty = F.count(F.lit(1)) == 0
    return files.agg(F.when(empty, FULL).otherwise(INCREMENTAL).alias("load_type"))


def new_files(
    listed: DataFrame,
    metadata: DataFrame,
    known: DataFrame,
    run_sk: int,
    compat: bool = False,
) -> DataFrame:
    """Listed folders of tables in status 'I' that are not registered yet.

    The fingerprint is part of the identity of a folder; ``compat`` leaves it out.
    """
    loading = metadata.filter(F.col("load_status") == "I").select(
        F.upper("table_name").alias("_t"), F.col("xcenter").alias("_x")
    )
    pending = listed.join(
        loading.distinct(),
        (F.upper("table_name") == F.col("_t")) & (F.col("xcenter") == F.col("_x")),
        "left_semi",
    )
    identity = ["table_name", "gw_timestamp", "xcenter"]
    if not compat:
        identity.append("gw_fingerprint")
    fresh = pending.join(known.select(*identity), identity, "left_anti")
    return fresh.select(*listed.columns, F.lit(run_sk).alias("cyc_run_sk"))


def pending_files(
    files: DataFrame, table: str, xcenter: str, start_ts: int, end_ts: int
) -> DataFrame:
    """Folders of one table that are registered but not loaded, inside the window."""
    return files.filter(
        (F.upper("table_name") == table.upper())
        & ~F.col("is_loaded")
        & (F.col("xcenter") == xcenter)
        & epoch("gw_timestamp").between(start_ts, end_ts)
    ).orderBy(epoch("gw_timestamp"), "gw_fingerprint")


# ------------------------------------------------------------------------------- jobs


def _ready(jobs: DataFrame, step_sk: int | None, valid: bool = True) -> DataFrame:
    out = jobs.filter((F.col("job_sts_cd") == "C") & (F.col("acti_ind") == "Y"))
    if valid:
        out = out.filter(F.col("cur_cyc_valid") == "Y")
    return out if step_sk is None else out.filter(F.col("step_sk") == step_sk)


def pending_window(
    jobs: DataFrame, files: DataFrame, step_sk: int, xcenter: str
) -> DataFrame:
    """First and last pending delivery of every job that may run in this cycle."""
    waiting = files.filter(~F.col("is_loaded") & (F.col("xcenter") == xcenter))
    waiting = waiting.groupBy(F.lower("table_name").alias("table_name")).agg(
        F.min(epoch("gw_timestamp")).alias("start_timestamp"),
        F.max(epoch("gw_timestamp")).alias("end_timestamp"),
    )
    ready = _ready(jobs, step_sk).select(
        F.lower("tgt_file_tbl").alias("table_name"), "step_sk", "job_sk"
    )
    return ready.join(waiting, "table_name").select(
        "table_name",
        "start_timestamp",
        "end_timestamp",
        "step_sk",
        "job_sk",
        F.lit(xcenter).alias("xcenter"),
    )


def ready_for_replica(
    jobs: DataFrame, metadata: DataFrame, step_sk: int, xcenter: str, run_sk: int
) -> DataFrame:
    """Replica jobs whose table has been landed in this cycle."""
    landed = metadata.filter((F.col("xcenter") == xcenter) & (F.col("load_status") == "C"))
    landed = landed.select(F.upper("table_name").alias("_t"))
    ready = _ready(jobs, step_sk).filter(F.col("job_typ_cd") == "RPL")
    return ready.join(landed, F.upper("tgt_file_tbl") == F.col("_t")).select(
        F.lower("tgt_file_tbl").alias("tgt_file_tbl"),
        "job_sk",
        "step_sk",
        F.lit(run_sk).alias("cyc_run_sk"),
        F.lit(xcenter).alias("xcenter"),
    )


def ready_for_refined(jobs: DataFrame, step_sk: int, xcenter: str) -> DataFrame:
    """Refined jobs that are idle and enabled."""
    ready = _ready(jobs, step_sk, valid=False).filter(F.col("job_typ_cd") == "RFN")
    return ready.select(
        F.lower("tgt_file_tbl").alias("tgt_file_tbl"),
        "tgt_path_schem",
        "src_file_tbl",
        "job_sk",
        "step_sk",
        "src_path_schem",
        F.lit(xcenter).alias("xcenter"),
    )


def sync_job_list(
    jobs: DataFrame,
    metadata: DataFrame,
    step_sk: int,
    job_type: str,
    job_name: str,
    xcenter: str,
    run_ts,
) -> DataFrame:
    """Add jobs for tables that have none in this step, and mark which are valid now.

    New ids continue after the step's highest id in table-id order. The control tables hold
    one row per source table, so that numbering stays in one task.
    """
    tables = metadata.filter(F.col("xcenter") == xcenter)
    mine = jobs.filter(F.col("step_sk") == step_sk)
    highest = F.coalesce(mine.agg(F.max("job_sk")).scalar(), F.lit(step_sk * 1000))
    missing = tables.join(
        mine.select(F.lower("tgt_file_tbl").alias("_t")),
        F.lower("table_name") == F.col("_t"),
        "left_anti",
    )
    table = F.lower("table_name")
    added = missing.withColumn("_rn", F.row_number().over(Window.orderBy("table_id"))).select(
        (highest + F.col("_rn")).cast("int").alias("job_sk"),
        F.lit(f"{job_name}_{xcenter}").alias("job_nm"),
        F.lit(step_sk).alias("step_sk"),
        F.concat(F.lit(f"{job_name} for the table "), "table_name").alias("job_desc"),
        F.lit(job_type).alias("job_typ_cd"),
        table.alias("src_file_tbl"),
        table.alias("tgt_file_tbl"),
        F.lit("C").alias("job_sts_cd"),
        F.lit("Y").alias("acti_ind"),
    )
    extended = jobs.unionByName(added, allowMissingColumns=True)
    status = tables.select(
        F.lower("table_name").alias("_t"),
        F.when(F.col("load_status") == "I", "Y").otherwise("N").alias("_valid"),
    )
    joined = extended.join(
        status, (F.lower("tgt_file_tbl") == F.col("_t")) & (F.col("step_sk") == step_sk), "left"
    )
    hit = F.col("_t").isNotNull()
    values = {
        "cur_cyc_valid": F.col("_valid"),
        "job_sts_cd": F.lit("C"),
        "aud_dt_tm": as_timestamp(run_ts),
    }
    return joined.select(
        *[
            F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in jobs.columns
        ]
    )


def mark_loaded(
    files: DataFrame, table: str, xcenter: str, end_ts: int, run_ts
) -> DataFrame:
    """Mark the pending folders of a table up to ``end_ts`` as loaded."""
    hit = (
        (F.lower("table_name") == table.lower())
        & (F.col("xcenter") == xcenter)
        & ~F.col("is_loaded")
        & (epoch("gw_timestamp") <= end_ts)
    )
    return files.withColumns(
        {
            "is_loaded": F.col("is_loaded") | F.coalesce(hit, F.lit(False)),
            "update_date_time": F.when(hit, as_timestamp(run_ts)).otherwise(F.col("update_date_time")),
        }
    )


def mark_loaded_until(files: DataFrame, ends: DataFrame, xcenter: str, run_ts) -> DataFrame:
    """``mark_loaded`` for many tables at once; ``ends`` has (table_name, end_timestamp)."""
    ends = ends.select(F.lower("table_name").alias("_t"), F.col("end_timestamp").alias("_end"))
    joined = files.join(ends, F.lower("table_name") == F.col("_t"), "left")
    hit = (
        (F.col("xcenter") == xcenter) & ~F.col("is_loaded") & (epoch("gw_timestamp") <= F.col("_end"))
    )
    values = {
        "is_loaded": F.col("is_loaded") | F.coalesce(hit, F.lit(False)),
        "update_date_time": F.when(hit, as_timestamp(run_ts)).otherwise(F.col("update_date_time")),
    }
    return joined.withColumns(values).select(*files.columns)


def mark_complete(
    metadata: DataFrame, tables: str | Sequence[str], xcenter: str, run_ts
) -> DataFrame:
    """Set the load status of one or several tables to 'C'."""
    wanted = [t.upper() for t in ([tables] if isinstance(tables, str) else tables)]
    hit = F.upper("table_name").isin(wanted) & (F.col("xcenter") == xcenter)
    return metadata.withColumns(
        {
            "load_status": F.when(hit, "C").otherwise(F.col("load_status")),
            "update_date_time": F.when(hit, as_timestamp(run_ts)).otherwise(F.col("update_date_time")),
        }
    )


# ------------------------------------------------------------------------- housekeeping


def archive_then_replace(
    current: DataFrame, archive: DataFrame, new: DataFrame, xcenter: str
) -> tuple[DataFrame, DataFrame]:
    """(new current, new archive): rows of one centre move to the archive and make room."""
    mine = F.coalesce(F.col("xcenter") == xcenter, F.lit(False))
    return (
        current.filter(~mine).unionByName(new),
        archive.unionByName(current.filter(mine)),
    )


def archive_older_than(
    files: DataFrame, archive: DataFrame, now, xcenter: str, days: int = 30
) -> tuple[DataFrame, DataFrame]:
    """(kept files, new archive): loaded rows registered more than ``days`` ago move."""
    kept, moved = older_than(files, now, xcenter, days)
    return kept, archive.unionByName(moved)


def older_than(files: DataFrame, now, xcenter: str, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """(kept files, rows that go to the archive)."""
    cutoff = as_timestamp(now) - F.make_dt_interval(days=F.lit(days))
    old = F.coalesce(
        (F.col("xcenter") == xcenter)
        & F.col("is_loaded")
        & (F.col("insert_date_time") < cutoff),
        F.lit(False),
    )
    return files.filter(~old), files.filter(old)


def snapshot_copy(table: DataFrame, xcenter: str | None = None) -> DataFrame:
    """Rows a backup copy holds: those of one centre, or all."""
    return table if xcenter is None else table.filter(F.col("xcenter") == xcenter)


# -------------------------------------------------------------------------- run history


def latest_step_runs(step_runs: DataFrame, by: Sequence[str] = ("cyc_run_sk", "step_sk")) -> DataFrame:
    """Status of the latest attempt of each step in each cycle run."""
    return step_runs.groupBy(*by).agg(
        F.max_by("step_sts_cd", "step_run_sk").alias("step_sts_cd"),
        F.max("step_run_sk").alias("step_run_sk"),
    )


def restart_flags(cycle_runs: DataFrame, step_runs: DataFrame, step_sk: int) -> DataFrame:
    """Per cycle run: whether landed files are to be rewritten, and whether by force."""
    latest = latest_step_runs(step_runs.filter(F.col("step_sk") == step_sk))
    joined = cycle_runs.join(latest.drop("step_sk"), "cyc_run_sk", "left")
    step, cycle = F.col("step_sts_cd"), F.col("cyc_sts_cd")
    return joined.select(
        "cyc_run_sk",
        F.when((step == "I") & (cycle == "I"), "Y")
        .when(step.isin("F", "S") & (cycle == "F"), "N")
        .otherwise("Y")
        .alias("truncate"),
        F.when(step == "F", "Y").otherwise("N").alias("force_truncate"),
    )


def cycle_status(steps: DataFrame, by: Sequence[str] = ("cyc_sk",)) -> DataFrame:
    """'F' for a cycle with any failed step, else 'S'."""
    failed = F.coalesce(F.max(F.when(F.col("step_sts_cd") == "F", 1)), F.lit(0))
    return steps.groupBy(*by).agg(F.when(failed == 1, "F").otherwise("S").alias("cyc_sts_cd"))


def previous_good_run(step_runs: DataFrame, step_sk: int) -> DataFrame:
    """One row: cycle run of the last success of a step, 0 when there is none."""
    good = step_runs.filter((F.col("step_sk") == step_sk) & (F.col("step_sts_cd") == "S"))
    return good.agg(F.coalesce(F.max("cyc_run_sk"), F.lit(0)).alias("prev_cyc_run_sk"))


def job_metrics(reconciliation: DataFrame, job_sk: int, table: str) -> DataFrame:
    """Result row of a job from the output of a reconciliation."""
    have = reconciliation.columns
    deleted = F.col("rows_deleted") if "rows_deleted" in have else F.lit(0).cast("long")
    bad = F.concat(
        F.lit("rows read "), F.col("rows_read").cast("string"),
        F.lit(" do not match rows loaded "), F.col("rows_loaded").cast("string"),
        F.lit(f" for table {table}"),
    )
    return reconciliation.select(
        F.lit(job_sk).alias("job_sk"),
        F.lit(table).alias("table_name"),
        "rows_read",
        "rows_loaded",
        "rows_inserted",
        "rows_updated",
        deleted.alias("rows_deleted"),
        "status",
        F.when(F.col("status") == "F", bad).alias("error_msg"),
    )
