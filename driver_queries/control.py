"""Control table queries over one delivery folder per event type and day."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import as_text, portable, query
from driver_queries.views import FILES
from tidemark.functions.columns import last_segment, path_segment
from tidemark.operators import control as c
from tidemark.sources.snapshot import SnapshotTable

NOW = "2024-02-14 00:00:00"

# Registered files: those of the first 20 days; the first 15 days are loaded.
KNOWN = f"""
SELECT file_load_id, table_name, gw_fingerprint, gw_timestamp,
       concat(table_name, '/', gw_fingerprint, '/', gw_timestamp) AS cloud_path,
       d < 15 AS is_loaded,
       CAST(concat('2024-01-', lpad(CAST(d AS STRING), 2, '0'), ' 00:00:00') AS TIMESTAMP) AS insert_date_time,
       CAST('2024-01-31 00:00:00' AS TIMESTAMP) AS update_date_time, xcenter
FROM ({FILES}) f WHERE d <= 20"""
LISTED = f"""
SELECT table_name, gw_fingerprint, gw_timestamp,
       concat(table_name, '/', gw_fingerprint, '/', gw_timestamp) AS cloud_path, xcenter
FROM ({FILES}) f"""
METADATA = f"""
SELECT CAST(MIN(file_load_id) AS INT) AS table_id, UPPER(table_name) AS table_name,
       MAX(CASE WHEN table_name <> 'view' OR d <= 20 THEN gw_timestamp END) AS latest_lastsuccessfulwritetimestamp,
       MAX(CASE WHEN d <= 18 THEN gw_timestamp END) AS previous_lastsuccessfulwritetimestamp,
       MAX(gw_fingerprint) AS latest_fingerprint, MAX(gw_fingerprint) AS previous_fingerprint,
       CASE WHEN table_name = 'error' THEN 'C' ELSE 'I' END AS load_status,
       CAST('2024-01-31 00:00:00' AS TIMESTAMP) AS update_date_time,
       xcenter, 1 AS cyc_run_sk
FROM ({FILES}) f GROUP BY table_name, xcenter"""
JOBS = f"""
SELECT CAST(100 + ROW_NUMBER() OVER (ORDER BY table_name) AS INT) AS job_sk, table_name AS tgt_file_tbl,
       table_name AS src_file_tbl, 'RPL' AS job_typ_cd, 10 AS step_sk, 'C' AS job_sts_cd,
       CASE WHEN table_name = 'signup' THEN 'N' ELSE 'Y' END AS acti_ind, 'Y' AS cur_cyc_valid,
       CAST('2024-01-31 00:00:00' AS TIMESTAMP) AS aud_dt_tm, 'job' AS job_nm, 'a job' AS job_desc,
       'rpl' AS src_path_schem, 'rfn' AS tgt_path_schem
FROM (SELECT table_name FROM ({FILES}) f WHERE table_name <> 'click' GROUP BY table_name) t"""


def ctes(*names: str) -> str:
    texts = {"known": KNOWN, "listed": LISTED, "metadata": METADATA, "jobs": JOBS, "files": FILES}
    return ", ".join(f"{x} AS ({portable(texts[x])})" for x in names)


LISTED_COLUMNS = "l.table_name, l.gw_fingerprint, l.gw_timestamp, l.cloud_path, l.xcenter"
NEWS = """news AS (
  SELECT m.* FROM metadata m LEFT JOIN (SELECT UPPER(table_name) AS t,
    max(CAST(gw_timestamp AS BIGINT)) AS k FROM known GROUP BY 1) x ON m.table_name = x.t
  WHERE CAST(latest_lastsuccessfulwritetimestamp AS BIGINT) > coalesce(k, 0))"""


def history(t):
    """(table, fingerprint) pairs a manifest would name."""
    return t.sql(
        f"SELECT UPPER(table_name) AS table_name, gw_fingerprint AS fingerprint, "
        f"MIN(gw_timestamp) AS first_seen_ts FROM ({FILES}) f GROUP BY table_name, gw_fingerprint"
    )


@query("detect_full", f"WITH {ctes('listed')} SELECT {LISTED_COLUMNS} FROM listed l")
def q_detect_full(t):
    nothing = t.sql(KNOWN).filter("xcenter = 'none'")
    return c.detect_new(t.sql(LISTED), t.sql(METADATA), nothing, history(t))


@query(
    "detect_incremental",
    f"""WITH {ctes('listed', 'known', 'metadata')}, {NEWS}
SELECT {LISTED_COLUMNS} FROM listed l JOIN news m ON UPPER(l.table_name) = m.table_name
WHERE CAST(l.gw_timestamp AS BIGINT) > CAST(m.previous_lastsuccessfulwritetimestamp AS BIGINT)""",
)
def q_detect(t):
    return c.detect_new(t.sql(LISTED), t.sql(METADATA), t.sql(KNOWN), history(t))


@query(
    "tables_with_news",
    f"""WITH {ctes('known', 'metadata')}, {NEWS}
SELECT table_name, latest_lastsuccessfulwritetimestamp FROM news""",
)
def q_news(t):
    out = c.tables_with_news(t.sql(METADATA), t.sql(KNOWN))
    return out.select("table_name", "latest_lastsuccessfulwritetimestamp")


@query(
    "load_type",
    f"WITH {ctes('known')} SELECT CASE WHEN count(*) = 0 THEN 'FULL' ELSE 'INCREMENTAL' END AS load_type FROM known",
)
def q_load_type(t):
    return c.load_type(t.sql(KNOWN))


@query(
    "new_files_anti",
    f"""WITH {ctes('listed', 'known', 'metadata')}
SELECT {LISTED_COLUMNS}, 2 AS cyc_run_sk FROM listed l
JOIN metadata m ON UPPER(l.table_name) = m.table_name AND l.xcenter = m.xcenter AND m.load_status = 'I'
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.table_name = l.table_name
  AND k.gw_timestamp = l.gw_timestamp AND k.xcenter = l.xcenter
  AND k.gw_fingerprint = l.gw_fingerprint)""",
)
def q_new_files(t):
    return c.new_files(t.sql(LISTED), t.sql(METADATA), t.sql(KNOWN), 2)


@query(
    "pending_files",
    f"""WITH {ctes('known')} SELECT table_name, gw_fingerprint, gw_timestamp, cloud_path FROM known
WHERE UPPER(table_name) = 'CLICK' AND NOT is_loaded AND xcenter = 'CC'
  AND CAST(gw_timestamp AS BIGINT) BETWEEN 1704067200000 AND 1705708800000""",
)
def q_pending_files(t):
    out = c.pending_files(t.sql(KNOWN), "click", "CC", 1704067200000, 1705708800000)
    return out.select("table_name", "gw_fingerprint", "gw_timestamp", "cloud_path")


@query(
    "pending_window",
    f"""WITH {ctes('known', 'jobs')}
SELECT lower(j.tgt_file_tbl) AS table_name, min(CAST(gw_timestamp AS BIGINT)) AS start_timestamp,
       max(CAST(gw_timestamp AS BIGINT)) AS end_timestamp, j.step_sk, j.job_sk, 'CC' AS xcenter
FROM jobs j JOIN known k ON lower(k.table_name) = lower(j.tgt_file_tbl) AND NOT k.is_loaded
WHERE j.step_sk = 10 AND j.cur_cyc_valid = 'Y' AND j.job_sts_cd = 'C' AND j.acti_ind = 'Y'
GROUP BY j.step_sk, j.job_sk, lower(j.tgt_file_tbl)""",
)
def q_pending(t):
    return c.pending_window(t.sql(JOBS), t.sql(KNOWN), 10, "CC")


@query(
    "ready_replica",
    f"""WITH {ctes('metadata', 'jobs')}
SELECT lower(j.tgt_file_tbl) AS tgt_file_tbl, j.job_sk, j.step_sk, 2 AS cyc_run_sk, 'CC' AS xcenter
FROM jobs j JOIN metadata m ON m.table_name = UPPER(j.tgt_file_tbl) AND m.load_status = 'C'
WHERE j.step_sk = 10 AND j.acti_ind = 'Y'""",
)
def q_ready_replica(t):
    return c.ready_for_replica(t.sql(JOBS), t.sql(METADATA), 10, "CC", 2)


@query(
    "ready_refined",
    f"""WITH {ctes('jobs')} SELECT tgt_file_tbl, tgt_path_schem, src_file_tbl, job_sk, 11 AS step_sk,
       src_path_schem, 'CC' AS xcenter FROM jobs WHERE acti_ind = 'Y'""",
)
def q_ready_refined(t):
    jobs = t.sql(JOBS).withColumns({"job_typ_cd": F.lit("RFN"), "step_sk": F.lit(11)})
    return c.ready_for_refined(jobs, 11, "CC")


MANIFEST = f"""
SELECT concat('CC/', table_name) AS datafilespath,
       MAX(gw_timestamp) AS lastsuccessfulwritetimestamp,
       MIN(gw_timestamp) AS first_seen, MAX(gw_fingerprint) AS fp, CAST(SUM(n_rows) AS STRING) AS n,
       xcenter
FROM ({FILES}) f GROUP BY table_name, xcenter"""


def manifest(t):
    return t.sql(MANIFEST).select(
        "datafilespath",
        "lastsuccessfulwritetimestamp",
        F.create_map(
            F.col("fp"), F.col("first_seen"),
            F.concat(F.lit("new-"), F.col("fp")), F.col("lastsuccessfulwritetimestamp"),
        ).alias("schemahistory"),
        "xcenter",
    )


@query(
    "schema_history",
    f"""WITH m AS ({portable(MANIFEST)})
SELECT UPPER(substr(datafilespath, 4)) AS table_name, fp AS fingerprint, first_seen AS first_seen_ts FROM m
UNION ALL
SELECT UPPER(substr(datafilespath, 4)), concat('new-', fp), lastsuccessfulwritetimestamp FROM m""",
)
def q_history(t):
    return c.schema_history(manifest(t))


@query(
    "fingerprint_text",
    f"""WITH m AS ({portable(MANIFEST)}) SELECT datafilespath, fp AS fingerprint FROM m""",
)
def q_fingerprint_text(t):
    text = F.concat(F.lit("{'"), F.col("fp"), F.lit("': "), F.col("first_seen"), F.lit("}"))
    return t.sql(MANIFEST).withColumn("history", text).select(
        "datafilespath", c.fingerprint_in_text("history").alias("fingerprint")
    )


@query(
    "shift_metadata",
    f"""WITH {ctes('metadata')}, m AS ({portable(MANIFEST)}),
x AS (SELECT t.*, m.lastsuccessfulwritetimestamp AS ts, m.fp,
             t.latest_lastsuccessfulwritetimestamp <> m.lastsuccessfulwritetimestamp AS hit
      FROM metadata t LEFT JOIN m ON t.table_name = UPPER(substr(m.datafilespath, 4)))
SELECT table_name,
       CASE WHEN hit THEN ts ELSE latest_lastsuccessfulwritetimestamp END AS latest_lastsuccessfulwritetimestamp,
       CASE WHEN hit THEN latest_lastsuccessfulwritetimestamp
            ELSE previous_lastsuccessfulwritetimestamp END AS previous_lastsuccessfulwritetimestamp,
       CASE WHEN hit THEN concat('new-', fp) ELSE latest_fingerprint END AS latest_fingerprint,
       CASE WHEN hit THEN 'I' ELSE load_status END AS load_status,
       CASE WHEN hit THEN 2 ELSE cyc_run_sk END AS cyc_run_sk FROM x""",
)
def q_shift(t):
    out = c.shift_load_metadata(t.sql(METADATA), manifest(t), 2, NOW, "CC")
    return out.select(
        "table_name", "latest_lastsuccessfulwritetimestamp", "previous_lastsuccessfulwritetimestamp",
        "latest_fingerprint", "load_status", "cyc_run_sk",
    )


@query(
    "shift_metadata_compat",
    f"""WITH {ctes('metadata')}, m AS ({portable(MANIFEST)})
SELECT t.table_name, m.lastsuccessfulwritetimestamp AS latest_lastsuccessfulwritetimestamp,
       t.latest_lastsuccessfulwritetimestamp AS previous_lastsuccessfulwritetimestamp,
       m.fp AS latest_fingerprint, 'I' AS load_status, 2 AS cyc_run_sk
FROM metadata t JOIN m ON t.table_name = UPPER(substr(m.datafilespath, 4))""",
)
def q_shift_compat(t):
    out = c.shift_load_metadata(t.sql(METADATA), manifest(t), 2, NOW, "CC", compat=True)
    return out.select(
        "table_name", "latest_lastsuccessfulwritetimestamp", "previous_lastsuccessfulwritetimestamp",
        "latest_fingerprint", "load_status", "cyc_run_sk",
    )


@query(
    "mark_loaded",
    f"""WITH {ctes('known')}
SELECT file_load_id, table_name, gw_timestamp,
       CAST(is_loaded OR (table_name = 'click' AND CAST(gw_timestamp AS BIGINT) <= 1705536000000) AS INT) AS loaded,
       CASE WHEN NOT is_loaded AND table_name = 'click' AND CAST(gw_timestamp AS BIGINT) <= 1705536000000
            THEN '{NOW}' ELSE '2024-01-31 00:00:00' END AS update_date_time FROM known""",
)
def q_mark_loaded(t):
    out = c.mark_loaded(t.sql(KNOWN), "CLICK", "CC", 1705536000000, NOW)
    return as_text(
        out.select(
            "file_load_id", "table_name", "gw_timestamp",
            F.col("is_loaded").cast("int").alias("loaded"), "update_date_time",
        ),
        "update_date_time",
    )


@query(
    "mark_complete",
    f"""WITH {ctes('metadata')} SELECT table_name,
       CASE WHEN table_name = 'CLICK' THEN 'C' ELSE load_status END AS load_status FROM metadata""",
)
def q_mark_complete(t):
    return c.mark_complete(t.sql(METADATA), "click", "CC", NOW).select("table_name", "load_status")


@query(
    "sync_jobs",
    f"""WITH {ctes('metadata', 'jobs')},
added AS (SELECT 105 AS base, m.* FROM metadata m WHERE lower(table_name) NOT IN (SELECT tgt_file_tbl FROM jobs)),
alljobs AS (
  SELECT job_sk, tgt_file_tbl, acti_ind, job_nm FROM jobs
  UNION ALL
  SELECT CAST((SELECT max(job_sk) FROM jobs) + row_number() OVER (ORDER BY table_id) AS INT),
         lower(table_name), 'Y', 'raw_replica_CC' FROM added)
SELECT job_sk, tgt_file_tbl, acti_ind, job_nm, 'C' AS job_sts_cd,
       CASE WHEN m.load_status = 'I' THEN 'Y' ELSE 'N' END AS cur_cyc_valid
FROM alljobs j JOIN metadata m ON lower(m.table_name) = j.tgt_file_tbl""",
)
def q_sync_jobs(t):
    out = c.sync_job_list(t.sql(JOBS), t.sql(METADATA), 10, "RPL", "raw_replica", "CC", NOW)
    return out.select("job_sk", "tgt_file_tbl", "acti_ind", "job_nm", "job_sts_cd", "cur_cyc_valid")


# ------------------------------------------------------------------------- housekeeping


@query(
    "archive_replace",
    """SELECT 'archive' AS part, o_orderkey AS id, o_orderpriority AS xcenter FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT 'current', o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '1-URGENT'
UNION ALL SELECT 'current', c_custkey, '1-URGENT' FROM customer""",
)
def q_archive_replace(t):
    rows = t.sql("SELECT o_orderkey AS id, o_orderpriority AS xcenter FROM {orders}")
    new = t.sql("SELECT c_custkey AS id, '1-URGENT' AS xcenter FROM {customer}")
    current, archive = c.archive_then_replace(
        rows, rows.filter("xcenter = 'none'"), new, "1-URGENT"
    )
    return current.withColumn("part", F.lit("current")).unionByName(
        archive.withColumn("part", F.lit("archive"))
    )


@query(
    "archive_older_than",
    f"""WITH {ctes('known')}
SELECT CASE WHEN is_loaded AND insert_date_time < TIMESTAMP '{NOW}' - INTERVAL 30 DAY
            THEN 'archive' ELSE 'kept' END AS part, file_load_id, table_name, gw_timestamp FROM known""",
)
def q_archive_older(t):
    known = t.sql(KNOWN)
    kept, archive = c.archive_older_than(known, known.filter("xcenter = 'none'"), NOW, "CC")
    both = kept.withColumn("part", F.lit("kept")).unionByName(
        archive.withColumn("part", F.lit("archive"))
    )
    return both.select("part", "file_load_id", "table_name", "gw_timestamp")


@query(
    "snapshot_copy",
    "SELECT o_orderkey AS id, o_orderpriority AS xcenter FROM orders WHERE o_orderpriority = '5-LOW'",
)
def q_snapshot(t):
    """The copy of one centre's rows holds what the table held, whatever becomes of the table."""
    store, backup = SnapshotTable(t.spark, t.scratch("table")), SnapshotTable(t.spark, t.scratch("backup"))
    store.write(t.sql("SELECT o_orderkey AS id, o_orderpriority AS xcenter FROM {orders}"))
    backup.write(c.snapshot_copy(store.read(), "5-LOW"))
    store.write(store.read().limit(0))
    return backup.read()


# -------------------------------------------------------------------------- run history

STEP_RUNS = """
SELECT o_orderkey AS step_run_sk, o_custkey AS cyc_run_sk,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 20 ELSE 10 END AS step_sk,
       CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'F' THEN 'F' ELSE 'S' END AS step_sts_cd
FROM {orders}"""
CYCLE_RUNS = """
SELECT c_custkey AS cyc_run_sk,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'F' ELSE 'I' END AS cyc_sts_cd
FROM {customer}"""


@query(
    "latest_step_run",
    f"""SELECT cyc_run_sk, step_sk, step_sts_cd, step_run_sk FROM (
  SELECT *, row_number() OVER (PARTITION BY cyc_run_sk, step_sk ORDER BY step_run_sk DESC) AS rn
  FROM ({portable(STEP_RUNS)}) s) x WHERE rn = 1""",
)
def q_latest_step(t):
    return c.latest_step_runs(t.sql(STEP_RUNS))


@query(
    "restart_flags",
    f"""WITH s AS (SELECT cyc_run_sk, arg_max(step_sts_cd, step_run_sk) AS st
  FROM ({portable(STEP_RUNS)}) s WHERE step_sk = 10 GROUP BY 1)
SELECT c.cyc_run_sk,
       CASE WHEN st = 'I' AND cyc_sts_cd = 'I' THEN 'Y' WHEN st IN ('F', 'S') AND cyc_sts_cd = 'F' THEN 'N'
            ELSE 'Y' END AS truncate,
       CASE WHEN st = 'F' THEN 'Y' ELSE 'N' END AS force_truncate
FROM ({portable(CYCLE_RUNS)}) c LEFT JOIN s ON c.cyc_run_sk = s.cyc_run_sk""",
)
def q_restart(t):
    return c.restart_flags(t.sql(CYCLE_RUNS), t.sql(STEP_RUNS), 10)


@query(
    "cycle_status",
    f"""SELECT cyc_run_sk, CASE WHEN count(*) FILTER (WHERE step_sts_cd = 'F') > 0 THEN 'F' ELSE 'S' END AS cyc_sts_cd
FROM ({portable(STEP_RUNS)}) s GROUP BY 1""",
)
def q_cycle_status(t):
    return c.cycle_status(t.sql(STEP_RUNS), ["cyc_run_sk"])


@query(
    "previous_good_run",
    f"""SELECT coalesce(max(cyc_run_sk), 0) AS prev_cyc_run_sk FROM ({portable(STEP_RUNS)}) s
WHERE step_sk = 10 AND step_sts_cd = 'S'""",
)
def q_previous(t):
    return c.previous_good_run(t.sql(STEP_RUNS), 10)


@query(
    "job_metrics",
    """SELECT 5 AS job_sk, 'orders' AS table_name, count(*) AS rows_read,
       count(*) FILTER (WHERE o_orderstatus <> 'P') AS rows_loaded,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS rows_inserted,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted,
       CASE WHEN count(*) = count(*) FILTER (WHERE o_orderstatus <> 'P') THEN 'S' ELSE 'F' END AS status,
       concat('rows read ', CAST(count(*) AS VARCHAR), ' do not match rows loaded ',
              CAST(count(*) FILTER (WHERE o_orderstatus <> 'P') AS VARCHAR), ' for table orders') AS error_msg
FROM orders""",
)
def q_job_metrics(t):
    status = F.col("o_orderstatus")
    counts = t.table("orders").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(status != "P").alias("rows_loaded"),
        F.count_if(status == "O").alias("rows_inserted"),
        F.count_if(status == "F").alias("rows_updated"),
    )
    verdict = F.when(F.col("rows_read") == F.col("rows_loaded"), "S").otherwise("F")
    return c.job_metrics(counts.withColumn("status", verdict), 5, "orders")


# -------------------------------------------------------------------------------- paths


@query(
    "path_columns",
    """SELECT page_id, upper(split_part(url, '/', -1)) AS last_part,
       regexp_replace(split_part(url, '/', -2), '^[^=]*=', '') AS second FROM pages""",
)
def q_paths(t):
    url = F.col("url")
    return t.table("pages").select(
        "page_id", last_segment(url).alias("last_part"), path_segment(url, 2).alias("second")
    )
