"""Queries that run whole jobs over tables derived from the given ones."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver_queries.cdc import (
    CDC_CTE,
    FINGERPRINTS,
    INITIAL_CTE,
    RUN_TS,
    STATE,
    STATE_COLUMNS,
    _apply_cte,
    _batch_cte,
)
from driver_queries.registry import Tables, portable, query
from driver_queries.views import CDC, CLAIM, FILES, POLICY
from tidemark import names as n
from tidemark.functions.schema import align_target_to_source
from tidemark.operators.quality import Rule
from tidemark.plans.balancing import refresh_or_keep
from tidemark.plans.housekeeping import housekeeping
from tidemark.plans.ingest import ingest
from tidemark.plans.insurance import claim_detail_delta
from tidemark.plans.jobspec import JobSpec
from tidemark.plans.parallel import for_each
from tidemark.plans.refine import refine, refine_job
from tidemark.plans.replicate import replicate
from tidemark.plans.validate import validate_table
from tidemark.plans.warehouse import Warehouse
from tidemark.session import Staging, hadoop_path
from tidemark.sources import deliveries
from tidemark.sources.snapshot import SnapshotTable
from tidemark.streaming.replicate import replicate_stream

TABLE = "cc_user"


def _land(t: Tables, wh: Warehouse, phase: int) -> None:
    """The deliveries of a phase as raw folders, registered as landed in the run of that number."""
    rows = t.sql(CDC).filter(F.col("phase") == phase).drop("phase")
    landing = t.scratch("landing")
    rows.write.partitionBy(n.FINGERPRINT, n.DELIVERY).parquet(f"{landing}/{TABLE}")
    listed = deliveries.list_deliveries(t.spark, landing, "CC")
    pairs = [(r["gw_fingerprint"], r["gw_timestamp"]) for r in listed.collect()]
    folders = [deliveries.folder(landing, TABLE, *p, raw=True) for p in pairs]
    zone = deliveries.read_folders(t.spark, folders)
    zone.write.mode("append").partitionBy(n.FINGERPRINT, n.DELIVERY).parquet(f"{wh.raw}/{TABLE}")
    wh.control("raw_table_load").append(listed.withColumn("cyc_run_sk", F.lit(phase)))


def _manifest(t: Tables, root: str, rows) -> None:
    """The manifest of a landing zone that holds ``rows``."""
    ts = F.col(n.DELIVERY).cast("bigint")
    history = {r[0]: str(r[1]) for r in rows.groupBy(n.FINGERPRINT).agg(F.min(ts)).collect()}
    last, count = rows.agg(F.max(ts), F.count(F.lit(1))).first()
    entry = {
        "dataFilespath": f"CC/{TABLE.upper()}", "lastSuccessfulWriteTimestamp": str(last),
        "schemaHistory": history, "totalProcessedRecordsCount": str(count),
    }
    fs, path = hadoop_path(t.spark, f"{root}/manifest.json")
    out = fs.create(path, True)
    out.write(bytearray(json.dumps({TABLE.upper(): entry}).encode()))
    out.close()


@query(
    "ingest_two_runs",
    f"""WITH {CDC_CTE}
SELECT GW_FINGERPRINT AS gw_fingerprint, GW_TIMESTAMP AS gw_timestamp, true AS is_loaded,
       CAST(CASE WHEN phase = 1 THEN 1 ELSE 2 END AS INTEGER) AS run, count(*) AS n_rows
FROM cdc GROUP BY ALL""",
)
def q_ingest(t):
    """The ingest job twice: manifest, detection, registration and landing, all folders first and then
    only those that are new. Returns the file table with the rows that the raw zone holds."""
    wh, root = Warehouse(t.spark, t.scratch("warehouse")), t.scratch("landing")
    rows = t.sql(CDC)
    for run, phases in ((1, (1,)), (2, (2, 3))):
        new = t.stored(rows.filter(F.col("phase").isin(*phases)).drop("phase"), "new")
        pairs = [tuple(r) for r in new.select(n.FINGERPRINT, n.DELIVERY).distinct().collect()]

        def deliver(pair, new=new):
            mine = new.filter((F.col(n.FINGERPRINT) == pair[0]) & (F.col(n.DELIVERY) == pair[1]))
            deliveries.write_delivery(mine.drop(n.FINGERPRINT, n.DELIVERY), root, TABLE, *pair)

        for_each(t.spark, deliver, pairs)
        _manifest(t, root, rows.filter(F.col("phase") <= max(phases)))
        assert ingest(wh, root, "CC", run, RUN_TS) == [TABLE]
    assert ingest(wh, root, "CC", 3, RUN_TS) == []  # no news
    raw = deliveries.folder_rows(deliveries.read_zone(t.spark, wh.raw, TABLE))
    files = wh.control("file_loads").read()
    return files.join(raw, ["gw_fingerprint", "gw_timestamp"], "left").select(
        "gw_fingerprint", "gw_timestamp", "is_loaded", F.col("cyc_run_sk").alias("run"), F.col("rows").alias("n_rows")
    )


def _caught_up() -> str:
    """Runs 2 and 3 in one: a batch for each schema version of both."""
    parts, target = [CDC_CTE, INITIAL_CTE], "t0"
    for fingerprint in FINGERPRINTS:
        name, out = f"b{fingerprint[0]}", f"t{fingerprint[0]}"
        parts.append(_batch_cte(name, fingerprint, 2, 3))
        parts.append(_apply_cte(out, target, name, 3))
        target = out
    return "WITH " + ",".join(parts) + f" SELECT {STATE} FROM {target}"


@query("replicate_two_runs", _caught_up())
def q_replicate(t):
    """Run 2 lands its deliveries but does not replicate; run 3 takes up both."""
    wh = Warehouse(t.spark, t.scratch("warehouse"))
    _land(t, wh, 1)
    replicate(wh, TABLE, 1, RUN_TS, "CC")
    _land(t, wh, 2)
    _land(t, wh, 3)
    replicate(wh, TABLE, 3, RUN_TS, "CC")
    return wh.replica(TABLE).read().select(*STATE_COLUMNS)


def _run_by_run() -> str:
    """Runs 2 and 3 one after the other."""
    parts, target = [CDC_CTE, INITIAL_CTE], "t0"
    for run in (2, 3):
        for fingerprint in FINGERPRINTS:
            name, out = f"b{run}{fingerprint[0]}", f"t{run}{fingerprint[0]}"
            parts.append(_batch_cte(name, fingerprint, run, run))
            parts.append(_apply_cte(out, target, name, run))
            target = out
    return "WITH " + ",".join(parts) + f" SELECT {STATE} FROM {target}"


@query("replicate_stream", _run_by_run())
def q_replicate_stream(t):
    """Three triggers of a stream, one per run. The checkpoint loses the end of the second, as when a
    job dies between the table's commit and the stream's, so the third gives its deliveries out again."""
    wh = Warehouse(t.spark, t.scratch("warehouse"))
    applied = []
    for run in (1, 2, 3):
        _land(t, wh, run)
        applied.append(replicate_stream(wh, TABLE, lambda batch: batch + 1, RUN_TS, "CC"))
        if run == 2:
            fs, commit = hadoop_path(t.spark, f"{wh.root}/streams/{TABLE}/commits/1")
            assert fs.delete(commit, False)
    assert applied == [[0], [1], [2]]
    return wh.replica(TABLE).read().select(*STATE_COLUMNS)


RULES = (
    Rule(1, "SELECT publicid FROM job_claim WHERE losstype = '1-URGENT' AND state = 'Closed'",
         "job_claim", "publicid", "urgent claims stay open"),
    Rule(2, "SELECT c.publicid FROM job_claim c JOIN job_policy p ON p.id = c.policyid "
         "WHERE p.policytype = 'BUILDING'", "job_claim", "publicid", "no claim on buildings"),
    Rule(3, "SELECT publicid FROM job_claim WHERE reserve < 0", "job_claim", "publicid", "reserves"),
)


def _rule_sql(number: int, rule: Rule) -> str:
    keys = rule.query.replace("job_claim", "claim").replace("job_policy", "policy")
    return f"""
SELECT {40 + number} AS val_run_sk, {rule.val_sk} AS val_sk, '{rule.val_rule}' AS val_rule,
       CASE WHEN f = 0 THEN 'S' ELSE 'F' END AS val_status,
       m AS total_count, m - f AS passed_count, f AS failed_count
FROM (SELECT count(*) AS m, count(*) FILTER (WHERE publicid IN ({keys})) AS f
      FROM claim WHERE CYC_RUN_SK = 2) x"""


@query(
    "validate_rules",
    f"WITH claim AS ({portable(CLAIM)}), policy AS ({portable(POLICY)})"
    + " UNION ALL ".join(_rule_sql(i, r) for i, r in enumerate(RULES)),
)
def q_validate(t):
    """Three rules of one table, one of which joins another replica."""
    wh = Warehouse(t.spark, t.scratch("warehouse"))
    wh.replica("job_claim").write(t.sql(CLAIM))
    wh.replica("job_policy").write(t.sql(POLICY))
    wh.publish_replicas(["job_claim", "job_policy"])
    summary = validate_table(wh, "job_claim", RULES, "CC", 10120, 2, RUN_TS, first_val_run=40)
    return summary.select(
        "val_run_sk", "val_sk", "val_rule", "val_status", "total_count", "passed_count", "failed_count"
    )


DETAIL = JobSpec(1, "job_detail", ("id",), "detail_sk", "job_driving", ("id",), "")
FIRST = """
SELECT o_orderkey AS id, o_orderstatus AS version, o_custkey AS policyid, '1000' AS GW_TIMESTAMP
FROM {orders}"""
SECOND = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS version,
       o_custkey AS policyid, '2000' AS GW_TIMESTAMP
FROM {orders} WHERE o_orderpriority <> '3-MEDIUM'
UNION ALL
SELECT o_orderkey + 1000000000, o_orderstatus, o_custkey, '2000'
FROM {orders} WHERE o_orderpriority = '1-URGENT'"""
DRIVING = """
SELECT o_orderkey AS id, 2 AS CYC_RUN_SK,
       CASE WHEN o_orderkey % 11 = 0 THEN 'Y' ELSE 'N' END AS Soft_Delete,
       CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS retired
FROM {orders}"""


@query(
    "refine_two_runs",
    f"""WITH a AS ({portable(FIRST)}), b AS ({portable(SECOND)}), d AS ({portable(DRIVING)}),
gone AS (SELECT id FROM d WHERE Soft_Delete = 'Y' OR retired <> 0),
changed AS (SELECT a.id FROM a JOIN b ON a.id = b.id WHERE a.version <> b.version)
SELECT id, version, policyid,
       CASE WHEN id IN (SELECT id FROM changed) OR id IN (SELECT id FROM gone) THEN 'N' ELSE 'Y' END AS flag,
       CASE WHEN id IN (SELECT id FROM changed) OR id IN (SELECT id FROM gone) THEN '2' ELSE '1' END AS last_run,
       '1' AS ins_run FROM a
UNION ALL
SELECT id, version, policyid, CASE WHEN id IN (SELECT id FROM gone) THEN 'N' ELSE 'Y' END, '2', '2'
FROM b WHERE id IN (SELECT id FROM changed) OR id NOT IN (SELECT id FROM a)""",
)
def q_refine(t):
    """The refine job twice, with changes, new keys, deletes and retirements, and a business
    column called version."""
    wh = Warehouse(t.spark, t.scratch("warehouse"))
    wh.replica("job_driving").write(t.sql(DRIVING).limit(0))
    refine(wh, DETAIL, t.sql(FIRST), 1, "2024-01-01 00:00:00")
    wh.replica("job_driving").write(t.sql(DRIVING))
    refine(wh, DETAIL, t.sql(SECOND), 2, "2024-02-01 00:00:00", previous_run=1)
    state = wh.refined("job_detail").read()
    return state.select(
        "id", "version", "policyid", F.col(n.ACTIVE).alias("flag"), F.col(n.LAST_RUN).alias("last_run"),
        F.col(n.INSERT_RUN).alias("ins_run"),
    )


# Claims and policies as three runs leave them: claims appear, change and go, policies appear, change
# and are deleted (a deleted policy still joins, with its new status).
DELTA_POLICY = """
SELECT c_custkey AS id, c_name AS policynumber,
       CASE WHEN {run} >= 2 AND c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS policytype,
       CASE WHEN {run} >= 3 AND c_custkey % 11 = 0 THEN 'gone' ELSE 'live' END AS status,
       CASE WHEN {run} >= 3 AND c_custkey % 11 = 0 THEN 'Y' ELSE 'N' END AS Soft_Delete,
       CASE WHEN {run} >= 3 AND c_custkey % 11 = 0 THEN 3
            WHEN {run} >= 2 AND (c_custkey % 7 = 0 OR c_custkey % 13 = 0) THEN 2 ELSE 1 END AS CYC_RUN_SK,
       CAST({run} AS STRING) AS GW_TIMESTAMP
FROM {{customer}} WHERE {run} >= 2 OR c_custkey % 13 <> 0"""
DELTA_CLAIM = """
SELECT o_orderkey AS id, o_custkey AS policyid,
       CASE WHEN {run} >= 2 AND o_orderkey % 9 = 0 THEN 'X' ELSE o_orderstatus END AS state,
       CASE WHEN {run} >= 3 AND o_orderkey % 17 = 0 THEN 'Y' ELSE 'N' END AS Soft_Delete,
       CASE WHEN {run} >= 3 AND o_orderkey % 17 = 0 THEN 3
            WHEN {run} >= 2 AND (o_orderkey % 9 = 0 OR o_orderkey % 5 = 0) THEN 2 ELSE 1 END AS CYC_RUN_SK,
       '1000' AS GW_TIMESTAMP
FROM {{orders}} WHERE {run} >= 2 OR o_orderkey % 5 <> 0"""
DELTA_JOB = JobSpec(
    1, "delta_detail", ("id",), "detail_sk", "delta_claim", ("id",),
    "SELECT c.id, c.policyid, c.state, p.policytype, p.status, c.GW_TIMESTAMP "
    "FROM @catalog.@src_schema.delta_claim c LEFT JOIN @catalog.@src_schema.delta_policy p "
    "ON c.policyid = p.id WHERE c.Soft_Delete = 'N'",
    lookups=(("delta_policy", "policyid", "id"),),
)


def _joined(run: int) -> str:
    claims, policies = (portable(x.format(run=run)) for x in (DELTA_CLAIM, DELTA_POLICY))
    return f"""SELECT c.id, c.policyid, c.state, p.policytype, p.status, {run} AS r, c.Soft_Delete
FROM ({claims}) c LEFT JOIN ({policies}) p ON c.policyid = p.id"""


DELTA_VERSIONS = f"""WITH every AS ({" UNION ALL ".join(_joined(r) for r in (1, 2, 3))}),
gone AS (SELECT id FROM every WHERE Soft_Delete = 'Y'),
seen AS (SELECT *, lag(r) OVER w AS before,
    lag(state) OVER w IS DISTINCT FROM state OR lag(policytype) OVER w IS DISTINCT FROM policytype
    OR lag(status) OVER w IS DISTINCT FROM status AS changed
  FROM every WHERE Soft_Delete = 'N' WINDOW w AS (PARTITION BY id ORDER BY r)),
versions AS (SELECT *, lead(r) OVER (PARTITION BY id ORDER BY r) AS next FROM seen
  WHERE before IS NULL OR changed)"""


def _delta_runs(t: Tables):
    """Three runs of a job; the second and third take only the rows that changes can have touched."""
    wh, metrics = Warehouse(t.spark, t.scratch("warehouse")), []
    for run in (1, 2, 3):
        wh.replica("delta_claim").write(t.sql(DELTA_CLAIM.format(run=run)))
        wh.replica("delta_policy").write(t.sql(DELTA_POLICY.format(run=run)))
        wh.publish_replicas(["delta_claim", "delta_policy"])
        done = refine_job(wh, DELTA_JOB, run, f"2024-0{run}-01 00:00:00", previous_run=run - 1)
        metrics.append(done.withColumn("run", F.lit(run)))
    return wh, metrics


@query(
    "refine_delta",
    f"""{DELTA_VERSIONS}
SELECT id, policyid, state, policytype, status, CAST(r AS VARCHAR) AS ins_run,
       CASE WHEN next IS NULL AND id NOT IN (SELECT id FROM gone) THEN 'Y' ELSE 'N' END AS flag,
       CAST(coalesce(next, CASE WHEN id IN (SELECT id FROM gone) THEN 3 ELSE r END) AS VARCHAR) AS last_run
FROM versions""",
)
def q_refine_delta(t):
    wh, _ = _delta_runs(t)
    return wh.refined("delta_detail").read().select(
        "id", "policyid", "state", "policytype", "status", F.col(n.INSERT_RUN).alias("ins_run"),
        F.col(n.ACTIVE).alias("flag"), F.col(n.LAST_RUN).alias("last_run"),
    )


@query(
    "refine_metrics",
    f"""{DELTA_VERSIONS}
SELECT CAST(run AS INTEGER) AS run, i AS rows_read, i + u AS rows_loaded, i AS rows_inserted,
       u AS rows_updated, 'S' AS status
FROM (SELECT k.run, (SELECT count(*) FROM versions WHERE r = k.run) AS i,
             (SELECT count(*) FROM versions WHERE next = k.run) AS u
      FROM (SELECT unnest([1, 2, 3]) AS run) k) x""",
)
def q_refine_metrics(t):
    """Metrics of the three runs, counted while the history was written."""
    _, metrics = _delta_runs(t)
    rows = reduce(DataFrame.unionByName, metrics)
    return rows.select("run", "rows_read", "rows_loaded", "rows_inserted", "rows_updated", "status")


@query(
    "claim_detail_delta",
    f"""WITH claim AS ({portable(DELTA_CLAIM.format(run=3))}), policy AS ({portable(DELTA_POLICY.format(run=3))})
SELECT c.id, c.policyid, c.state AS lossstate, p.policynumber, p.policytype, p.status AS policy_status
FROM claim c LEFT JOIN policy p ON c.policyid = p.id
WHERE c.Soft_Delete = 'N' AND (c.CYC_RUN_SK > 1 OR c.policyid IN (SELECT id FROM policy WHERE CYC_RUN_SK > 1))""",
)
def q_claim_detail_delta(t):
    """Rows of the detail table that the changes of runs 2 and 3 touch, on either side of the join."""
    claims = t.stored(t.sql(DELTA_CLAIM.format(run=3)), "claims")
    policies = t.stored(t.sql(DELTA_POLICY.format(run=3)), "policies")
    rows = claim_detail_delta(claims, policies, 1, Staging(t.spark))
    return rows.select("id", "policyid", "lossstate", "policynumber", "policytype", "policy_status")


@query(
    "history_read",
    f"""WITH a AS ({portable(FIRST)}), b AS ({portable(SECOND)})
SELECT a.id, a.version, CASE WHEN a.version <> b.version THEN 'N' ELSE 'Y' END AS flag
FROM a LEFT JOIN b ON a.id = b.id
UNION ALL SELECT b.id, b.version, 'Y' FROM b LEFT JOIN a ON a.id = b.id
WHERE a.id IS NULL OR a.version <> b.version""",
)
def q_history(t):
    """A history table of two steps, gathered and read back."""
    wh = Warehouse(t.spark, t.scratch("warehouse"))
    wh.replica("job_driving").write(t.sql(DRIVING).limit(0))
    refine(wh, DETAIL, t.sql(FIRST), 1, "2024-01-01 00:00:00")
    refine(wh, DETAIL, t.sql(SECOND), 2, "2024-02-01 00:00:00", previous_run=1)
    store = wh.refined("job_detail")
    assert store.parts() == 2
    store.compact()
    assert store.parts() == 1
    return store.read().select("id", "version", F.col(n.ACTIVE).alias("flag"))


@query(
    "schema_replace_roundtrip",
    """SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS code FROM orders
UNION ALL SELECT -c_custkey, c_name FROM customer""",
)
def q_schema_replace(t):
    """A stored table takes the wider type of a new schema version and is read back with it."""
    store = SnapshotTable(t.spark, t.scratch("replace"))
    store.write(t.sql("SELECT o_orderkey AS id, o_custkey AS code FROM {orders}"))
    newest = t.sql("SELECT -c_custkey AS id, c_name AS code FROM {customer}")
    store.write(align_target_to_source(store.read(), newest, compat=False).unionByName(newest))
    return store.read()


@query(
    "refresh_or_keep",
    f"""WITH {CDC_CTE}, latest AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY GW_TIMESTAMP DESC,
         gwcbi___payload_ts_ms DESC, gwcbi___seqval_hex DESC) AS rn FROM cdc WHERE phase = 1)
SELECT cycle, id, status, amount FROM latest, (SELECT 'loaded' AS cycle UNION ALL SELECT 'idle') c
WHERE rn = 1""",
)
def q_refresh(t):
    """A cycle that loaded deliveries builds the balance source, an idle one keeps it."""
    wh = Warehouse(t.spark, t.scratch("warehouse"))
    _land(t, wh, 1)
    files = wh.control_rows("raw_table_load")
    loaded = refresh_or_keep(wh, TABLE, files, files)
    idle = refresh_or_keep(wh, TABLE, files, files.filter("cyc_run_sk = 2"))
    both = loaded.withColumn("cycle", F.lit("loaded")).unionByName(idle.withColumn("cycle", F.lit("idle")))
    return both.select("cycle", "id", "status", "amount")


OLD_FILES = f"""
SELECT CAST(file_load_id AS BIGINT) AS file_load_id, table_name, gw_fingerprint, gw_timestamp,
       table_name AS cloud_path, d < 28 AS is_loaded,
       CAST(CASE WHEN d < 10 THEN '2024-01-01 00:00:00' ELSE '2024-02-20 00:00:00' END AS TIMESTAMP)
         AS insert_date_time,
       CAST('2024-02-20 00:00:00' AS TIMESTAMP) AS update_date_time, xcenter, 1 AS cyc_run_sk
FROM ({FILES}) f"""


@query(
    "housekeeping",
    f"""WITH f AS ({portable(OLD_FILES)})
SELECT 'file_loads_backup' AS part, file_load_id FROM f
UNION ALL SELECT CASE WHEN is_loaded AND insert_date_time < TIMESTAMP '2024-01-26 00:00:00'
                      THEN 'file_loads_archive' ELSE 'file_loads' END, file_load_id FROM f""",
)
def q_housekeeping(t):
    """Backup of the file table, then its old rows go to the archive."""
    wh = Warehouse(t.spark, t.scratch("warehouse"))
    wh.control("file_loads").write(t.sql(OLD_FILES))
    housekeeping(wh, "CC", "2024-02-25 00:00:00")
    parts = [
        wh.control(name).read().select(F.lit(name).alias("part"), "file_load_id")
        for name in ("file_loads", "file_loads_archive", "file_loads_backup")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
