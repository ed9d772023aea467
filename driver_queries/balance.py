"""Balance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import portable, query
from driver_queries.refined import TXN_CTE
from driver_queries.views import CDC, CLAIM, FILES, TXN_FEED, TXN_ORDER
from tidemark import names as n
from tidemark.operators import balance as b
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.partials import merged_metrics
from tidemark.plans.balancing import CLAIM as CLAIM_TABLE, TRANSACTION as TRANSACTION_TABLE
from tidemark.plans.balancing import (
    balance_refined,
    balance_run_partial,
    balance_source,
    publish_metrics,
    refresh_partials,
)
from tidemark.plans.parallel import for_each
from tidemark.plans.warehouse import CONTROL, Warehouse
from tidemark.session import CODEC
from tidemark.sources import deliveries

RUN_TS = "2024-02-01 00:00:00"
MONEY = {
    "LossPayment": "'claimcost'",
    "ExpensePayment": "'aoexpense', 'dccexpense'",
    "LossReserve": "'claimcost'",
    "ExpenseReserve": "'aoexpense', 'dccexpense'",
}


def _layer(claims: str, txns: str, keep_claims: str, keep_money: str) -> str:
    rows = [
        f"SELECT 'ClaimCount' AS m, CAST(count(DISTINCT claimnumber) AS DECIMAL(38,2)) AS v "
        f"FROM {claims} WHERE {keep_claims}"
    ]
    for metric, costs in MONEY.items():
        rows.append(
            f"SELECT '{metric}', CAST(coalesce(sum(CAST(amount AS DECIMAL(28,6))), 0) AS DECIMAL(38,2)) "
            f"FROM {txns} WHERE costtype IN ({costs}) AND costcategory = '{metric}' AND {keep_money}"
        )
    return "\nUNION ALL ".join(rows)


def _compare(setup: str, left: str, right: str, process: str) -> str:
    return f"""WITH {setup}, l AS ({left}), r AS ({right})
SELECT 10 AS cyc_sk, 2 AS curr_cyc_run_sk, l.m AS metric_type, '{process}' AS process,
       CAST(l.v AS DOUBLE) AS source_value, CAST(r.v AS DOUBLE) AS target_value,
       CASE WHEN l.v = r.v THEN 'PASSED' ELSE 'FAILED' END AS status
FROM l JOIN r ON l.m = r.m"""


STATES = "state IN ('Open', 'Closed', 'Reopened')"
CLAIM_CTE = f"claim AS ({portable(CLAIM)})"
RAW_REPLICA = _compare(
    f"{CLAIM_CTE}, {TXN_CTE}",
    _layer("claim", "txn", f"{STATES} AND retired = 0 AND gwcbi___operation <> 1",
           "retired = 0 AND gwcbi___operation <> 1"),
    _layer("claim", "txn", f"CYC_RUN_SK = 2 AND {STATES} AND retired = 0 AND Soft_Delete = 'N'",
           "CYC_RUN_SK = 2 AND retired = 0 AND Soft_Delete = 'N'"),
    b.RAW_TO_REPLICA,
)
REFINED_CTE = """detail AS (SELECT id, claimnumber, CASE WHEN Soft_Delete = 'N' AND retired = 0
    THEN 'Y' ELSE 'N' END AS flag FROM claim),
fin AS (SELECT *, CASE WHEN Soft_Delete = 'N' AND retired = 0 AND partkey % 100 <> 0
    THEN 'Y' ELSE 'N' END AS flag FROM txn)"""
REPLICA_REFINED = _compare(
    f"{CLAIM_CTE}, {TXN_CTE}, {REFINED_CTE}",
    _layer("claim", "txn", "retired = 0 AND Soft_Delete = 'N'", "retired = 0 AND Soft_Delete = 'N'"),
    _layer("detail", "fin", "flag = 'Y'", "flag = 'Y'"),
    b.REPLICA_TO_REFINED,
)


def shown(metrics):
    return metrics.drop("aud_date_time").withColumns(
        {c: F.col(c).cast("double") for c in ("source_value", "target_value")}
    )


def replicas(t):
    return t.sql(CLAIM), t.stored(latest_per_key(t.sql(TXN_FEED), ["id"], TXN_ORDER, tie_break=()), "txn")


def raw_vs_replica(t):
    claims, txns = replicas(t)
    return b.balance_raw_vs_replica(claims, txns, claims, txns, 10, 2, RUN_TS)


def replica_vs_refined(t):
    claims, txns = replicas(t)
    live = (F.col(n.SOFT_DELETE) == "N") & (F.col("retired") == 0)
    detail = claims.withColumn(n.ACTIVE, F.when(live, "Y").otherwise("N"))
    dropped = F.col("partkey") % 100 != 0
    financial = txns.withColumn(n.ACTIVE, F.when(live & dropped, "Y").otherwise("N"))
    return b.balance_replica_vs_refined(claims, txns, detail, financial, 10, 2, RUN_TS)


@query("balance_raw_replica", RAW_REPLICA)
def q_raw_replica(t):
    return shown(raw_vs_replica(t))


@query("balance_replica_refined", REPLICA_REFINED)
def q_replica_refined(t):
    return shown(replica_vs_refined(t))


@query(
    "balance_verdict",
    f"""SELECT CASE WHEN bool_and(status = 'PASSED') THEN 'S' ELSE 'F' END AS balance_recon_status
FROM ({REPLICA_REFINED}) m""",
)
def q_verdict(t):
    return b.verdict(replica_vs_refined(t))


@query(
    "balance_source",
    f"""WITH cdc AS ({portable(CDC)}), f AS ({portable(FILES)}),
w AS (SELECT min(CAST(gw_timestamp AS BIGINT)) AS lo, max(CAST(gw_timestamp AS BIGINT)) AS hi
      FROM f WHERE table_name = 'click' AND d > 22)
SELECT id, status, amount, gwcbi___seqval_hex, GW_FINGERPRINT, GW_TIMESTAMP FROM (
  SELECT cdc.*, row_number() OVER (PARTITION BY id ORDER BY GW_TIMESTAMP DESC,
         gwcbi___payload_ts_ms DESC, gwcbi___seqval_hex DESC) AS rn
  FROM cdc, w WHERE CAST(GW_TIMESTAMP AS BIGINT) BETWEEN lo AND hi) x WHERE rn = 1""",
)
def q_balance_source(t):
    files = t.sql(FILES)
    folders = b.cycle_folders(files, files.filter("d > 22"), "CLICK").select("gw_timestamp").distinct()
    raw = t.sql(CDC)
    folders = folders.withColumnRenamed("gw_timestamp", "_ts")
    mine = raw.join(folders, F.col(n.DELIVERY) == F.col("_ts"), "left_semi")
    return balance_source(mine).select(
        "id", "status", "amount", n.SEQUENCE, n.FINGERPRINT, n.DELIVERY
    )


LAYERS = {
    "run": ("claim", "txn", f"CYC_RUN_SK = 2 AND {STATES} AND retired = 0 AND Soft_Delete = 'N'",
            "CYC_RUN_SK = 2 AND retired = 0 AND Soft_Delete = 'N'"),
    "all": ("claim", "txn", "retired = 0 AND Soft_Delete = 'N'", "retired = 0 AND Soft_Delete = 'N'"),
}


@query(
    "balance_partials",
    f"WITH {CLAIM_CTE}, {TXN_CTE} "
    + " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, m AS metric_type, CAST(v AS DOUBLE) AS value FROM ({_layer(*layer)}) {kind}_layer"
        for kind, layer in LAYERS.items()
    ),
)
def q_partials(t):
    """Partial aggregates of a first load, brought up to date after inserts, updates and deletes of a
    second run, and merged."""
    wh = Warehouse(t.spark, t.scratch("warehouse"))
    claims, txns = replicas(t)
    after = {CLAIM_TABLE: claims, TRANSACTION_TABLE: txns.drop("rn")}
    for table, rows in after.items():
        replica = wh.replica(table)
        first = rows.filter((F.col(n.RUN) == 1) | (F.col("retired") == 0))
        replica.write(first.withColumns({n.SOFT_DELETE: F.lit("N"), n.RUN: F.lit(1)}))
        refresh_partials(wh, table)
        replica.write_buckets(rows, range(replica.buckets))
        refresh_partials(wh, table)
    stored = [refresh_partials(wh, table) for table in after]  # nothing was rewritten: nothing is read
    shown = [
        merged_metrics(*stored, run).select(F.lit(kind).alias("kind"), "metric_type", F.col("value").cast("double").alias("value"))
        for kind, run in (("run", 2), ("all", None))
    ]
    return shown[0].unionByName(shown[1])


def _load(wh: Warehouse, table: str, rows) -> None:
    """A table as its raw folder, and from there as replica and as refined table."""
    folder = deliveries.folder(wh.raw, table, "f", "1000", raw=True)
    raw = rows.withColumns({n.PAYLOAD_TS: F.lit("1"), n.SEQUENCE: F.lit("1")})
    raw.write.option("compression", CODEC).parquet(folder)
    landed = wh.spark.read.schema(raw.schema).parquet(folder).drop(n.PAYLOAD_TS, n.SEQUENCE)
    wh.replica(table).write(landed)
    live = (F.col(n.SOFT_DELETE) == "N") & (F.col("retired") == 0)
    refined = landed.withColumn(n.ACTIVE, F.when(live, "Y").otherwise("N"))
    if table == CLAIM_TABLE:
        wh.refined("detail").write_all(refined)
    else:
        wh.refined("financial").write_all(refined.filter(F.col("partkey") % 100 != 0))


@query("balance_jobs", f"SELECT * FROM ({RAW_REPLICA}) a UNION ALL SELECT * FROM ({REPLICA_REFINED}) b")
def q_balance_jobs(t):
    """Both balance jobs of a cycle, from raw folders, replicas and refined tables; their metrics are
    appended to the metrics table and read from there."""
    wh = Warehouse(t.spark, t.scratch("warehouse"))
    feeds = {
        CLAIM_TABLE: t.sql(CLAIM),
        TRANSACTION_TABLE: latest_per_key(t.sql(TXN_FEED), ["id"], TXN_ORDER, tie_break=()),
    }
    for_each(t.spark, lambda table: _load(wh, table, feeds[table]), list(feeds))
    landed = t.spark.createDataFrame(
        [(x.upper(), "f", "1000", "", "CC", 2) for x in feeds], CONTROL["raw_table_load"]
    )
    wh.control("raw_table_load").append(landed)
    wh.control("file_loads").write(landed.withColumn("is_loaded", F.lit(True)))
    jobs = (
        lambda: balance_run_partial(wh, 10, 2, RUN_TS, "CC"),
        lambda: balance_refined(wh, 10, 2, RUN_TS, "detail", "financial"),
    )
    for_each(t.spark, lambda job: publish_metrics(t.spark, wh, job()), jobs)
    return shown(wh.control("balance_metrics").read())
