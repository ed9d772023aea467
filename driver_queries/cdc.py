"""Change feed queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import Tables, as_text, portable, query
from driver_queries.views import CDC, TXN_FEED, TXN_ORDER
from tidemark import names as n
from tidemark.functions.columns import spatial_to_hex
from tidemark.functions.schema import align_target_to_source, align_to_target, type_changes, union_aligned
from tidemark.operators.cdc import (
    Batch,
    cdc_incremental,
    cdc_initial,
    cdc_reconcile,
    cdc_reconcile_initial,
    incremental_changes,
    initial_latest,
    loaded_counts,
)
from tidemark.operators.dedup import latest_per_key, latest_per_key_in_batch, split_ops
from tidemark.operators.merge import apply_changes, merge_upsert
from tidemark.operators.update import soft_delete, update_where_in
from tidemark.session import Staging

RUN_TS = "2024-02-01 00:00:00"
FINGERPRINTS = ("aaaa", "bbbb")

# ------------------------------------------------------------------------ SQL pieces

CDC_CTE = f"cdc AS ({portable(CDC)})"
TXN_CTE = f"feed AS ({portable(TXN_FEED)})"

INITIAL_CTE = """
latest AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY GW_TIMESTAMP DESC,
         gwcbi___payload_ts_ms DESC, gwcbi___seqval_hex DESC) AS rn
  FROM cdc WHERE phase = 1),
t0 AS (
  SELECT id, status, amount, gwcbi___operation, GW_FINGERPRINT, GW_TIMESTAMP,
         1 AS CYC_RUN_SK, 'N' AS Soft_Delete
  FROM latest WHERE rn = 1 AND gwcbi___operation <> 1)"""


def _batch_cte(name: str, fingerprint: str, *phases: int) -> str:
    chosen = ", ".join(map(str, phases))
    return f"""
{name}_m AS (SELECT max(GW_TIMESTAMP) AS last_ts FROM cdc
             WHERE phase IN ({chosen}) AND GW_FINGERPRINT = '{fingerprint}'),
{name} AS (
  SELECT id, status, amount, gwcbi___operation, GW_FINGERPRINT, last_ts AS GW_TIMESTAMP
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY gwcbi___payload_ts_ms DESC,
               gwcbi___seqval_hex DESC) AS rn
        FROM cdc WHERE phase IN ({chosen}) AND GW_FINGERPRINT = '{fingerprint}') x, {name}_m
  WHERE rn = 1)"""


def _apply_cte(out: str, target: str, batch: str, run: int, partial: bool = False) -> str:
    """One batch merged into a target, then its deletes flagged, as two statements."""
    kept = ["status", "gwcbi___operation", "GW_FINGERPRINT", "GW_TIMESTAMP"]
    kept += [] if partial else ["amount"]
    columns = ["status", "amount", "gwcbi___operation", "GW_FINGERPRINT", "GW_TIMESTAMP"]
    picks = ", ".join(
        f"CASE WHEN s.id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" if c in kept else f"t.{c} AS {c}"
        for c in columns
    )
    return f"""
{out}_u AS (SELECT * FROM {batch} WHERE gwcbi___operation IN (0, 2, 4)),
{out}_m AS (
  SELECT coalesce(t.id, s.id) AS id, {picks},
         CASE WHEN s.id IS NOT NULL THEN {run} ELSE t.CYC_RUN_SK END AS CYC_RUN_SK,
         CASE WHEN s.id IS NOT NULL THEN 'N' ELSE t.Soft_Delete END AS Soft_Delete
  FROM {target} t FULL OUTER JOIN {out}_u s ON t.id = s.id),
{out} AS (
  SELECT id, {", ".join(columns)},
         CASE WHEN id IN (SELECT id FROM {batch} WHERE gwcbi___operation = 1)
              THEN {run} ELSE CYC_RUN_SK END AS CYC_RUN_SK,
         CASE WHEN id IN (SELECT id FROM {batch} WHERE gwcbi___operation = 1)
              THEN 'Y' ELSE Soft_Delete END AS Soft_Delete
  FROM {out}_m)"""


def _chain(partial: bool = False) -> str:
    parts = [CDC_CTE, INITIAL_CTE]
    target = "t0"
    for phase in (2, 3):
        for fingerprint in FINGERPRINTS:
            name = f"b{phase}{fingerprint[0]}"
            out = f"t{phase}{fingerprint[0]}"
            parts.append(_batch_cte(name, fingerprint, phase))
            parts.append(_apply_cte(out, target, name, phase, partial and fingerprint == "bbbb"))
            target = out
    return "WITH " + ",".join(parts)


STATE = "id, status, amount, gwcbi___operation, GW_FINGERPRINT, GW_TIMESTAMP, CYC_RUN_SK, Soft_Delete"
STATE_COLUMNS = [c.strip() for c in STATE.split(",")]

# ------------------------------------------------------------------------ Spark pieces


def feed(t: Tables, phase: int):
    return t.sql(CDC).filter(F.col("phase") == phase).drop("phase")


def replica(t: Tables):
    return cdc_initial(feed(t, 1), 1, RUN_TS)


def batches(t: Tables, phase: int, partial: bool = False) -> list[Batch]:
    rows = feed(t, phase)
    newest = rows.groupBy(n.FINGERPRINT).agg(F.max(n.DELIVERY).alias("last")).collect()
    out = []
    for fingerprint, last in sorted((r[0], r[1]) for r in newest):
        mine = rows.filter(F.col(n.FINGERPRINT) == fingerprint)
        mine = mine.drop("amount") if partial and fingerprint == "bbbb" else mine
        out.append(Batch(fingerprint, last, mine))
    return out


# ------------------------------------------------------------------------------ dedup


@query(
    "latest_per_key",
    f"""WITH {CDC_CTE}
SELECT id, status, amount, gwcbi___operation, gwcbi___seqval_hex, GW_FINGERPRINT, GW_TIMESTAMP FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY GW_TIMESTAMP DESC,
         gwcbi___payload_ts_ms DESC, gwcbi___seqval_hex DESC) AS rn FROM cdc) x WHERE rn = 1""",
)
def q_latest(t):
    return latest_per_key(t.sql(CDC), ["id"]).select(
        "id", "status", "amount", n.OPERATION, n.SEQUENCE, n.FINGERPRINT, n.DELIVERY
    )


@query(
    "latest_per_key_fingerprint",
    f"""WITH {CDC_CTE}
SELECT id, status, amount, gwcbi___operation, gwcbi___seqval_hex, GW_FINGERPRINT, GW_TIMESTAMP FROM (
  SELECT *, row_number() OVER (PARTITION BY id, GW_FINGERPRINT ORDER BY GW_TIMESTAMP DESC,
         gwcbi___payload_ts_ms DESC, gwcbi___seqval_hex DESC) AS rn FROM cdc) x WHERE rn = 1""",
)
def q_latest_fingerprint(t):
    return latest_per_key_in_batch(t.sql(CDC)).select(
        "id", "status", "amount", n.OPERATION, n.SEQUENCE, n.FINGERPRINT, n.DELIVERY
    )


@query(
    "txn_dedup",
    f"""WITH {TXN_CTE}
SELECT id, claimid, amount, costtype, costcategory, shipdate, partkey, suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY shipdate DESC, partkey DESC,
         suppkey DESC) AS rn FROM feed) x WHERE rn = 1""",
)
def q_txn_dedup(t):
    return latest_per_key(t.sql(TXN_FEED), ["id"], TXN_ORDER, tie_break=()).select(
        "id", "claimid", "amount", "costtype", "costcategory", *TXN_ORDER
    )


# ------------------------------------------------------------------------------- load


@query("cdc_initial", f"WITH {CDC_CTE}, {INITIAL_CTE} SELECT {STATE} FROM t0")
def q_initial(t):
    return replica(t).select(*STATE_COLUMNS)


@query(
    "cdc_ops_split",
    f"""WITH {CDC_CTE}, {INITIAL_CTE}
SELECT CASE WHEN gwcbi___operation = 1 THEN 'delete' ELSE 'upsert' END AS kind,
       gwcbi___operation, count(*) AS n_rows
FROM latest WHERE rn = 1 GROUP BY ALL""",
)
def q_split(t):
    deletes, upserts = split_ops(latest_per_key(feed(t, 1), ["id"]))
    both = deletes.withColumn("kind", F.lit("delete")).unionByName(
        upserts.withColumn("kind", F.lit("upsert"))
    )
    return both.groupBy("kind", n.OPERATION).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "cdc_merge_upsert",
    f"""WITH {CDC_CTE}, {INITIAL_CTE}, {_batch_cte("b", "aaaa", 2)},
u AS (SELECT * FROM b WHERE gwcbi___operation IN (0, 2, 4))
SELECT * FROM (
SELECT id, status, amount, gwcbi___operation, GW_FINGERPRINT, GW_TIMESTAMP FROM u
UNION ALL
SELECT id, status, amount, gwcbi___operation, GW_FINGERPRINT, GW_TIMESTAMP FROM t0
WHERE id NOT IN (SELECT id FROM u)) x""",
)
def q_merge(t):
    batch = batches(t, 2)[0]
    source = latest_per_key(batch.rows.withColumn(n.DELIVERY, F.lit(batch.last_delivery)), ["id"])
    merged = merge_upsert(replica(t), split_ops(source)[1])
    return merged.select("id", "status", "amount", n.OPERATION, n.FINGERPRINT, n.DELIVERY)


@query(
    "cdc_soft_delete",
    f"""WITH {CDC_CTE}, {INITIAL_CTE},
gone AS (SELECT id FROM cdc WHERE phase = 2 AND gwcbi___operation = 1)
SELECT id, status, amount,
       CASE WHEN id IN (SELECT id FROM gone) THEN 2 ELSE CYC_RUN_SK END AS CYC_RUN_SK,
       CASE WHEN id IN (SELECT id FROM gone) THEN 'Y' ELSE Soft_Delete END AS Soft_Delete
FROM t0""",
)
def q_soft_delete(t):
    deletes, _ = split_ops(feed(t, 2))
    flagged = soft_delete(replica(t), deletes, run_sk=2)
    return flagged.select("id", "status", "amount", n.RUN, n.SOFT_DELETE)


@query("cdc_incremental", f"{_chain()} SELECT {STATE} FROM t3b")
def q_incremental(t):
    state = cdc_incremental(replica(t), batches(t, 2), 2, RUN_TS)
    return cdc_incremental(state, batches(t, 3), 3, RUN_TS).select(*STATE_COLUMNS)


@query(
    "cdc_incremental_partial",
    f"{_chain(partial=True)} SELECT {STATE.replace('amount', 'CAST(amount AS VARCHAR) AS amount')} FROM t3b",
)
def q_incremental_partial(t):
    """The second schema version lacks a column: its upserts keep the earlier value."""
    state = cdc_incremental(replica(t), batches(t, 2, True), 2, RUN_TS)
    state = cdc_incremental(state, batches(t, 3, True), 3, RUN_TS)
    return as_text(state.select(*STATE_COLUMNS), "amount")


@query(
    "cdc_reconcile",
    f"""{_chain()},
c AS (SELECT count(*) AS rows_read, count(DISTINCT id) AS dedup FROM cdc WHERE phase = 2),
ends AS (SELECT coalesce(b.id, a.id) AS id,
                CASE WHEN b.id IS NOT NULL THEN b.gwcbi___operation ELSE a.gwcbi___operation END AS op
         FROM b2a a FULL OUTER JOIN b2b b ON a.id = b.id),
d AS (SELECT count(*) AS rows_deleted FROM ends WHERE op = 1),
l AS (SELECT count(*) FILTER (WHERE Soft_Delete = 'N') AS target_rows_loaded,
             count(*) FILTER (WHERE gwcbi___operation IN (0, 2)) AS rows_inserted,
             count(*) FILTER (WHERE gwcbi___operation = 4) AS rows_updated
      FROM t2b WHERE CYC_RUN_SK = 2)
SELECT rows_read, rows_read - dedup AS rows_duplicate, target_rows_loaded, rows_inserted,
       rows_updated, rows_deleted,
       target_rows_loaded + rows_read - dedup + rows_deleted AS rows_loaded,
       CASE WHEN rows_read = target_rows_loaded + rows_read - dedup + rows_deleted
            THEN 'S' ELSE 'F' END AS status
FROM c, d, l""",
)
def q_reconcile(t):
    target = replica(t)
    changes = incremental_changes(target, batches(t, 2), 2, RUN_TS)
    changes = changes.staged(Staging(t.spark), "changes")
    return cdc_reconcile(feed(t, 2), changes, apply_changes(target, changes, 2), 2)


@query(
    "cdc_reconcile_initial",
    f"""WITH {CDC_CTE}, {INITIAL_CTE},
c AS (SELECT count(*) AS rows_read, count(DISTINCT id) AS dedup FROM cdc WHERE phase = 1),
d AS (SELECT count(*) AS rows_deleted FROM latest WHERE rn = 1 AND gwcbi___operation = 1),
l AS (SELECT count(*) AS target_rows_loaded,
             count(*) FILTER (WHERE gwcbi___operation IN (0, 2)) AS rows_inserted,
             count(*) FILTER (WHERE gwcbi___operation = 4) AS rows_updated FROM t0)
SELECT rows_read, rows_read - dedup AS rows_duplicate, target_rows_loaded, rows_inserted,
       rows_updated, rows_deleted,
       target_rows_loaded + rows_read - dedup + rows_deleted AS rows_loaded, 'S' AS status
FROM c, d, l""",
)
def q_reconcile_initial(t):
    raw = feed(t, 1)
    return cdc_reconcile_initial(raw, initial_latest(raw, 1, RUN_TS), replica(t), 1)


@query(
    "loaded_counts",
    f"""WITH {TXN_CTE}
SELECT count(*) FILTER (WHERE Soft_Delete = 'N') AS target_rows_loaded,
       count(*) FILTER (WHERE gwcbi___operation IN (0, 2)) AS rows_inserted,
       count(*) FILTER (WHERE gwcbi___operation = 4) AS rows_updated,
       count(*) FILTER (WHERE gwcbi___operation IN (0, 2) AND Soft_Delete = 'N') AS rows_inserted_live,
       count(*) FILTER (WHERE gwcbi___operation = 4 AND Soft_Delete = 'N') AS rows_updated_live
FROM feed WHERE CYC_RUN_SK = 2""",
)
def q_loaded_counts(t):
    return loaded_counts(t.sql(TXN_FEED), 2)


# ----------------------------------------------------------------------------- schema


@query(
    "schema_align",
    """SELECT o_orderkey AS id, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS rank,
       CAST(CASE WHEN o_orderstatus = 'O' THEN 7 END AS VARCHAR) AS bad, CAST(o_custkey AS VARCHAR) AS code
FROM orders""",
)
def q_align(t):
    source = t.sql(
        "SELECT o_orderkey AS id, split_part(o_orderpriority, '-', 1) AS rank, "
        "CASE WHEN o_orderstatus = 'O' THEN '7' ELSE o_orderpriority END AS bad, "
        "o_custkey AS code FROM {orders}"
    )
    target = t.spark.createDataFrame([], "id bigint, rank int, bad int, code string")
    return as_text(align_to_target(source, target), "bad")


@query(
    "schema_align_target",
    "SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS code, o_orderstatus AS state FROM orders",
)
def q_align_target(t):
    target = t.sql("SELECT o_orderkey AS id, o_custkey AS code, o_orderstatus AS state FROM {orders}")
    source = target.withColumn("code", F.col("code").cast("string")).drop("state")
    return align_target_to_source(target, source)


@query(
    "schema_evolve",
    """SELECT o_orderkey AS id, o_orderstatus AS state, CAST(o_custkey AS VARCHAR) AS ref,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority FROM orders""",
)
def q_evolve(t):
    base = t.sql(
        "SELECT o_orderkey AS id, o_orderstatus AS state, o_custkey AS ref, "
        "o_orderpriority AS priority FROM {orders}"
    )
    old = base.filter("id % 2 = 0").drop("priority")
    new = base.filter("id % 2 = 1").withColumn("ref", F.col("ref").cast("string"))
    return union_aligned([old, new])


@query("schema_diff", "SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS ref, o_orderstatus AS state FROM orders")
def q_diff(t):
    """Stored rows take the types that differ in a newer schema, and no other change."""
    have = t.sql("SELECT o_orderkey AS id, o_custkey AS ref, o_orderstatus AS state FROM {orders}")
    like = have.withColumn("ref", F.col("ref").cast("string")).schema
    return have.withColumns({c: F.col(c).cast(new) for c, (_, new) in type_changes(have, like).items()})



@query("spatial_hex", "SELECT c_custkey AS id, hex(c_name) AS spatialpoint FROM customer")
def q_spatial(t):
    shaped = t.sql(
        "SELECT c_custkey AS id, named_struct('wkb', CAST(c_name AS BINARY), 'srid', 4326) "
        "AS spatialpoint FROM {customer}"
    )
    return spatial_to_hex(shaped)


# ----------------------------------------------------------------------------- updates


@query(
    "update_in",
    """SELECT o_orderkey AS id, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer
       WHERE c_mktsegment = 'BUILDING') THEN 'deleted' ELSE o_orderstatus END AS state FROM orders""",
)
def q_update_in(t):
    target = t.sql("SELECT o_orderkey AS id, o_custkey AS cust, o_orderstatus AS state FROM {orders}")
    keys = t.table("customer").filter("c_mktsegment = 'BUILDING'")
    out = update_where_in(
        target, keys, [(F.col("cust"), F.col("c_custkey"))], {"state": F.lit("deleted")}
    )
    return out.select("id", "state")


@query(
    "count_filter",
    """SELECT event_type, count(*) FILTER (WHERE value > 50) AS high,
       count(*) FILTER (WHERE value <= 50) AS low, count(*) AS total
FROM events GROUP BY event_type""",
)
def q_count_filter(t):
    high = F.col("value") > 50
    return t.table("events").groupBy("event_type").agg(
        F.count_if(high).alias("high"),
        F.count_if(~high).alias("low"),
        F.count(F.lit(1)).alias("total"),
    ).orderBy("event_type")


@query(
    "audit_columns",
    f"""WITH {CDC_CTE}, {INITIAL_CTE}
SELECT id, 1 AS CYC_RUN_SK, '{RUN_TS}' AS ABC_AUDIT_DATE_TIME,
       CAST(NULL AS VARCHAR) AS Validation_Flag, 'N' AS Soft_Delete FROM t0""",
)
def q_audit(t):
    return as_text(
        replica(t).select("id", n.RUN, n.AUDIT_TS, n.VALIDATION, n.SOFT_DELETE), n.AUDIT_TS
    )
