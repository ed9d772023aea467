"""Rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import portable, query
from driver_queries.views import CLAIM
from tidemark import names as n
from tidemark.operators.collect import collect_chunks
from tidemark.operators.quality import (
    Rule,
    error_lists,
    failing_rows,
    run_rule,
    select_rules,
    validation_summary,
)

RUN_TS = "2024-02-01 00:00:00"
RULE = Rule(
    7,
    "SELECT publicid FROM rule_claim WHERE losstype = '1-URGENT' AND state = 'Open'",
    "rule_claim",
    "publicid",
    "urgent claims are not open",
)
FAILED = "losstype = '1-URGENT' AND state = 'Open'"
CLAIM_CTE = f"claim AS ({portable(CLAIM)})"


def evaluated(t):
    claims = t.sql(CLAIM)
    failed = failing_rows(t.spark, RULE.query, {"rule_claim": claims})
    return run_rule(RULE, failed, claims, run_sk=2, val_run_sk=70, run_ts=RUN_TS)


@query(
    "rule_flag",
    f"""WITH {CLAIM_CTE}
SELECT id, publicid, CYC_RUN_SK, CASE WHEN CYC_RUN_SK = 2 AND publicid IN
  (SELECT publicid FROM claim WHERE {FAILED}) THEN 'F' END AS Validation_Flag FROM claim""",
)
def q_flag(t):
    return evaluated(t).flagged.select("id", "publicid", n.RUN, n.VALIDATION)


COUNTS = f"""SELECT count(*) AS total_count, count(*) FILTER (WHERE NOT ({FAILED})) AS passed_count,
       count(*) FILTER (WHERE {FAILED}) AS failed_count,
       CASE WHEN count(*) FILTER (WHERE {FAILED}) = 0 THEN 'S' ELSE 'F' END AS status
FROM claim WHERE CYC_RUN_SK = 2"""


@query("rule_counts", f"WITH {CLAIM_CTE} {COUNTS}")
def q_counts(t):
    return evaluated(t).counts


# Lists of at most CHUNK keys; the piece a key falls into follows from its MD5.
CHUNK = 10_000


def _chunks_sql(group: str, rows: str, value: str, chunk: int = CHUNK) -> str:
    by = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    return f"""(
  SELECT {by}CAST(chunk AS INTEGER) AS chunk, count(*) AS n_values, string_agg(v, ',' ORDER BY v) AS "values" FROM (
    SELECT {by}{value} AS v, CAST(concat('0x', substr(md5(concat({value}, '#0')), 1, 8)) AS BIGINT)
             % CAST(ceil(count(*) OVER ({part}) / {chunk}.0) AS BIGINT) AS chunk
    FROM {rows}) x GROUP BY {by}chunk)"""


@query(
    "rule_error_log",
    f"""WITH {CLAIM_CTE}
SELECT 'rule_claim' AS gw_table_name, 'publicid' AS gw_primary_key, publicid AS gw_error_values,
       '7' AS val_sk, '70' AS val_run_sk
FROM claim WHERE {FAILED}""",
)
def q_error_log(t):
    return evaluated(t).error_log.drop("inserted_date")


@query(
    "rule_error_log_chunked",
    f"""WITH {CLAIM_CTE}
SELECT 'rule_claim' AS gw_table_name, 'publicid' AS gw_primary_key, "values" AS gw_error_values,
       '7' AS val_sk, '70' AS val_run_sk, chunk
FROM {_chunks_sql("", f"(SELECT publicid FROM claim WHERE {FAILED}) f", "publicid", 100)} c""",
)
def q_error_log_chunked(t):
    failed = failing_rows(t.spark, RULE.query, {"rule_claim": t.sql(CLAIM)})
    return error_lists(failed, RULE, 70, RUN_TS, chunk_rows=100).drop("inserted_date")


@query(
    "validation_summary",
    f"""WITH {CLAIM_CTE}, c AS ({COUNTS})
SELECT 70 AS val_run_sk, 7 AS val_sk, '{RULE.val_rule}' AS val_rule, 'rule_claim' AS table_name,
       'publicid' AS primary_key, 'CC' AS xcenter, 10120 AS step_sk, 2 AS cyc_run_sk,
       status AS val_status, total_count, passed_count, failed_count FROM c""",
)
def q_summary(t):
    out = validation_summary(evaluated(t).counts, RULE, "CC", 10120, 2, 70, RUN_TS)
    return out.drop("val_start_dtm", "val_end_dtm", "aud_dt_tm")


CONTROL = """
SELECT CAST(p_partkey AS INT) AS val_sk, concat('SELECT id FROM ', p_brand) AS val_query,
       CASE WHEN p_size % 3 = 0 THEN 'N' ELSE 'Y' END AS acti_ind,
       CASE WHEN p_size % 5 = 0 THEN 'I' ELSE 'C' END AS status,
       CASE WHEN p_size % 2 = 0 THEN 'CC' ELSE 'PC' END AS xcenter
FROM {part}"""


@query(
    "rule_select",
    f"""SELECT val_sk, val_query, acti_ind, status, xcenter FROM ({portable(CONTROL)}) c
WHERE acti_ind = 'Y' AND status = 'C' AND xcenter = 'CC' ORDER BY val_sk""",
)
def q_select(t):
    return select_rules(t.sql(CONTROL), "CC")


@query(
    "collect_ids",
    f"""SELECT o_orderstatus AS state, chunk, n_values, "values" FROM
{_chunks_sql("o_orderstatus", "orders", "CAST(o_orderkey AS VARCHAR)")} c""",
)
def q_collect(t):
    orders = t.table("orders").withColumn("state", F.col("o_orderstatus"))
    return collect_chunks(orders, "o_orderkey", ["state"], CHUNK)
