"""Refined projections and job parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import portable, query
from driver_queries.views import CLAIM, POLICY, TXN_FEED, TXN_ORDER
from tidemark.operators.dedup import latest_per_key
from tidemark.plans.insurance import claim_detail, claim_financial
from tidemark.plans.jobspec import job_parameters, render_sql

TXN_CTE = f"""txn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id
  ORDER BY shipdate DESC, partkey DESC, suppkey DESC) AS rn FROM ({portable(TXN_FEED)}) f) g
  WHERE rn = 1)"""


@query(
    "claim_detail",
    f"""WITH claim AS ({portable(CLAIM)}), policy AS ({portable(POLICY)})
SELECT c.id, c.publicid AS claim_publicid, c.claimnumber, c.policyid, c.lossdate, c.losstype,
       c.state AS lossstate, p.policynumber, p.policytype, p.premium,
       c.CYC_RUN_SK AS cyc_run_sk, c.Soft_Delete
FROM claim c LEFT JOIN policy p ON c.policyid = p.id WHERE c.Soft_Delete = 'N'""",
)
def q_claim_detail(t):
    return claim_detail(t.sql(CLAIM), t.sql(POLICY))


CLAIM_FINANCIAL = f"""WITH claim AS ({portable(CLAIM)}), {TXN_CTE}
SELECT t.id, t.publicid AS transaction_publicid, t.claimid, t.amount, t.costtype, t.costcategory,
       c.claimnumber, c.lossdate, c.losstype, c.state AS lossstate,
       t.CYC_RUN_SK AS cyc_run_sk, t.Soft_Delete
FROM txn t LEFT JOIN claim c ON t.claimid = c.id WHERE t.Soft_Delete = 'N'"""


@query("claim_financial", CLAIM_FINANCIAL)
def q_claim_financial(t):
    transactions = latest_per_key(t.sql(TXN_FEED), ["id"], TXN_ORDER, tie_break=())
    return claim_financial(transactions, t.sql(CLAIM))


@query("claim_financial_salted", CLAIM_FINANCIAL)
def q_claim_financial_salted(t):
    """The same join with hot claims and missing claims spread over several tasks."""
    transactions = t.stored(latest_per_key(t.sql(TXN_FEED), ["id"], TXN_ORDER, tie_break=()), "txn")
    return claim_financial(transactions, t.sql(CLAIM), salts=8)


# One job per customer nation; each parameter is a column of the given nation and region rows.
PARAMETERS = """
SELECT CAST(c_custkey AS INT) * 10 + k AS parm_sk, c_custkey AS job_sk,
       CASE k WHEN 1 THEN 'src_keys' WHEN 2 THEN 'SurrogateKey' WHEN 3 THEN 'Driving_Table'
              WHEN 4 THEN 'tfm_query_1' ELSE 'tfm_query_2' END AS parm_nm,
       CASE k WHEN 1 THEN 'id' WHEN 2 THEN concat(c_mktsegment, '_sk') WHEN 3 THEN c_mktsegment
              WHEN 4 THEN 'SELECT *' ELSE concat('FROM @catalog.@src_schema.', c_mktsegment) END AS parm_val
FROM {customer} CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 UNION ALL SELECT 3
                            UNION ALL SELECT 4 UNION ALL SELECT 5) ks"""


@query(
    "job_params_pivot",
    f"""WITH p AS ({portable(PARAMETERS)})
SELECT c_custkey AS job_sk, c_name AS tgt_file_tbl,
       max(CASE WHEN parm_nm = 'src_keys' THEN parm_val END) AS src_keys,
       max(CASE WHEN parm_nm = 'SurrogateKey' THEN parm_val END) AS surrogatekey,
       max(CASE WHEN parm_nm = 'Driving_Table' THEN parm_val END) AS driving_table,
       string_agg(CASE WHEN parm_nm LIKE '%tfm_query%' THEN parm_val END, ' ' ORDER BY parm_sk) AS tfm_query
FROM customer JOIN p ON c_custkey = p.job_sk GROUP BY c_custkey, c_name""",
)
def q_job_params(t):
    jobs = t.sql("SELECT c_custkey AS job_sk, c_name AS tgt_file_tbl FROM {customer}")
    out = job_parameters(jobs, t.sql(PARAMETERS))
    return out.select(
        "job_sk", "tgt_file_tbl", "src_keys", "surrogatekey", "driving_table", "tfm_query"
    )


@query(
    "render_sql",
    """SELECT c.c_custkey AS id, n.n_name AS nation, c.c_mktsegment AS policytype
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def q_render(t):
    for name in ("customer", "nation"):
        t.table(name).createOrReplaceTempView(name)
    text = (
        "SELECT c.c_custkey AS id, n.n_name AS nation, c.c_mktsegment AS policytype "
        "FROM @catalog.@src_schema.customer c "
        "LEFT JOIN @catalog.@src_schema.nation n ON c.c_nationkey = n.n_nationkey"
    )
    return t.spark.sql(render_sql(text))


@query(
    "refined_star",
    f"""WITH claim AS ({portable(CLAIM)}), policy AS ({portable(POLICY)})
SELECT p.policytype, count(*) AS claims, count(p.id) AS with_policy
FROM claim c LEFT JOIN policy p ON c.policyid = p.id WHERE c.Soft_Delete = 'N'
GROUP BY p.policytype""",
)
def q_star(t):
    detail = claim_detail(t.sql(CLAIM), t.sql(POLICY))
    return detail.groupBy("policytype").agg(
        F.count(F.lit(1)).alias("claims"), F.count("policynumber").alias("with_policy")
    )
