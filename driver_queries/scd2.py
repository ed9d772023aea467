"""History table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import Tables, as_text, portable, query
from driver_queries.views import CLAIM
from tidemark import names as n
from tidemark.functions.columns import business_columns
from tidemark.operators.dedup import unique_source
from tidemark.operators.scd2 import (
    classify,
    current_rows,
    duplicate_active_keys,
    expire_retired,
    expire_soft_deleted,
    number_inserts,
    scd2_hash,
    scd2_initial,
    scd2_merge,
    scd2_metadata,
    scd2_reconcile,
    scd2_rows_read,
)
from tidemark.operators.surrogate import assign_surrogate, number_new_rows

SK = "claim_sk"
T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
OLD = "2024-01-15 00:00:00"
DATES = (n.EFFECTIVE, n.EXPIRY, n.CREATED, n.UPDATED)

# Portable source rows of run 1 and run 2.
SOURCE1 = """
SELECT o_orderkey AS id, o_custkey AS policyid, o_orderstatus AS state,
       CAST(ROUND(o_totalprice * 100) AS BIGINT) AS amount, 1 AS cyc_run_sk
FROM {orders}"""
SOURCE2 = """
SELECT o_orderkey AS id, o_custkey AS policyid,
       CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS state,
       CAST(ROUND(o_totalprice * 100) AS BIGINT) AS amount, 2 AS cyc_run_sk
FROM {orders} WHERE o_orderpriority <> '3-MEDIUM'
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus,
       CAST(ROUND(o_totalprice * 100) AS BIGINT), 2
FROM {orders} WHERE o_orderpriority = '1-URGENT'"""

HASHES = """md5(CAST(id AS VARCHAR)) AS ETL_Key_Hash,
       md5(concat_ws(chr(1), coalesce(CAST(amount AS VARCHAR), chr(2)),
                     coalesce(CAST(policyid AS VARCHAR), chr(2)),
                     coalesce(state, chr(2)))) AS ETL_SCD2_Hash"""

# Target of run 1: some keys have only a closed version, some an older closed one as well.
SETUP = f"""
src1 AS (SELECT {HASHES}, * FROM ({portable(SOURCE1)}) x),
src AS (SELECT {HASHES}, * FROM ({portable(SOURCE2)}) x),
tgt AS (
  SELECT ETL_Key_Hash, ETL_SCD2_Hash, id, policyid, state, amount,
         row_number() OVER (ORDER BY ETL_Key_Hash) AS {SK},
         CASE WHEN id % 17 = 0 THEN 'N' ELSE 'Y' END AS flag,
         CASE WHEN id % 17 = 0 THEN '{OLD}' ELSE '{n.OPEN_END}' END AS expiry,
         '1' AS last_run, '1' AS ins_run, '{T1}' AS updated
  FROM src1
  UNION ALL
  SELECT ETL_Key_Hash, md5(concat('old', CAST(id AS VARCHAR))), id, policyid, 'old', amount,
         1000000000 + id, 'N', '{OLD}', '1', '1', '{T1}'
  FROM src1 WHERE state = 'P'),
st AS (SELECT ETL_Key_Hash AS k, max(CASE WHEN flag = 'Y' THEN ETL_SCD2_Hash END) AS ah,
              count(*) AS versions FROM tgt GROUP BY 1)"""


def _merge_sql(reactivate: bool) -> str:
    """The merge as its two effects: close changed active rows, add staged rows."""
    extra = " OR st.ah IS NULL" if reactivate else ""
    return f"""WITH {SETUP},
closed AS (
  SELECT t.*, (t.flag = 'Y' AND s.ETL_Key_Hash IS NOT NULL
               AND t.ETL_SCD2_Hash <> s.ETL_SCD2_Hash) AS hit
  FROM tgt t LEFT JOIN src s ON t.ETL_Key_Hash = s.ETL_Key_Hash),
added AS (
  SELECT s.*, (SELECT max({SK}) FROM tgt) + row_number() OVER (ORDER BY s.ETL_Key_Hash) AS {SK}
  FROM src s LEFT JOIN st ON s.ETL_Key_Hash = st.k
  WHERE st.k IS NULL OR st.ah <> s.ETL_SCD2_Hash{extra})
SELECT ETL_Key_Hash, ETL_SCD2_Hash, id, policyid, state, amount, {SK},
       CASE WHEN hit THEN 'N' ELSE flag END AS ETL_ActiveRow_Flag,
       '{T1}' AS ETL_RecordEffective_Date,
       CASE WHEN hit THEN '{T2}' ELSE expiry END AS ETL_RecordExpiry_Date,
       '{T1}' AS ETL_Created_Date,
       CASE WHEN hit THEN '{T2}' ELSE updated END AS ETL_Updated_Date,
       CASE WHEN hit THEN '2' ELSE last_run END AS ETL_Lst_Updt_Cyc_Sk, ins_run AS ETL_Ins_Cyc_SK
FROM closed
UNION ALL
SELECT ETL_Key_Hash, ETL_SCD2_Hash, id, policyid, state, amount, {SK}, 'Y', '{T2}',
       '{n.OPEN_END}', '{T2}', '{T2}', '2', '2'
FROM added"""


SHOWN = [
    n.KEY_HASH, n.CHANGE_HASH, "id", "policyid", "state", "amount", SK, n.ACTIVE, *DATES,
    n.LAST_RUN, n.INSERT_RUN,
]


def source(t: Tables, run: int):
    rows = t.sql(SOURCE1 if run == 1 else SOURCE2)
    return scd2_metadata(scd2_hash(rows, ["id"]), SK, run, T1 if run == 1 else T2)


def target(t: Tables):
    """History after run 1; the numbered rows are stored once, the rest is a cheap union."""
    first = t.stored(scd2_initial(source(t, 1), SK, 1), "history")
    inactive = F.col("id") % 17 == 0
    base = first.withColumns(
        {
            n.ACTIVE: F.when(inactive, "N").otherwise("Y"),
            n.EXPIRY: F.when(inactive, F.lit(OLD).cast("timestamp")).otherwise(F.col(n.EXPIRY)),
        }
    )
    older = first.filter("state = 'P'").withColumns(
        {
            n.CHANGE_HASH: F.md5(F.concat(F.lit("old"), F.col("id").cast("string"))),
            "state": F.lit("old"),
            SK: F.lit(1000000000) + F.col("id"),
            n.ACTIVE: F.lit("N"),
            n.EXPIRY: F.lit(OLD).cast("timestamp"),
        }
    )
    return base.unionByName(older)


def merged(t: Tables, reactivate: bool = False):
    tgt, src = target(t), t.stored(source(t, 2), "source")
    known = t.stored(classify(src, tgt, reactivate), "classified")
    numbered = number_inserts(src, tgt, SK, classified=known)
    return scd2_merge(tgt, numbered, 2, T2, reactivate)


@query(
    "scd2_hash",
    f"SELECT {HASHES}, id, policyid, state, amount, cyc_run_sk FROM ({portable(SOURCE1)}) x",
)
def q_hash(t):
    return scd2_hash(t.sql(SOURCE1), ["id"])


@query(
    "scd2_hash_compat",
    f"""SELECT md5(CAST(id AS VARCHAR)) AS ETL_Key_Hash,
       md5(concat(coalesce(CAST(amount AS VARCHAR), ''), coalesce(CAST(policyid AS VARCHAR), ''),
                  coalesce(state, ''))) AS ETL_SCD2_Hash, id FROM ({portable(SOURCE1)}) x""",
)
def q_hash_compat(t):
    hashed = scd2_hash(t.sql(SOURCE1), ["id"], compat=True)
    return hashed.select(n.KEY_HASH, n.CHANGE_HASH, "id")


@query(
    "scd2_initial",
    f"""WITH {SETUP}
SELECT ETL_Key_Hash, ETL_SCD2_Hash, id, policyid, state, amount,
       row_number() OVER (ORDER BY ETL_Key_Hash) AS {SK}, 'Y' AS ETL_ActiveRow_Flag,
       '{T1}' AS ETL_RecordEffective_Date, '{n.OPEN_END}' AS ETL_RecordExpiry_Date,
       '{T1}' AS ETL_Created_Date, '{T1}' AS ETL_Updated_Date, '1' AS ETL_Lst_Updt_Cyc_Sk,
       '1' AS ETL_Ins_Cyc_SK FROM src1""",
)
def q_initial(t):
    return as_text(scd2_initial(source(t, 1), SK, 1).select(*SHOWN), *DATES)


@query("scd2_merge", _merge_sql(reactivate=False))
def q_merge(t):
    return as_text(merged(t).select(*SHOWN), *DATES)


@query("scd2_reactivate", _merge_sql(reactivate=True))
def q_reactivate(t):
    return as_text(merged(t, reactivate=True).select(*SHOWN), *DATES)


_READ = """
SELECT (SELECT count(*) FROM src) - count(DISTINCT k) AS rows_read FROM (
  SELECT s.ETL_Key_Hash AS k FROM src s JOIN tgt t ON s.ETL_Key_Hash = t.ETL_Key_Hash
   AND s.ETL_SCD2_Hash = t.ETL_SCD2_Hash AND t.flag = 'Y'
  UNION
  SELECT s.ETL_Key_Hash FROM src s JOIN tgt t ON s.ETL_Key_Hash = t.ETL_Key_Hash
   AND s.ETL_SCD2_Hash = t.ETL_SCD2_Hash AND t.flag = 'N'
   AND s.ETL_Key_Hash IN (SELECT k FROM st WHERE versions = 1)) d"""


@query("scd2_rows_read", f"WITH {SETUP} {_READ}")
def q_rows_read(t):
    return scd2_rows_read(source(t, 2), target(t))


@query(
    "scd2_reconcile",
    f"""WITH {SETUP}, r AS ({_READ}),
c AS (SELECT count(*) FILTER (WHERE st.k IS NULL OR st.ah <> s.ETL_SCD2_Hash) AS rows_inserted,
             count(*) FILTER (WHERE st.ah <> s.ETL_SCD2_Hash) AS rows_updated
      FROM src s LEFT JOIN st ON s.ETL_Key_Hash = st.k)
SELECT rows_read, rows_inserted + rows_updated AS rows_loaded, rows_inserted, rows_updated,
       CASE WHEN rows_read = rows_inserted THEN 'S' ELSE 'F' END AS status FROM r, c""",
)
def q_reconcile(t):
    tgt, src = target(t), t.stored(source(t, 2), "source")
    known = t.stored(classify(src, tgt), "classified")
    state = scd2_merge(tgt, number_inserts(src, tgt, SK, classified=known), 2, T2)
    return scd2_reconcile(scd2_rows_read(src, tgt, known), state, 2)


@query(
    "scd2_current",
    f"WITH {SETUP} SELECT id, state, amount, {SK} FROM tgt WHERE flag = 'Y'",
)
def q_current(t):
    return current_rows(target(t)).select("id", "state", "amount", SK)


@query(
    "scd2_duplicate_active",
    """SELECT md5(CAST(l_orderkey AS VARCHAR)) AS ETL_Key_Hash, count(*) AS versions
FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1 HAVING count(*) > 1""",
)
def q_duplicate_active(t):
    rows = t.sql(
        "SELECT md5(CAST(l_orderkey AS STRING)) AS ETL_Key_Hash, "
        "CASE l_linestatus WHEN 'O' THEN 'Y' ELSE 'N' END AS ETL_ActiveRow_Flag FROM {lineitem}"
    )
    return duplicate_active_keys(rows)


@query(
    "surrogate_initial",
    """SELECT p_partkey AS id, row_number() OVER (ORDER BY md5(CAST(p_partkey AS VARCHAR))) AS sk
FROM part""",
)
def q_surrogate(t):
    parts = t.sql("SELECT p_partkey AS id, md5(CAST(p_partkey AS STRING)) AS h FROM {part}")
    return assign_surrogate(parts, "sk", key_hash="h").select("id", "sk")


@query(
    "surrogate_increment",
    """WITH p AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN 0
                         ELSE o_orderkey + 1 END AS sk FROM orders)
SELECT id, sk FROM p WHERE sk <> 0
UNION ALL
SELECT id, (SELECT max(sk) FROM p) + row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR)))
FROM p WHERE sk = 0""",
)
def q_surrogate_increment(t):
    rows = t.sql(
        "SELECT o_orderkey AS id, md5(CAST(o_orderkey AS STRING)) AS ETL_Key_Hash, "
        "CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_orderkey + 1 END AS sk FROM {orders}"
    )
    return number_new_rows(rows, "sk").select("id", "sk")


@query(
    "refined_dedup",
    """SELECT claimid, id, amount FROM (
  SELECT l_orderkey AS claimid, concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS id,
         l_extendedprice AS amount, row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC) AS rn
  FROM lineitem) x WHERE rn = 1""",
)
def q_refined_dedup(t):
    rows = t.sql(
        "SELECT l_orderkey AS claimid, concat(CAST(l_orderkey AS STRING), '-', "
        "CAST(l_linenumber AS STRING)) AS id, l_extendedprice AS amount, l_shipdate, l_partkey, "
        "l_suppkey, l_linenumber FROM {lineitem}"
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"]
    return unique_source(rows, ["claimid"], order).select("claimid", "id", "amount")


def _expire_sql(reason: str, compat: bool = False) -> str:
    guard = "" if compat else "flag = 'Y' AND "
    return f"""WITH {SETUP}, claim AS ({portable(CLAIM)}),
gone AS (SELECT CAST(id AS VARCHAR) AS k FROM claim WHERE CYC_RUN_SK > 1 AND {reason}),
x AS (SELECT *, ({guard}CAST(id AS VARCHAR) IN (SELECT k FROM gone)) AS hit FROM tgt)
SELECT id, {SK}, CASE WHEN hit THEN 'N' ELSE flag END AS ETL_ActiveRow_Flag,
       CASE WHEN hit THEN '{T2}' ELSE expiry END AS ETL_RecordExpiry_Date,
       CASE WHEN hit THEN '{T2}' ELSE updated END AS ETL_Updated_Date,
       CASE WHEN hit THEN '2' ELSE last_run END AS ETL_Lst_Updt_Cyc_Sk FROM x"""


EXPIRED = ["id", SK, n.ACTIVE, n.EXPIRY, n.UPDATED, n.LAST_RUN]


@query("expire_soft_deleted", _expire_sql("Soft_Delete = 'Y'"))
def q_expire(t):
    out = expire_soft_deleted(target(t), t.sql(CLAIM), ["id"], ["id"], 1, 2, T2)
    return as_text(out.select(*EXPIRED), n.EXPIRY, n.UPDATED)


@query("expire_soft_deleted_compat", _expire_sql("Soft_Delete = 'Y'", compat=True))
def q_expire_compat(t):
    out = expire_soft_deleted(target(t), t.sql(CLAIM), ["id"], ["id"], 1, 2, T2, compat=True)
    return as_text(out.select(*EXPIRED), n.EXPIRY, n.UPDATED)


@query("expire_retired", _expire_sql("retired <> 0"))
def q_expire_retired(t):
    out = expire_retired(target(t), t.sql(CLAIM), ["id"], ["id"], 1, 2, T2)
    return as_text(out.select(*EXPIRED), n.EXPIRY, n.UPDATED)


@query("business_columns", f"SELECT amount, policyid, state FROM ({portable(SOURCE1)}) s")
def q_business(t):
    """The columns that a change hash covers, picked from the source rows."""
    rows = t.sql(SOURCE1)
    return rows.select(*business_columns(rows.columns, ["id"], n.DEFAULT_EXCLUSIONS))
