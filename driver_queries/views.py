"""Claims-shaped views over the given tables, in SQL that runs unchanged on both engines."""

from driver_queries.registry import portable

POLICY = """
SELECT c_custkey AS id,
       c_name AS policynumber,
       c_mktsegment AS policytype,
       CAST(ROUND(c_acctbal * 100) AS BIGINT) AS premium
FROM {customer}"""

CLAIM = """
SELECT o_orderkey AS id,
       concat('pub:', CAST(o_orderkey AS STRING)) AS publicid,
       concat('CLM-', CAST(o_orderkey AS STRING)) AS claimnumber,
       o_custkey AS policyid,
       CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Closed' ELSE 'Reopened' END AS state,
       o_orderpriority AS losstype,
       CAST(o_orderdate AS STRING) AS lossdate,
       CAST(ROUND(o_totalprice * 100) AS BIGINT) AS reserve,
       CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS retired,
       CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE 0 END AS gwcbi___operation,
       CASE WHEN o_orderkey % 37 = 0 THEN 'Y' ELSE 'N' END AS Soft_Delete,
       CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 2 END AS CYC_RUN_SK,
       CAST(NULL AS STRING) AS Validation_Flag
FROM {orders}"""

# Change feed of transactions: several rows per id, unique once the order columns are added.
TXN_FEED = """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id,
       concat('pub:', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS publicid,
       l_orderkey AS claimid,
       l_extendedprice AS amount,
       CASE l_returnflag WHEN 'A' THEN 'claimcost' WHEN 'N' THEN 'aoexpense'
                         ELSE 'dccexpense' END AS costtype,
       CASE l_linenumber % 4 WHEN 0 THEN 'LossPayment' WHEN 1 THEN 'ExpensePayment'
                             WHEN 2 THEN 'LossReserve' ELSE 'ExpenseReserve' END AS costcategory,
       CASE WHEN l_orderkey % 50 = 0 THEN 1 ELSE 0 END AS retired,
       CASE WHEN l_orderkey % 41 = 0 THEN 1 ELSE 0 END AS gwcbi___operation,
       CASE WHEN l_orderkey % 41 = 0 THEN 'Y' ELSE 'N' END AS Soft_Delete,
       CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 2 END AS CYC_RUN_SK,
       CAST(l_shipdate AS STRING) AS shipdate,
       l_partkey AS partkey,
       l_suppkey AS suppkey
FROM {lineitem}"""
TXN_ORDER = ("shipdate", "partkey", "suppkey")

# Change feed per user: five operation codes, two schema versions, one delivery per day.
CDC = """
SELECT user_id AS id,
       event_type AS status,
       CAST(ROUND(value * 100) AS BIGINT) AS amount,
       CASE event_type WHEN 'signup' THEN 0 WHEN 'error' THEN 1 WHEN 'click' THEN 2
                       ELSE 4 END AS gwcbi___operation,
       CAST(ts AS STRING) AS gwcbi___payload_ts_ms,
       lpad(CAST(event_id AS STRING), 16, '0') AS gwcbi___seqval_hex,
       CASE WHEN event_id % 2 = 0 THEN 'aaaa' ELSE 'bbbb' END AS GW_FINGERPRINT,
       CAST(1704067200000 + 86400000 * CAST(day(ts) AS BIGINT) AS STRING) AS GW_TIMESTAMP,
       CASE WHEN day(ts) < 15 THEN 1 WHEN day(ts) < 23 THEN 2 ELSE 3 END AS phase
FROM {events}"""

# One delivery folder per event type and day, and control rows about them.
FILES = """
SELECT event_type AS table_name,
       md5(event_type) AS gw_fingerprint,
       CAST(1704067200000 + 86400000 * CAST(day(ts) AS BIGINT) AS STRING) AS gw_timestamp,
       'CC' AS xcenter,
       CAST(day(ts) AS INT) AS d,
       MIN(event_id) AS file_load_id,
       COUNT(*) AS n_rows
FROM {events}
GROUP BY event_type, day(ts)"""


def files_sql() -> str:
    return portable(FILES)
