"""Queries on versions: schema versions, rows read, folded states, purged history, nested drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import as_text, portable, query
from driver_queries.views import CDC
from tidemark import names as n
from tidemark.functions.nested import union_widened
from tidemark.operators.fold import latest_state, merge_states, state_at
from tidemark.operators.purge import purge_history
from tidemark.operators.versions import fingerprint_changed, rows_read, rows_read_now, schema_versions

# One delivery per event type, second and fingerprint; fingerprints come back, some are not known.
SECOND = "(1704067200 + 86400 * CAST(day(ts) AS BIGINT) + 3600 * CAST(hour(ts) AS BIGINT) + 60 * CAST(minute(ts) AS BIGINT) + CAST(second(ts) AS BIGINT))"
DELIVERIES = f"""
SELECT table_name, gw_timestamp, gw_fingerprint, MIN(event_id) AS file_load_id, COUNT(*) AS n_rows
FROM (SELECT event_type AS table_name, event_id, CAST(1000 * {SECOND} AS STRING) AS gw_timestamp,
             CASE WHEN event_id % 97 = 0 THEN NULL WHEN day(ts) BETWEEN 10 AND 14 THEN 'bbbb'
                  WHEN day(ts) > 24 AND event_type <> 'view' THEN 'cccc' ELSE 'aaaa' END AS gw_fingerprint
      FROM {{events}}) e
GROUP BY table_name, gw_timestamp, gw_fingerprint"""
LINE = "PARTITION BY table_name ORDER BY t, gw_fingerprint NULLS FIRST"


@query(
    "fingerprint_changed",
    f"""WITH d AS (SELECT *, CAST(gw_timestamp AS BIGINT) AS t FROM ({portable(DELIVERIES)}) x)
SELECT file_load_id, table_name, gw_timestamp, gw_fingerprint, lag(gw_fingerprint) OVER w AS previous_fingerprint,
       row_number() OVER w > 1 AND gw_fingerprint IS DISTINCT FROM lag(gw_fingerprint) OVER w AS fingerprint_changed
FROM d WINDOW w AS ({LINE})""",
)
def q_fingerprint_changed(t):
    return fingerprint_changed(t.sql(DELIVERIES)).select(
        "file_load_id", "table_name", "gw_timestamp", "gw_fingerprint", "previous_fingerprint", "fingerprint_changed"
    )


@query(
    "schema_versions",
    f"""WITH d AS (SELECT *, CAST(gw_timestamp AS BIGINT) AS t FROM ({portable(DELIVERIES)}) x),
m AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR gw_fingerprint IS DISTINCT FROM lag(gw_fingerprint) OVER w
                     THEN 1 ELSE 0 END AS b FROM d WINDOW w AS ({LINE})),
r AS (SELECT *, sum(b) OVER ({LINE}) AS version FROM m)
SELECT table_name, CAST(version AS INTEGER) AS version, gw_fingerprint, min(t) AS first_timestamp,
       max(t) AS last_timestamp, count(*) AS deliveries,
       row_number() OVER (PARTITION BY table_name, gw_fingerprint ORDER BY version) > 1 AS came_back
FROM r GROUP BY table_name, version, gw_fingerprint""",
)
def q_schema_versions(t):
    return schema_versions(t.sql(DELIVERIES))


# Manifest entries per event type and hour: cumulative counts, some missing, one table begun anew,
# and at seven o'clock two entries with one time.
ENTRIES = """
SELECT table_name, CAST(written AS STRING) AS written,
       CASE WHEN h = 11 THEN NULL ELSE CAST(total + extra AS STRING) END AS total, extra
FROM (SELECT event_type AS table_name, hour(ts) AS h, 3600000 * (24 * CAST(day(ts) AS BIGINT) + hour(ts)) AS written,
             CAST(SUM(COUNT(*)) OVER (PARTITION BY event_type, CASE WHEN event_type = 'error' AND day(ts) >= 20 THEN 1 ELSE 0 END
                                 ORDER BY day(ts), hour(ts)) AS BIGINT) AS total
      FROM {events} GROUP BY event_type, day(ts), hour(ts)) e
CROSS JOIN (SELECT 0 AS extra UNION ALL SELECT 1) x WHERE extra = 0 OR h = 7"""
READ = f"""e AS (SELECT *, CAST(written AS BIGINT) AS t, CAST(total AS BIGINT) AS n FROM ({portable(ENTRIES)}) x),
best AS (SELECT table_name, t, max(n) AS n FROM e GROUP BY table_name, t),
prev AS (SELECT table_name, t, lag(n IGNORE NULLS) OVER (PARTITION BY table_name ORDER BY t) AS p FROM best),
j AS (SELECT e.*, p FROM e JOIN prev ON e.table_name = prev.table_name AND e.t = prev.t),
r AS (SELECT table_name, written, extra, total, p AS previous_total, coalesce(n < p, false) AS restarted,
             CASE WHEN n < p THEN n ELSE n - coalesce(p, 0) END AS rows_read FROM j)"""


@query("manifest_rows_read", f"WITH {READ} SELECT * FROM r")
def q_rows_read(t):
    return rows_read(t.sql(ENTRIES))


@query(
    "manifest_rows_read_now",
    f"""WITH {READ} SELECT * FROM r WHERE extra = 0 AND (table_name, CAST(written AS BIGINT)) IN
  (SELECT (table_name, max(CAST(written AS BIGINT))) FROM r WHERE extra = 0 GROUP BY table_name)""",
)
def q_rows_read_now(t):
    """The newest entry of each table against the archive of all the earlier ones."""
    entries = t.stored(t.sql(ENTRIES), "entries")
    last = entries.where("extra = 0").groupBy("table_name").agg(F.max(F.col("written").cast("bigint")).alias("_last"))
    marked = entries.join(last, "table_name")
    newest = (F.col("written").cast("bigint") == F.col("_last")) & (F.col("extra") == 0)
    return rows_read_now(marked.where(newest).drop("_last"), marked.where(~newest).drop("_last"))


CUTOFFS = {k: 1704067200000 + 86400000 * d for k, d in (("early", 9), ("middle", 17), ("late", 31))}


@query(
    "latest_fold",
    f"WITH c AS ({portable(CDC)}) " + " UNION ALL ".join(
        f"""SELECT '{k}' AS at, id, status, amount, seq FROM (
  SELECT *, gwcbi___seqval_hex AS seq, row_number() OVER (PARTITION BY id
    ORDER BY GW_TIMESTAMP DESC, gwcbi___payload_ts_ms DESC, gwcbi___seqval_hex DESC) AS rn
  FROM c WHERE CAST(GW_TIMESTAMP AS BIGINT) <= {v}) x WHERE rn = 1""" for k, v in CUTOFFS.items()),
)
def q_latest_fold(t):
    """States per delivery, written once; two cut-off times from these, and the last one as a fold of
    the phases out of order, one of them twice."""
    feed = t.sql(CDC)
    states = t.stored(latest_state(feed, ["id"], per=[n.DELIVERY]), "states")
    found = {k: state_at(states, ["id"], v) for k, v in CUTOFFS.items() if k != "late"}
    phases = {p: latest_state(feed.where(F.col("phase") == p), ["id"]) for p in (1, 2, 3)}
    found["late"] = merge_states([phases[3], phases[1], phases[2], phases[1]], ["id"])
    rows = [
        df.select(F.lit(k).alias("at"), "id", "status", "amount", F.col(n.SEQUENCE).alias("seq")) for k, df in found.items()
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


# A version per order line; some say the same as the one before, some do not follow at once.
VERSIONS = f"""
SELECT id, sk, ETL_Key_Hash, ETL_SCD2_Hash,
       CASE WHEN v = k AND id % 3 <> 0 THEN 'Y' ELSE 'N' END AS ETL_ActiveRow_Flag,
       CAST(concat(CAST(2000 + v AS STRING), '-01-01 00:00:00') AS TIMESTAMP) AS ETL_RecordEffective_Date,
       CAST(CASE WHEN v = k AND id % 3 <> 0 THEN '{n.OPEN_END}'
                 WHEN (id + v) % 5 = 0 THEN concat(CAST(2000 + v AS STRING), '-07-01 00:00:00')
                 ELSE concat(CAST(2001 + v AS STRING), '-01-01 00:00:00') END AS TIMESTAMP) AS ETL_RecordExpiry_Date,
       CAST(concat(CAST(2000 + v AS STRING), '-01-01 01:00:00') AS TIMESTAMP) AS ETL_Created_Date
FROM (SELECT l_orderkey AS id, md5(CAST(l_orderkey AS STRING)) AS ETL_Key_Hash, md5(l_returnflag) AS ETL_SCD2_Hash,
             100 * l_orderkey + ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey) AS sk,
             ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey) AS v,
             COUNT(*) OVER (PARTITION BY l_orderkey) AS k
      FROM {{lineitem}}) x"""
PURGED = "2004-01-01 00:00:00"


@query(
    "purge_history",
    f"""WITH h AS (SELECT id, sk, ETL_SCD2_Hash AS c, ETL_ActiveRow_Flag AS f, CAST(ETL_RecordEffective_Date AS VARCHAR) AS a,
       CAST(ETL_RecordExpiry_Date AS VARCHAR) AS z, CAST(ETL_Created_Date AS VARCHAR) AS m FROM ({portable(VERSIONS)}) x),
b AS (SELECT *, CASE WHEN lag(c) OVER w = c AND lag(z) OVER w = a THEN 0 ELSE 1 END AS b FROM h WHERE f = 'N'
      WINDOW w AS (PARTITION BY id ORDER BY a)),
g AS (SELECT *, sum(b) OVER (PARTITION BY id ORDER BY a) AS g FROM b),
v AS (SELECT id, max(sk) AS sk, min(a) AS a, max(z) AS z, min(m) AS m FROM g GROUP BY id, g),
l AS (SELECT *, max(a) OVER (PARTITION BY id) AS la FROM v)
SELECT id, sk, 'N' AS {n.ACTIVE}, a AS {n.EFFECTIVE}, z AS {n.EXPIRY}, m AS {n.CREATED} FROM l WHERE z >= '{PURGED}' OR a = la
UNION ALL SELECT id, sk, f, a, z, m FROM h WHERE f = 'Y'""",
)
def q_purge(t):
    out = purge_history(t.stored(t.sql(VERSIONS), "versions"), PURGED)
    dates = (n.EFFECTIVE, n.EXPIRY, n.CREATED)
    return as_text(out.select("id", "sk", n.ACTIVE, *dates), *dates)


# Three versions of one table: a struct gains a field, another widens, the elements of an array and
# the values of a map do, and one version has a new column.
DRIFT_SQL = """
SELECT o_orderkey AS id, o_custkey AS who, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS kind,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS note,
       CASE WHEN o_orderkey % 3 = 1 THEN '' ELSE concat(CAST(o_custkey + CASE WHEN o_orderkey % 3 = 2 THEN 3000000000 ELSE 0 END AS STRING), ',') END AS items,
       CAST(o_custkey % 7 AS BIGINT) AS held, CASE WHEN o_orderkey % 3 = 2 THEN 'new' END AS added
FROM {orders}"""


@query("schema_nested_drift", portable(DRIFT_SQL).replace("STRING", "VARCHAR"))
def q_nested(t):
    who = "CAST(o_custkey AS INT)"
    kind = "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS kind"
    one = t.sql(f"SELECT o_orderkey AS id, struct({who} AS who, {kind}) AS s, array({who}) AS items, "
                f"map('held', CAST(o_custkey % 7 AS INT)) AS m FROM {{orders}} WHERE o_orderkey % 3 = 0")
    two = t.sql(f"SELECT o_orderkey AS id, struct({kind}, CAST(o_custkey AS BIGINT) AS WHO) AS s, "
                f"CAST(NULL AS array<int>) AS items, map('held', CAST(o_custkey % 7 AS SMALLINT)) AS m "
                f"FROM {{orders}} WHERE o_orderkey % 3 = 1")
    three = t.sql(f"SELECT o_orderkey AS id, struct({who} AS who, o_orderpriority AS note, {kind}) AS s, "
                  f"array(CAST(o_custkey AS BIGINT) + 3000000000) AS items, map('held', CAST(o_custkey % 7 AS BIGINT)) AS m, "
                  f"'new' AS added FROM {{orders}} WHERE o_orderkey % 3 = 2")
    rows = union_widened([one, two, three])
    items = F.concat_ws("", F.transform("items", lambda x: F.concat(x.cast("string"), F.lit(","))))
    return rows.select("id", "s.who", "s.kind", "s.note", items.alias("items"), F.col("m")["held"].alias("held"), "added")
