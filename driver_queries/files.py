"""Queries that write delivery folders from the events table and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from driver_queries.registry import Tables, portable, query
from driver_queries.views import CDC, FILES
from tidemark import names as n
from tidemark.operators.quality import bytes_reconcile
from tidemark.plans.parallel import for_each
from tidemark.session import hadoop_path
from tidemark.sources import deliveries
from tidemark.sources.manifest import read_manifest
from tidemark.sources.snapshot import SnapshotTable

RUN_TS = "2024-02-01 00:00:00"
CDC_CTE = f"cdc AS ({portable(CDC)})"


def feed(t: Tables):
    return t.sql(CDC).drop("phase")


def landing(t: Tables) -> str:
    """The change feed as delivery folders, written by one partitioned job."""
    root = t.scratch("landing")
    write_feed(feed(t), root)
    return root


def write_feed(rows, root: str) -> None:
    """Few files per delivery; a delivery that holds many of the rows is written by 8 tasks."""
    part = F.pmod(F.xxhash64(n.SEQUENCE), F.lit(8))
    spread = rows.repartition(F.col(n.FINGERPRINT), F.col(n.DELIVERY), part)
    spread.write.partitionBy(n.FINGERPRINT, n.DELIVERY).parquet(f"{root}/cc_user")


@query(
    "delivery_listing",
    f"""WITH {CDC_CTE}
SELECT DISTINCT 'cc_user' AS table_name, GW_FINGERPRINT AS gw_fingerprint, GW_TIMESTAMP AS gw_timestamp,
       concat('cc_user/', GW_FINGERPRINT, '/', GW_TIMESTAMP) AS cloud_path, 'CC' AS xcenter FROM cdc""",
)
def q_listing(t):
    return deliveries.list_deliveries(t.spark, landing(t), "CC")


@query(
    "folder_bytes",
    f"""WITH {CDC_CTE}
SELECT DISTINCT 'cc_user' AS table_name, GW_FINGERPRINT AS gw_fingerprint, GW_TIMESTAMP AS gw_timestamp,
       true AS filled, true AS agrees FROM cdc""",
)
def q_bytes(t):
    """Folder sizes from the listing, held against the bytes that the files hold when they are read."""
    root = landing(t)
    sizes = deliveries.folder_bytes(t.spark, root)
    files = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    part = lambda name: F.regexp_extract("path", f"{name}=([^/]+)/", 1)
    held = files.groupBy(part(n.FINGERPRINT).alias("gw_fingerprint"), part(n.DELIVERY).alias("gw_timestamp")).agg(
        F.count(F.lit(1)).alias("_files"), F.sum(F.octet_length("content")).alias("_bytes")
    )
    agrees = (F.col("files") == F.col("_files")) & (F.col("bytes") == F.col("_bytes"))
    return sizes.join(held, ["gw_fingerprint", "gw_timestamp"], "left").select(
        "table_name", "gw_fingerprint", "gw_timestamp", (F.col("bytes") > 0).alias("filled"),
        F.coalesce(agrees, F.lit(False)).alias("agrees"),
    )


@query(
    "bytes_reconcile",
    f"""WITH {CDC_CTE}, ends AS (SELECT min(GW_TIMESTAMP) AS lost, max(GW_TIMESTAMP) AS cut FROM cdc WHERE GW_FINGERPRINT = 'aaaa')
SELECT DISTINCT GW_FINGERPRINT AS gw_fingerprint, GW_TIMESTAMP AS gw_timestamp,
       CASE WHEN GW_FINGERPRINT = 'aaaa' AND GW_TIMESTAMP IN (lost, cut) THEN 'F' ELSE 'S' END AS status,
       GW_FINGERPRINT = 'aaaa' AND GW_TIMESTAMP = lost AS nothing_there FROM cdc, ends""",
)
def q_bytes_reconcile(t):
    """A landing zone and its copy, of which one folder was lost and one holds a row only."""
    source, target = landing(t), t.scratch("copy")
    fs, there = hadoop_path(t.spark, source)
    here = hadoop_path(t.spark, target)[1]
    assert t.spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, there, fs, here, False, t.spark._jsc.hadoopConfiguration())
    times = feed(t).filter(F.col(n.FINGERPRINT) == "aaaa").agg(F.min(n.DELIVERY).alias("lost"), F.max(n.DELIVERY).alias("cut")).first()
    at = lambda time: f"{target}/cc_user/{n.FINGERPRINT}=aaaa/{n.DELIVERY}={time}"
    fs.delete(hadoop_path(t.spark, at(times["lost"]))[1], True)
    feed(t).limit(1).drop(n.FINGERPRINT, n.DELIVERY).write.mode("overwrite").parquet(at(times["cut"]))
    out = bytes_reconcile(deliveries.folder_bytes(t.spark, source), deliveries.folder_bytes(t.spark, target))
    return out.select("gw_fingerprint", "gw_timestamp", "status", (F.col("data_written") == 0).alias("nothing_there"))


@query("catalog_table", "SELECT o_orderstatus AS status, count(*) AS n_rows FROM orders GROUP BY o_orderstatus")
def q_catalog(t):
    """A first load is written, registered in the catalog, and read by SQL under its name."""
    store, name = SnapshotTable(t.spark, t.scratch("initial")), f"initial_{uuid.uuid4().hex}"
    store.write(t.table("orders"))
    store.save_as_table(name)
    return t.spark.sql(f"SELECT o_orderstatus AS status, count(*) AS n_rows FROM {name} GROUP BY o_orderstatus")


FEED = "id, status, amount, gwcbi___operation, gwcbi___seqval_hex, GW_FINGERPRINT, GW_TIMESTAMP"
FEED_COLUMNS = [c.strip() for c in FEED.split(",")]


@query("scan_glob", f"WITH {CDC_CTE} SELECT {FEED} FROM cdc")
def q_glob(t):
    return deliveries.read_raw(t.spark, landing(t), "cc_user").select(*FEED_COLUMNS)


@query("scan_pruned", f"WITH {CDC_CTE} SELECT {FEED} FROM cdc WHERE GW_FINGERPRINT = 'bbbb'")
def q_pruned(t):
    zone = deliveries.read_zone(t.spark, landing(t), "cc_user")
    return zone.filter(F.col(n.FINGERPRINT) == "bbbb").select(*FEED_COLUMNS)


@query(
    "scan_folders",
    f"""WITH {CDC_CTE} SELECT {FEED} FROM cdc WHERE GW_FINGERPRINT = 'aaaa'
AND GW_TIMESTAMP >= '1705190400000'""",
)
def q_folders(t):
    root = landing(t)
    listed = deliveries.list_deliveries(t.spark, root, "CC")
    wanted = listed.filter("gw_fingerprint = 'aaaa' and gw_timestamp >= '1705190400000'")
    paths = [
        deliveries.folder(root, "cc_user", r["gw_fingerprint"], r["gw_timestamp"], raw=True)
        for r in wanted.collect()
    ]
    return deliveries.read_folders(t.spark, paths).select(*FEED_COLUMNS)


@query(
    "scan_merged_schema",
    f"""WITH {CDC_CTE} SELECT id, CASE WHEN GW_FINGERPRINT = 'aaaa' THEN status END AS status,
       amount, GW_FINGERPRINT FROM cdc""",
)
def q_merged(t):
    root = t.scratch("merged")
    for fingerprint in ("aaaa", "bbbb"):
        rows = feed(t).filter(F.col(n.FINGERPRINT) == fingerprint).drop(n.FINGERPRINT, n.DELIVERY)
        rows = rows if fingerprint == "aaaa" else rows.drop("status")
        deliveries.write_delivery(rows, root, "cc_user", fingerprint, "1704067200000")
    merged = deliveries.read_raw(t.spark, root, "cc_user", merge_schema=True)
    return merged.select("id", "status", "amount", n.FINGERPRINT)


LOST = "CAST(1704067200000 + 86400000 * 9 AS VARCHAR)"


@query(
    "land_to_raw",
    f"""WITH {CDC_CTE} SELECT GW_FINGERPRINT AS gw_fingerprint, GW_TIMESTAMP AS gw_timestamp,
       count(*) AS rows_read, CASE WHEN GW_TIMESTAMP = {LOST} THEN 0 ELSE count(*) END AS rows_written,
       CASE WHEN GW_TIMESTAMP = {LOST} THEN 'F' ELSE 'S' END AS status FROM cdc GROUP BY 1, 2""",
)
def q_land(t):
    """The deliveries of one day do not arrive, and are found out."""
    source, raw = t.scratch("source"), t.scratch("raw")
    rows = t.stored(feed(t), "feed")
    found = rows.select(n.FINGERPRINT, n.DELIVERY).distinct().collect()  # two a day at most
    pairs = sorted((r[0], r[1]) for r in found)

    def deliver(pair):
        own = rows.filter((F.col(n.FINGERPRINT) == pair[0]) & (F.col(n.DELIVERY) == pair[1]))
        deliveries.write_delivery(own.drop(n.FINGERPRINT, n.DELIVERY), source, "cc_user", *pair)

    for_each(t.spark, deliver, pairs)
    day = str(1704067200000 + 86400000 * 9)
    deliveries.land_to_raw(t.spark, [p for p in pairs if p[1] != day], source, raw, "cc_user")
    return deliveries.rows_reconcile(
        deliveries.folder_rows(deliveries.read_raw(t.spark, source, "cc_user")),
        deliveries.folder_rows(deliveries.read_zone(t.spark, raw, "cc_user")),
    )


@query(
    "manifest_explode",
    f"""SELECT concat('CC/', upper(table_name)) AS datafilespath,
       max(gw_timestamp) AS lastsuccessfulwritetimestamp, CAST(sum(n_rows) AS VARCHAR) AS totalprocessedrecordscount,
       max(gw_fingerprint) AS fingerprint, min(gw_timestamp) AS first_seen, 'CC' AS xcenter,
       '{RUN_TS}' AS audit_dt_tm, 2 AS cyc_run_sk
FROM ({portable(FILES)}) f GROUP BY table_name""",
)
def q_manifest(t):
    path = t.scratch("manifest")
    entry = F.struct(
        F.concat(F.lit("CC/"), F.upper("table_name")).alias("dataFilespath"),
        F.max("gw_timestamp").alias("lastSuccessfulWriteTimestamp"),
        F.create_map(F.max("gw_fingerprint"), F.min("gw_timestamp")).alias("schemaHistory"),
        F.sum("n_rows").cast("string").alias("totalProcessedRecordsCount"),
    )
    tables = t.sql(FILES).groupBy("table_name").agg(entry.alias("entry"))
    # One small object for the whole landing zone: an entry per event type.
    whole = tables.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("table_name", "entry")))).alias("value")
    )
    whole.write.text(path)
    out = read_manifest(t.spark, path, "CC", 2, RUN_TS)
    history = F.map_entries("schemahistory")
    return out.select(
        "datafilespath", "lastsuccessfulwritetimestamp", "totalprocessedrecordscount",
        F.element_at(history, 1)["key"].alias("fingerprint"),
        F.element_at(history, 1)["value"].alias("first_seen"),
        "xcenter", "audit_dt_tm", "cyc_run_sk",
    )


@query(
    "snapshot_overwrite",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE o_orderstatus END AS state
FROM orders""",
)
def q_snapshot(t):
    store = SnapshotTable(t.spark, t.scratch("snapshot"))
    store.write(t.sql("SELECT o_orderkey AS id, o_orderstatus AS state FROM {orders}"))
    current = store.read()
    open_ = F.col("state") == "O"
    return store.write(current.withColumn("state", F.when(open_, "open").otherwise(F.col("state"))))


@query(
    "snapshot_initial_or_append",
    "SELECT r_name AS name FROM region UNION ALL SELECT n_name FROM nation",
)
def q_append(t):
    store = SnapshotTable(t.spark, t.scratch("append"))
    assert not store.exists()
    store.append(t.sql("SELECT r_name AS name FROM {region}"))
    return store.append(t.sql("SELECT n_name AS name FROM {nation}"))
