import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.columns import last_segment, path_segment, spatial_to_hex
from tidemark.functions.schema import align_to_target, type_changes, union_aligned
from tidemark.session import Staging, data_bytes, fits_broadcast, has_at_most
from tidemark.sources import deliveries
from tidemark.sources.jdbc import jdbc_options
from tidemark.sources.manifest import read_manifest
from tidemark.sources.snapshot import VERSION, HistoryTable, LogTable, SnapshotTable


def deliver(spark, root, fingerprint, ts, data, columns="id int, v string"):
    deliveries.write_delivery(spark.createDataFrame(data, columns), root, "cc_a", fingerprint, ts)


def test_read_listing_and_landing(spark, tmp_path):
    root, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    deliver(spark, root, "1e5", "0100", [(1, "a")])
    deliver(spark, root, "1e5", "0200", [(2, "b"), (3, "c")])
    deliver(spark, root, "ff", "0300", [(4, 2.5)], "id int, w double")
    listed = deliveries.list_deliveries(spark, root, "CC")
    assert rows(listed, "cloud_path") == [("cc_a/1e5/0100",), ("cc_a/1e5/0200",), ("cc_a/ff/0300",)]
    assert "content" not in plan(listed)
    assert deliveries.list_deliveries(spark, root, "CC", ["cc_a", "absent"]).count() == 3
    assert deliveries.list_deliveries(spark, root, "CC", ["absent"]).count() == 0
    last = max(int(r["gw_timestamp"]) for r in listed.filter("table_name = 'cc_a'").collect())
    newer = deliveries.list_deliveries(spark, root, "CC", ["cc_a"], {"cc_a": last - 1})
    assert {int(r["gw_timestamp"]) for r in newer.collect()} == {last}
    assert deliveries.list_deliveries(spark, root, "CC", ["cc_a"], {"cc_a": last}).count() == 0
    both = deliveries.read_raw(spark, root, "cc_a", merge_schema=True)
    assert rows(both, "id", "v", "w", n.FINGERPRINT, n.DELIVERY) == [
        (1, "a", None, "1e5", "0100"), (2, "b", None, "1e5", "0200"),
        (3, "c", None, "1e5", "0200"), (4, None, 2.5, "ff", "0300"),
    ]
    pairs = [("1e5", "0100"), ("1e5", "0200"), ("ff", "0300")]
    for _ in range(2):  # a repeated landing does not double rows
        deliveries.land_to_raw(spark, pairs, root, raw, "cc_a")
    zone = deliveries.read_zone(spark, raw, "cc_a")
    assert rows(zone, "id", n.FINGERPRINT, n.DELIVERY) == [
        (1, "1e5", "0100"), (2, "1e5", "0200"), (3, "1e5", "0200"), (4, "ff", "0300"),
    ]
    pruned = zone.filter(F.col(n.FINGERPRINT) == "ff")
    assert "PartitionFilters: [isnotnull(GW_FINGERPRINT" in plan(pruned)
    one = deliveries.read_folders(spark, [deliveries.folder(raw, "cc_a", "1e5", "0200", raw=True)])
    assert rows(one, "id", n.FINGERPRINT, n.DELIVERY) == [(2, "1e5", "0200"), (3, "1e5", "0200")]
    counts = deliveries.folder_rows(both)
    assert rows(deliveries.rows_reconcile(counts, deliveries.folder_rows(zone)), "status") == [("S",)] * 3
    short = deliveries.folder_rows(zone.filter("id <> 2"))
    assert rows(deliveries.rows_reconcile(counts, short), "gw_timestamp", "status")[1] == ("0200", "F")
    sizes = deliveries.folder_bytes(spark, root)
    assert sizes.count() == 3 and sizes.filter("bytes <= 0").count() == 0


def test_path_parts(spark):
    df = spark.createDataFrame([("s3://x/cc_a/f1/100/p.parquet",), ("s3://x/cc_a/GW_FINGERPRINT=f1/GW_TIMESTAMP=100/p.parquet",)], "p string")
    assert rows(df.select(path_segment(F.col("p"), 3), path_segment(F.col("p"), 2))) == [("f1", "100")] * 2
    df = spark.createDataFrame([("CC/cc_claim",), ("plain",)], "p string")
    assert rows(df.select(last_segment(F.col("p")))) == [("CC_CLAIM",), ("PLAIN",)]


def test_manifest(spark, tmp_path):
    path = tmp_path / "manifest.json"
    path.write_text(
        '{\n "CC_A": {"dataFilespath": "CC/CC_A", "lastSuccessfulWriteTimestamp": "20",\n'
        '  "schemaHistory": {"f1": "1", "f2": "9"}, "totalProcessedRecordsCount": "7"},\n'
        ' "CC_B": {"dataFilespath": "CC/CC_B", "lastSuccessfulWriteTimestamp": "5", "schemaHistory": {}}\n}'
    )
    out = read_manifest(spark, str(path), "CC", 3, "2024-01-01 10:00:00")
    assert rows(out, "datafilespath", "lastsuccessfulwritetimestamp", "totalprocessedrecordscount", "audit_dt_tm", "cyc_run_sk") == [
        ("CC/CC_A", "20", "7", "2024-01-01 10:00:00", 3), ("CC/CC_B", "5", None, "2024-01-01 10:00:00", 3),
    ]
    assert out.filter("datafilespath = 'CC/CC_A'").first()["schemahistory"] == {"f1": "1", "f2": "9"}


def test_snapshot_versions(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"))
    assert not store.exists()
    with pytest.raises(FileNotFoundError):
        store.read()
    empty = spark.createDataFrame([], "id int")
    assert store.read_or(empty).count() == 0
    store.write(spark.range(3))
    store.write(store.read().withColumn("id", F.col("id") + 1))  # reads what it replaces
    assert rows(store.read()) == [(1,), (2,), (3,)]
    assert rows(store.read(1)) == [(0,), (1,), (2,)]
    store.append(spark.range(10, 11))
    assert rows(store.read()) == [(1,), (10,), (2,), (3,)]
    assert store.versions() == [2, 3]


def test_unfinished_snapshot_is_not_seen(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"))
    store.write(spark.range(2))
    broken = tmp_path / "t" / "v=2"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("half a file")
    assert store.read().count() == 2
    store.write(spark.range(5))
    assert store.versions() == [1, 3] and store.read().count() == 5


def test_partitioned_snapshot_prunes(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"), partition_by=[n.ACTIVE])
    store.write(spark.createDataFrame([(1, "Y"), (2, "N")], f"id int, {n.ACTIVE} string"))
    active = store.read().filter(F.col(n.ACTIVE).eqNullSafe(F.lit("Y")))
    assert rows(active, "id") == [(1,)]
    assert "PartitionFilters: [(ETL_ActiveRow_Flag" in plan(active)


def test_snapshot_in_the_catalog(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"))
    store.write(spark.range(4))
    store.save_as_table("snap_cat")
    assert spark.catalog.tableExists("snap_cat") and spark.table("snap_cat").count() == 4
    spark.sql("DROP TABLE snap_cat")
    assert store.read().count() == 4


def test_staging(spark):
    with Staging(spark) as staging:
        kept = staging.put(spark.range(5), "x")
        assert kept.count() == 5
        assert has_at_most(kept, 5) and not has_at_most(kept, 4)
        assert fits_broadcast(kept) and not fits_broadcast(kept, rows=4)
        wide = spark.createDataFrame([("x" * 1000, [1, 2]), (None, None)], "s string, a array<int>")
        assert data_bytes(wide) == 1000 + len('{"a":[1,2]}') + len("{}") + 4 * 16
        assert not fits_broadcast(wide, limit=1000)
        assert data_bytes(wide.limit(0)) == 0
    with pytest.raises(Exception):
        spark.read.parquet(f"{staging.root}/x")


def test_jdbc_options():
    assert jdbc_options("u", "t") == {"url": "u", "dbtable": "t", "queryTimeout": "60", "fetchsize": "10000"}
    assert jdbc_options("u", "select 1", is_query=True)["query"] == "select 1"
    split = jdbc_options("u", "select 1 a", is_query=True, split=("a", 0, 10, 4))
    assert split["dbtable"] == "(select 1 a) split_source" and split["numPartitions"] == "4"
    assert "query" not in split


def test_spatial_columns(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('wkb', X'0AFF', 'srid', 4326) AS SpatialPoint, "
                   "CAST(NULL AS struct<wkb:binary,srid:int>) AS spatialpointdenorm")
    assert rows(spatial_to_hex(df)) == [(1, "0AFF", None)]


def test_schema_alignment(spark):
    old = spark.createDataFrame([(1, 5, "x")], "id int, a int, only_old string")
    new = spark.createDataFrame([(2, "7", 1.5)], "id int, A string, b double")
    both = union_aligned([old, new])
    assert both.columns == ["id", "A", "b", "only_old"]
    assert rows(both) == [(1, "5", None, "x"), (2, "7", 1.5, None)]
    assert set(type_changes(new, old.schema)) == {"A"}
    back = align_to_target(new, old)
    assert dict(back.dtypes)["A"] == "int" and rows(back, "A") == [(7,)]
    assert align_to_target(old, old) is old


def versions(spark, *data, columns="id int, v string"):
    return spark.createDataFrame(list(data), f"{columns}, {n.ACTIVE} string")


def test_history_writes_closed_versions_once(spark, tmp_path):
    store = HistoryTable(spark, str(tmp_path / "h"), n.ACTIVE)
    assert not store.exists()
    store.write_all(versions(spark, (1, "a", "Y"), (2, "b", "Y"), (3, "c", "N")))
    store.write_step(versions(spark, (1, "a", "N"), (1, "A", "Y"), (2, "b", "Y")))
    wide = versions(spark, (1, "A", "x", "N"), (1, "AA", "x", "Y"), (2, "b", None, "Y"), columns="id int, v string, w string")
    store.write_step(wide)
    expected = [
        (1, "A", "x", "N"), (1, "AA", "x", "Y"), (1, "a", None, "N"), (2, "b", None, "Y"), (3, "c", None, "N"),
    ]
    assert rows(store.read()) == expected
    assert "Union" not in plan(store.read())
    active = store.read().filter(F.col(n.ACTIVE).eqNullSafe(F.lit("Y")))
    assert "PartitionFilters: [(ETL_ActiveRow_Flag" in plan(active)
    store.compact()
    assert rows(store.read()) == expected
    store.write_step(versions(spark, (2, "b", None, "Y"), columns="id int, v string, w string"))
    left = sorted(p.name for p in (tmp_path / "h").iterdir() if p.name.startswith(f"{VERSION}="))
    assert left == [f"{VERSION}=4-full", f"{VERSION}=5"]
    assert rows(store.read().filter("ETL_ActiveRow_Flag = 'Y'"), "id") == [(2,)]


def test_history_ignores_unfinished_versions_and_allows_empty_ones(spark, tmp_path):
    store = HistoryTable(spark, str(tmp_path / "h"), n.ACTIVE)
    with pytest.raises(FileNotFoundError):
        store.read()
    store.write_all(versions(spark))
    assert store.read().count() == 0
    store.write_step(versions(spark, (1, "a", "Y")))
    broken = tmp_path / "h" / "version=3" / f"{n.ACTIVE}=N"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("half a file")
    assert rows(store.read(), "id") == [(1,)]
    store.write_step(versions(spark, (1, "a", "N"), (1, "b", "Y")))
    assert rows(store.read(), "v", n.ACTIVE) == [("a", "N"), ("b", "Y")]


def test_history_with_a_column_named_version(spark, tmp_path):
    store = HistoryTable(spark, str(tmp_path / "h"), n.ACTIVE)
    columns = f"id int, version string, {n.ACTIVE} string"
    store.write_all(spark.createDataFrame([(1, "a7", "Y"), (2, "b", "N")], columns))
    store.write_step(spark.createDataFrame([(1, "a7", "N"), (1, "a8", "Y")], columns))
    assert rows(store.read()) == [(1, "a7", "N"), (1, "a8", "Y"), (2, "b", "N")]
    clash = spark.createDataFrame([(1, "x", "Y")], f"id int, {VERSION} string, {n.ACTIVE} string")
    with pytest.raises(ValueError, match=VERSION):
        store.write_step(clash)


def test_log_table_appends_without_rewriting(spark, tmp_path):
    log = LogTable(spark, str(tmp_path / "log"))
    empty = spark.createDataFrame([], "id int")
    assert not log.exists() and log.read_or(empty).count() == 0
    log.append(spark.createDataFrame([(1,)], "id int"))
    before = {p for p in (tmp_path / "log").rglob("*.parquet")}
    log.append(spark.createDataFrame([(1,), (2,)], "id int"))
    (tmp_path / "log" / "rows-unfinished").mkdir()
    assert rows(log.read()) == [(1,), (1,), (2,)]
    assert before < {p for p in (tmp_path / "log").rglob("*.parquet")}


def test_leftovers_of_failed_writes_go(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "s"))
    store.write(spark.range(1))
    (tmp_path / "s" / "v=2").mkdir()
    store.write(spark.range(2))
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["v=1", "v=3"]
