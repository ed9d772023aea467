"""Replication over several runs: what a run leaves behind, schema changes, failures."""

import pytest
from helpers import rows

from tidemark import names as n
from tidemark.functions.schema import align_target_to_source, is_lossless
from tidemark.plans.replicate import failed_job, replicate, waiting_tables
from tidemark.plans.warehouse import Warehouse
from tidemark.sources import deliveries

CDC = f"{n.OPERATION} int, {n.PAYLOAD_TS} bigint, {n.SEQUENCE} string"


def land(spark, wh, table, fingerprint, ts, data, schema, run):
    frame = spark.createDataFrame([(*e, f"{e[-1]:016x}") for e in data], f"{schema}, {CDC}")
    folder = deliveries.folder(wh.raw, table, fingerprint, str(ts), raw=True)
    frame.write.parquet(folder)
    wh.control("raw_table_load").append(
        spark.createDataFrame([(table.upper(), fingerprint, str(ts), "", "CC", run)],
                              "table_name string, gw_fingerprint string, gw_timestamp string,"
                              " cloud_path string, xcenter string, cyc_run_sk int")
    )


def test_deliveries_of_a_failed_run_are_taken_up(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    land(spark, wh, "cc_a", "f", 1000, [("a", "1", 0, 1)], "id string, v string", 1)
    assert replicate(wh, "cc_a", 1, "2024-01-01 00:00:00", "CC").first()["status"] == "S"
    assert waiting_tables(wh, "CC") == []
    land(spark, wh, "cc_a", "f", 2000, [("b", "2", 0, 2)], "id string, v string", 2)
    land(spark, wh, "cc_a", "f", 3000, [("c", "3", 0, 3)], "id string, v string", 3)
    land(spark, wh, "cc_b", "f", 3000, [("x", "3", 0, 3)], "id string, v string", 3)
    assert waiting_tables(wh, "CC") == ["cc_a", "cc_b"] and waiting_tables(wh, "PC") == []
    done = replicate(wh, "cc_a", 3, "2024-01-03 00:00:00", "CC").first()
    assert (done["status"], done["rows_read"], done["rows_inserted"]) == ("S", 2, 2)
    assert rows(wh.replica("cc_a").read(), "id", "v") == [("a", "1"), ("b", "2"), ("c", "3")]
    assert waiting_tables(wh, "CC") == ["cc_b"]
    with pytest.raises(LookupError):
        replicate(wh, "cc_a", 4, "2024-01-04 00:00:00", "CC")


def test_spatial_column_over_two_runs(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    column = n.SPATIAL_COLUMNS[0]
    schema = f"id string, {column} struct<wkb:binary,srid:int>"
    land(spark, wh, "cc_s", "f", 1000, [("a", (b"\x01\x02", 4), 0, 1)], schema, 1)
    replicate(wh, "cc_s", 1, "2024-01-01 00:00:00", "CC")
    land(spark, wh, "cc_s", "f", 2000, [("b", (b"\x0a", 4), 0, 2), ("c", None, 0, 3)], schema, 2)
    replicate(wh, "cc_s", 2, "2024-01-02 00:00:00", "CC")
    assert rows(wh.replica("cc_s").read(), "id", column) == [("a", "0102"), ("b", "0A"), ("c", None)]


def test_narrowing_is_refused(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    land(spark, wh, "cc_n", "f", 1000, [("a", "hello", 0, 1)], "id string, v string", 1)
    replicate(wh, "cc_n", 1, "2024-01-01 00:00:00", "CC")
    land(spark, wh, "cc_n", "g", 2000, [("b", 7, 0, 2)], "id string, v int", 2)
    with pytest.raises(ValueError, match="v: string to int"):
        replicate(wh, "cc_n", 2, "2024-01-02 00:00:00", "CC")
    assert waiting_tables(wh, "CC") == ["cc_n"]
    assert rows(wh.replica("cc_n").read(), "id", "v") == [("a", "hello")]
    replicate(wh, "cc_n", 2, "2024-01-02 00:00:00", "CC", compat=True)
    assert rows(wh.replica("cc_n").read(), "id", "v") == [("a", None), ("b", 7)]


def test_failed_job_row(spark, tmp_path):
    row = failed_job(Warehouse(spark, str(tmp_path)), "cc_a", RuntimeError("no luck"), 5).first()
    assert (row["table_name"], row["status"], row["error_msg"], row["job_sk"]) == ("cc_a", "F", "no luck", 5)


@pytest.mark.parametrize("have, want, fits", [
    ("int", "bigint", True), ("bigint", "int", False), ("int", "double", True), ("bigint", "double", False),
    ("decimal(10,2)", "decimal(12,2)", True), ("decimal(10,2)", "decimal(12,4)", True),
    ("decimal(10,2)", "decimal(10,4)", False), ("int", "decimal(10,0)", True), ("date", "timestamp", True),
    ("timestamp", "date", False), ("double", "string", True), ("string", "int", False), ("float", "double", True),
])
def test_lossless(spark, have, want, fits):
    types = spark.createDataFrame([], f"a {have}, b {want}").schema
    assert is_lossless(types["a"].dataType, types["b"].dataType) is fits
    old, new = spark.createDataFrame([], f"x {have}"), spark.createDataFrame([], f"x {want}")
    if fits:
        assert align_target_to_source(old, new, compat=False).schema["x"].dataType == types["b"].dataType
