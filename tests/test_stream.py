"""Replication as a stream."""

import pytest
from helpers import rows

from tidemark import names as n
from tidemark.plans.replicate import replicate, waiting_deliveries
from tidemark.plans.warehouse import Warehouse
from tidemark.sources import deliveries
from tidemark.streaming import replicate as stream
from tidemark.streaming.replicate import apply_batch, delivery_stream, replicate_stream

CDC = f"{n.OPERATION} int, {n.PAYLOAD_TS} bigint, {n.SEQUENCE} string"
OLD, NEW = f"id string, v int, {CDC}", f"id string, v int, {CDC}, w string"
TS = "2024-01-01 00:00:00"


def land(wh, fingerprint, ts, data, schema):
    """A delivery in the raw zone, and its row in the landing log."""
    path = deliveries.folder(wh.raw, "t", fingerprint, str(ts), raw=True)
    wh.spark.createDataFrame(data, schema).write.parquet(path)
    wh.control("raw_table_load").append(
        wh.spark.createDataFrame(
            [("T", fingerprint, str(ts), path, "CC", 1)],
            "table_name string, gw_fingerprint string, gw_timestamp string, cloud_path string, xcenter string, cyc_run_sk int",
        )
    )


def shown(wh):
    return rows(wh.replica("t").read(), "id", "v", *(["w"] if "w" in wh.replica("t").read().columns else []), n.SOFT_DELETE, n.RUN)


def test_new_folders_of_two_schemas(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    land(wh, "fa", 1000, [("a", 1, 2, 1, "01"), ("b", 1, 2, 1, "02")], OLD)
    assert replicate_stream(wh, "t", lambda b: b + 1, TS, "CC") == [0]
    assert replicate_stream(wh, "t", lambda b: b + 1, TS, "CC") == []
    land(wh, "fa", 2000, [("a", 2, 4, 2, "03")], OLD)
    land(wh, "fb", 3000, [("b", 3, 1, 3, "04", "x"), ("c", 3, 2, 3, "05", "y")], NEW)
    assert replicate_stream(wh, "t", lambda b: b + 1, TS, "CC") == [1]
    assert [r[:3] for r in shown(wh)] == [("a", 2, None), ("b", 1, None), ("c", 3, "y")]
    assert waiting_deliveries(wh, "CC").count() == 0  # the batch job has nothing left to do


def test_stream_equals_the_batch_job(spark, tmp_path):
    one, two = Warehouse(spark, f"{tmp_path}/a"), Warehouse(spark, f"{tmp_path}/b")
    steps = [
        [("fa", 1000, [("a", 1, 2, 1, "01"), ("b", 1, 2, 1, "02")], OLD)],
        [("fa", 2000, [("a", 2, 4, 2, "03"), ("b", 1, 1, 2, "04")], OLD), ("fb", 3000, [("c", 3, 2, 3, "05", "y")], NEW)],
        [("fb", 4000, [("c", 4, 1, 4, "06", "y"), ("b", 5, 2, 4, "07", "z")], NEW)],
    ]
    for run, step in enumerate(steps, 1):
        for wh in (one, two):
            for delivery in step:
                land(wh, *delivery)
        replicate_stream(one, "t", lambda b: b + 1, TS, "CC")
        replicate(two, "t", run, TS, "CC")
        assert shown(one) == shown(two)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    land(wh, "fa", 1000, [("a", 1, 2, 1, "01")], OLD)
    batch = spark.createDataFrame([("fa", "1000")], f"{n.FINGERPRINT} string, {n.DELIVERY} string")
    assert apply_batch(wh, "t", batch, 0, 1, TS, "CC")
    before, versions = shown(wh), wh.replica("t").versions()
    assert not apply_batch(wh, "t", batch, 0, 1, TS, "CC")
    assert (shown(wh), wh.replica("t").versions()) == (before, versions)
    assert wh.control("replica_load").read().count() == 1


def test_a_batch_whose_log_row_was_lost_is_logged(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path))
    land(wh, "fa", 1000, [("a", 1, 2, 1, "01")], OLD)
    batch = spark.createDataFrame([("fa", "1000")], f"{n.FINGERPRINT} string, {n.DELIVERY} string")
    real = stream.apply_deliveries

    def dies(*args, **kwargs):
        real(*args, **kwargs)
        raise OSError("lost")

    monkeypatch.setattr(stream, "apply_deliveries", dies)
    with pytest.raises(OSError):
        apply_batch(wh, "t", batch, 0, 1, TS, "CC")
    monkeypatch.setattr(stream, "apply_deliveries", real)
    assert not apply_batch(wh, "t", batch, 0, 1, TS, "CC")
    assert wh.control("replica_load").read().count() == 1


def test_the_stream_reads_no_column(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    land(wh, "fa", 1000, [("a", 1, 2, 1, "01")], OLD)
    assert delivery_stream(wh, "t", most_files=1).columns == [n.FINGERPRINT, n.DELIVERY]
    assert replicate_stream(wh, "t", lambda b: b + 1, TS, "CC", most_files=1)  # an empty file is a batch without rows
