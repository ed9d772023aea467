"""Bucket tables: what a write touches, and what it leaves alone."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.sources import buckets
from tidemark.sources.buckets import BUCKET, WRITE, BucketTable

COLUMNS = "id string, v string"


def files(path):
    return {str(p) for p in path.rglob("*.parquet")}


def test_only_changed_buckets_are_written(spark, tmp_path):
    store = BucketTable(spark, str(tmp_path / "t"), buckets=8)
    assert not store.exists()
    first = [(str(k), "a") for k in range(60)] + [(None, "n")]
    assert rows(store.write(spark.createDataFrame(first, COLUMNS))) == sorted(first, key=repr)
    before = files(tmp_path)
    change = spark.createDataFrame([("7", "b"), ("new", "c")], COLUMNS)
    touched = store.touched(change)
    assert 1 <= len(touched) <= 2
    part = store.read(touched).filter("id <> '7'").unionByName(change)
    store.write_buckets(part, touched)
    expected = [(k, "b" if k == "7" else v) for k, v in first] + [("new", "c")]
    assert rows(store.read()) == sorted(expected, key=repr)
    assert rows(store.read(version=1)) == sorted(first, key=repr)
    assert before < files(tmp_path)
    added = files(tmp_path) - before
    assert {int(p.split(f"{BUCKET}=")[1].split("/")[0]) for p in added} == set(touched)


def test_emptied_buckets_new_columns_and_cleaning(spark, tmp_path):
    store = BucketTable(spark, str(tmp_path / "t"), buckets=4)
    store.write(spark.createDataFrame([(str(k), "a") for k in range(20)], COLUMNS))
    wide = f"{COLUMNS}, w int"
    store.write_buckets(spark.createDataFrame([], wide), [0])
    left = store.read()
    assert left.columns == ["id", "v", "w"] and 0 < left.count() < 20
    assert store.touched(left) == [1, 2, 3] and store.read([0]).count() == 0
    (tmp_path / "t" / f"{WRITE}=3").mkdir()  # a write that failed
    store.write_buckets(spark.createDataFrame([("x", "y", 1)], wide), store.touched(spark.createDataFrame([("x",)], "id string")))
    store.write(store.read())
    names = sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith("."))
    assert names == ["state-4.json", "state-5.json", f"{WRITE}=1", f"{WRITE}=4", f"{WRITE}=5"]
    assert BucketTable(spark, str(tmp_path / "t"), buckets=99).buckets == 4


def test_refused_writes(spark, tmp_path):
    store = BucketTable(spark, str(tmp_path / "t"))
    store.write(spark.createDataFrame([("1", "a")], COLUMNS))
    with pytest.raises(ValueError, match="v"):
        store.write_buckets(spark.createDataFrame([("1", 2)], "id string, v int"), [0])
    with pytest.raises(ValueError, match=BUCKET):
        store.write(spark.createDataFrame([("1", 2)], f"id string, {BUCKET} int"))
    assert rows(store.read()) == [("1", "a")]


def test_tasks_and_files_follow_the_bytes(spark, tmp_path, monkeypatch):
    """A table of many bytes gets more buckets, and a hot bucket several files, in as many tasks."""
    monkeypatch.setattr(buckets, "FILE_BYTES", 2000)
    monkeypatch.setattr(buckets, "BUCKET_BYTES", 20_000)
    df = spark.range(4000).selectExpr("CAST(IF(id < 2000, NULL, id) AS STRING) AS id", "uuid() AS v", "map(id, id) AS m")
    df.write.parquet(str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s"))
    store = BucketTable(spark, str(tmp_path / "t"), buckets=2)
    store.write(df, size=60_000)
    assert store.buckets == 3
    assert len(files(tmp_path / "t")) > 20
    assert store.read().count() == 4000 and store.read().select("v").distinct().count() == 4000
    hot = store.touched(df.filter("id IS NULL"))
    before = files(tmp_path / "t")
    store.write_buckets(store.read(hot), hot)
    assert len(files(tmp_path / "t") - before) > 5  # from the stored bytes
    assert store.read().count() == 4000


def test_tasks_keep_folders_open_and_get_even_shares(spark, tmp_path, monkeypatch):
    """No task sorts its rows by folder, and files of a told size are as many as the tasks that get rows."""
    monkeypatch.setattr(buckets, "FILE_BYTES", 10_000)
    df = spark.range(8000).selectExpr("CAST(id AS STRING) AS id", "uuid() AS v")
    store = BucketTable(spark, str(tmp_path / "t"), buckets=8)
    store.write(df, size=160_000)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 8
    dealt = store._dealt(df.withColumn(BUCKET, store.bucket_of()), None, 160_000)
    shares = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(shares) == dealt.rdd.getNumPartitions() >= 16
    assert max(r["count"] for r in shares) < 2.5 * min(r["count"] for r in shares)
