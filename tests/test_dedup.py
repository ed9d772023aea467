from helpers import plan, rows
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators.dedup import (
    latest_per_key,
    latest_per_key_in_batch,
    split_ops,
    unique_source,
)

SCHEMA = f"id string, v string, {n.OPERATION} int, {n.PAYLOAD_TS} bigint, {n.SEQUENCE} string, {n.FINGERPRINT} string, {n.DELIVERY} string"


def feed(spark, *events):
    return spark.createDataFrame(list(events), SCHEMA)


def test_stale_duplicate_loses(spark):
    df = feed(spark, ("a", "old", 4, 940, "0a", "f", "1"), ("a", "new", 4, 1000, "0b", "f", "1"))
    assert rows(latest_per_key(df, ["id"]), "v") == [("new",)]


def test_tie_on_payload_goes_to_higher_sequence(spark):
    df = feed(spark, ("a", "x", 4, 5, "0a", "f", "1"), ("a", "y", 4, 5, "0b", "f", "1"))
    assert rows(latest_per_key(df, ["id"]), "v") == [("y",)]


def test_delivery_beats_payload(spark):
    df = feed(spark, ("a", "late", 4, 1, "01", "f", "2"), ("a", "early", 4, 9, "09", "f", "1"))
    assert rows(latest_per_key(df, ["id"]), "v") == [("late",)]
    by_payload = latest_per_key_in_batch(df, ["id"], (n.PAYLOAD_TS, n.SEQUENCE))
    assert rows(by_payload, "v") == [("early",)]


def test_null_order_value_loses(spark):
    df = feed(spark, ("a", "null", 4, None, "09", "f", "1"), ("a", "set", 4, 1, "01", "f", "1"))
    assert rows(latest_per_key(df, ["id"]), "v") == [("set",)]


def test_full_tie_has_one_stable_winner(spark):
    events = [("a", f"v{i}", 4, 5, "0a", "f", "1") for i in range(50)]
    picked = {
        rows(latest_per_key(feed(spark, *order).repartition(parts), ["id"]), "v")[0]
        for order, parts in ((events, 1), (events[::-1], 3), (events[25:] + events[:25], 7))
    }
    assert len(picked) == 1


def test_one_row_per_fingerprint(spark):
    df = feed(spark, ("a", "x", 4, 1, "01", "f", "1"), ("a", "y", 4, 2, "02", "g", "1"))
    assert rows(latest_per_key_in_batch(df), "v") == [("x",), ("y",)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    third = F.when(F.col("i") % 3 == 0, "hot").otherwise(F.col("i").cast("string"))
    df = spark.range(30_000).withColumnRenamed("id", "i").select(
        third.alias("id"), F.col("i").alias("t")
    )
    out = latest_per_key(df, ["id"], ["t"])
    text = plan(out)
    assert "WindowGroupLimit" in text and "Partial" in text
    assert out.count() == 20_001
    assert rows(out.filter("id = 'hot'"), "t") == [(29_997,)]


def test_split_ops(spark):
    df = feed(spark, *[(str(op), "v", op, 1, "01", "f", "1") for op in (0, 1, 2, 3, 4, None)])
    deletes, upserts = split_ops(df)
    assert rows(deletes, "id") == [("1",)]
    assert rows(upserts, "id") == [("0",), ("2",), ("4",)]
    assert rows(split_ops(df, initial=True)[1], "id") == [("0",), ("2",), ("3",), ("4",)]


def test_unique_source_drops_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3)], "k int, t int")
    assert rows(unique_source(df, ["k"], ["t"])) == [(1, 2)]


def test_map_columns_are_allowed(spark):
    df = spark.createDataFrame([("a", {"x": 1}, 1)], "id string, m map<string,int>, t int")
    assert latest_per_key(df, ["id"], ["t"]).count() == 1


def test_no_tie_break_reads_the_needed_columns_only(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2, "a", "wide"), (1, 3, "b", "wide")], "id int, ts int, v string, w string").write.parquet(path)
    df = spark.read.parquet(path)
    picked = latest_per_key(df, ["id"], ["ts"], tie_break=()).select("id", "v")
    assert rows(picked) == [(1, "b")]
    schema = next(x for x in plan(picked).split("\n") if "ReadSchema" in x)
    assert "w:string" not in schema
    assert "w:string" in plan(latest_per_key(df, ["id"], ["ts"]).select("id", "v"))
