import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators import balance as b
from tidemark.operators.collect import collect_chunks
from tidemark.operators.quality import Rule, bytes_reconcile, run_rule, select_rules

TS = "2024-01-01 00:00:00"
CLAIMS = f"claimnumber string, state string, retired int, {n.OPERATION} int, {n.RUN} int, {n.SOFT_DELETE} string"
MONEY = f"amount double, costtype string, costcategory string, retired int, {n.OPERATION} int, {n.RUN} int, {n.SOFT_DELETE} string"


def claims(spark, *data):
    return spark.createDataFrame(list(data), CLAIMS)


def money(spark, *data):
    return spark.createDataFrame(list(data), MONEY)


def statuses(metrics):
    return {r["metric_type"]: r["status"] for r in metrics.collect()}


def test_no_rows_give_zero_and_pass(spark):
    out = b.balance_raw_vs_replica(claims(spark), money(spark), claims(spark), money(spark), 1, 2, TS)
    assert out.count() == 5
    assert {float(r["source_value"]) for r in out.collect()} == {0.0}
    assert rows(b.verdict(out)) == [("S",)]


@pytest.mark.parametrize("extra, status", [(0.004, "PASSED"), (0.006, "FAILED")])
def test_money_is_compared_at_two_decimals(spark, extra, status):
    src = money(spark, (10.0 + extra, "claimcost", "LossPayment", 0, 0, 2, "N"))
    tgt = money(spark, (10.0, "claimcost", "LossPayment", 0, 0, 2, "N"))
    out = b.balance_raw_vs_replica(claims(spark), src, claims(spark), tgt, 1, 2, TS)
    assert statuses(out)["LossPayment"] == status
    assert rows(b.verdict(out)) == [("S" if status == "PASSED" else "F",)]


def test_filters_of_raw_and_replica(spark):
    c = claims(
        spark,
        ("1", "Open", 0, 0, 2, "N"), ("1", "Open", 0, 0, 2, "N"), ("2", "Draft", 0, 0, 2, "N"),
        ("3", "Closed", 1, 0, 2, "N"), ("4", "Closed", 0, 1, 2, "Y"), ("5", "Open", 0, 0, 1, "N"),
    )
    m = money(
        spark,
        (1.0, "aoexpense", "ExpensePayment", 0, 0, 2, "N"), (2.0, "dccexpense", "ExpensePayment", 0, 0, 2, "N"),
        (4.0, "claimcost", "ExpensePayment", 0, 0, 2, "N"), (8.0, "aoexpense", "ExpensePayment", 0, 1, 2, "Y"),
        (16.0, "aoexpense", "ExpensePayment", 1, 0, 2, "N"), (32.0, "aoexpense", "ExpensePayment", 0, 0, 1, "N"),
    )
    raw = {r["metric_type"]: float(r["value"]) for r in b.source_metrics(c, m).collect()}
    replica = {r["metric_type"]: float(r["value"]) for r in b.replica_run_metrics(c, m, 2).collect()}
    assert (raw["ClaimCount"], raw["ExpensePayment"]) == (2.0, 35.0)
    assert (replica["ClaimCount"], replica["ExpensePayment"]) == (1.0, 3.0)
    every = {r["metric_type"]: float(r["value"]) for r in b.replica_metrics(c, m).collect()}
    assert (every["ClaimCount"], every["ExpensePayment"]) == (3.0, 35.0)


def test_verdict_of_nothing_is_a_failure(spark):
    assert rows(b.verdict(spark.createDataFrame([], "status string"))) == [("F",)]


def test_cycle_folders_use_the_loaded_range_as_numbers(spark):
    files = spark.createDataFrame([("cc_a", "f", "999"), ("cc_a", "f", "1000"), ("cc_a", "g", "1500"), ("cc_b", "f", "1000")], "table_name string, gw_fingerprint string, gw_timestamp string")
    loaded = files.filter("table_name = 'cc_a' and gw_timestamp in ('999', '1000')")
    assert rows(b.cycle_folders(files, loaded, "CC_A"), "gw_timestamp") == [("1000",), ("999",)]
    assert b.cycle_folders(files, loaded.limit(0), "CC_A").count() == 0


RULE = Rule(3, "", "t", "publicid")
TARGET = f"publicid string, {n.RUN} int, {n.VALIDATION} string"


def target(spark):
    return spark.createDataFrame([("p1", 2, None), ("p2", 2, None), ("p3", 1, None)], TARGET)


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "publicid string")


def test_rule_without_failures_writes_no_log(spark):
    out = run_rule(RULE, keys(spark), target(spark), 2, 9, TS)
    assert rows(out.counts) == [(2, 2, 0, "S")]
    assert out.error_log.count() == 0


def test_rule_with_failures(spark):
    out = run_rule(RULE, keys(spark, "p2", "p1", "p3"), target(spark), 2, 9, TS)
    assert rows(out.counts) == [(2, 0, 2, "F")]
    assert rows(out.flagged, "publicid", n.VALIDATION) == [("p1", "F"), ("p2", "F"), ("p3", None)]
    assert rows(out.error_log, "gw_error_values", "val_sk", "val_run_sk") == [
        ("p1", "3", "9"), ("p2", "3", "9"), ("p3", "3", "9"),
    ]


def test_failures_of_other_runs_only_write_no_log(spark):
    out = run_rule(RULE, keys(spark, "p3"), target(spark), 2, 9, TS)
    assert rows(out.counts) == [(2, 2, 0, "S")]
    assert out.error_log.count() == 0


def test_failed_count_adds_up_over_rules(spark):
    first = run_rule(RULE, keys(spark, "p1"), target(spark), 2, 9, TS)
    second = run_rule(RULE, keys(spark, "p2"), first.flagged, 2, 10, TS)
    assert rows(second.counts) == [(2, 0, 2, "F")]


def test_select_rules(spark):
    ctrl = spark.createDataFrame(
        [(2, "Y", "C", "CC"), (1, "Y", "C", "CC"), (3, "N", "C", "CC"), (4, "Y", "I", "CC"), (5, "Y", "C", "PC")],
        "val_sk int, acti_ind string, status string, xcenter string",
    )
    assert [r["val_sk"] for r in select_rules(ctrl, "CC").collect()] == [1, 2]


def test_chunks_keep_every_value_of_a_hot_group(spark):
    """One group and one value hold most rows; nothing is lost and no list grows."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("g"),
        F.when(F.col("id") % 2 == 0, "same").otherwise(F.col("id").cast("string")).alias("v"),
    )
    out = collect_chunks(df, "v", ["g"], chunk_rows=50).collect()
    got = sorted((r["g"], v) for r in out for v in r["values"].split(","))
    assert got == sorted((r["g"], r["v"]) for r in df.collect())
    assert sum(r["n_values"] for r in out) == 2000
    assert max(r["n_values"] for r in out) <= 250
    assert all(len(r["values"].split(",")) == r["n_values"] for r in out)


def test_small_group_is_one_sorted_list(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string")
    assert rows(collect_chunks(df, "v"), "values", "n_values") == [("a,b,b", 3)]
    assert collect_chunks(df.limit(0), "v").count() == 0


def test_bytes_reconcile(spark):
    schema = "table_name string, gw_fingerprint string, gw_timestamp string, bytes bigint"
    src = spark.createDataFrame([("t", "f", "1", 10), ("t", "f", "2", 0), ("t", "f", "3", 5)], schema)
    tgt = spark.createDataFrame([("t", "f", "1", 10), ("t", "f", "2", 0)], schema)
    out = bytes_reconcile(src, tgt)
    assert rows(out, "gw_timestamp", "status") == [("1", "S"), ("2", "F"), ("3", "F")]
