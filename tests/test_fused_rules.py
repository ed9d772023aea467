"""Rules that share a scan."""

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators.quality import Rule, failed_by_row, failing_rows, row_condition, rule_hits
from tidemark.plans.validate import validate_table
from tidemark.plans.warehouse import Warehouse


def rule(number, query, key="publicid"):
    return Rule(number, query, "cc_claim", key, f"rule {number}")


LOCAL = [
    "SELECT publicid FROM cc_claim WHERE state = 'Open'",
    "select c.publicid from cc_claim c where c.amount < 0 OR c.amount IS NULL ;",
    "SELECT publicid FROM CC_CLAIM AS x WHERE x.state IN ('Closed', 'a,b') AND length(x.state) > 2",
    "SELECT publicid\nFROM cc_claim\nWHERE CASE WHEN amount > 5 THEN state ELSE 'Open' END = 'Open'",
]
OTHER = [
    "SELECT publicid FROM cc_claim WHERE id IN (SELECT id FROM cc_claim WHERE amount > 5)",
    "SELECT c.publicid FROM cc_claim c JOIN cc_claim d ON c.id = d.id WHERE d.amount > 5",
    "SELECT publicid FROM cc_claim WHERE amount > 0 GROUP BY publicid HAVING count(*) > 1",
    "SELECT publicid FROM cc_claim", "SELECT DISTINCT publicid FROM cc_claim WHERE amount > 0",
    "SELECT publicid, id FROM cc_claim WHERE amount > 0", "SELECT id FROM cc_claim WHERE amount > 0",
    "SELECT publicid FROM other WHERE amount > 0", "SELECT publicid FROM cc_claim c, cc_claim d WHERE c.id = d.id",
    "SELECT publicid FROM cc_claim WHERE amount > 0 LIMIT 1", "SELECT publicid FROM cc_claim WHERE amount > 0 -- x",
]
ROWS = [
    (1, "p1", "Open", 1.0, 1), (2, "p1", "Closed", 9.0, 2), (3, "p2", "Closed", None, 2), (4, None, "Open", -1.0, 2),
    (5, "p3", "Draft", 6.0, 2), (6, "p4", "Open", 7.0, 2), (7, "p4", "Open", 7.0, 1),
]
SCHEMA = f"id int, publicid string, state string, amount double, {n.RUN} int"


def test_which_rules_look_at_one_row():
    assert all(row_condition(rule(1, q)) for q in LOCAL)
    assert not any(row_condition(rule(1, q)) for q in OTHER)


def test_one_scan_gives_what_the_queries_give(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    got = failed_by_row(table, {i: rule(i, q) for i, q in enumerate(LOCAL)})
    want = [(r[0], i) for i, q in enumerate(LOCAL) for r in failing_rows(spark, q, {"cc_claim": table}).collect()]
    assert rows(got, "key", "rule") == sorted(want, key=repr)
    assert plan(got).count("Scan parquet") == 1


@pytest.mark.parametrize("queries", [LOCAL, LOCAL[:1] + OTHER[:3], OTHER[:3]])
def test_counts_and_flags(spark, tmp_path, queries):
    wh = Warehouse(spark, str(tmp_path), buckets=4)
    df = spark.createDataFrame([(*r, None) for r in ROWS], f"{SCHEMA}, {n.VALIDATION} string")
    wh.replica("cc_claim").write(df)
    wh.publish_replicas(["cc_claim"])
    failing = [{r[0] for r in failing_rows(spark, q, {"cc_claim": df}).collect()} for q in queries]
    summary = validate_table(wh, "cc_claim", [rule(i, q) for i, q in enumerate(queries)], "CC", 1, 2, "2024-01-01 00:00:00", 10)
    mine = [r for r in ROWS if r[4] == 2]
    want = [(i, len(mine), sum(r[1] in f and r[1] is not None for r in mine)) for i, f in enumerate(failing)]
    assert rows(summary, "val_sk", "total_count", "failed_count") == want
    every = set().union(*failing) - {None}
    flags = [(r[0], "F" if r[4] == 2 and r[1] in every else None) for r in ROWS]
    assert rows(wh.replica("cc_claim").read(), "id", n.VALIDATION) == sorted(flags, key=repr)
    log = rows(wh.control("validation_error_log").read(), "gw_error_values", "val_sk")
    assert set(log) == {(k, str(i)) for i, f in enumerate(failing) for k in f if k is not None and want[i][2]}


def test_counts_of_no_rule(spark):
    row = rule_hits(spark.createDataFrame(ROWS, SCHEMA), {}, [], F.lit(0)).first()
    assert (row["total_count"], row["buckets"]) == (7, [])
