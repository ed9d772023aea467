"""Merged partial aggregates against the plain totals."""

import random
import threading

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators.balance import replica_metrics, replica_run_metrics
from tidemark.operators.partials import claim_partials, merged_metrics, new_numbers
from tidemark.plans import balancing
from tidemark.plans.balancing import CLAIM, TRANSACTION, refresh_partials
from tidemark.plans.warehouse import Warehouse

CLAIMS = f"id int, claimnumber string, state string, retired int, {n.SOFT_DELETE} string, {n.RUN} int"
TXNS = f"id int, amount double, costtype string, costcategory string, retired int, {n.SOFT_DELETE} string, {n.RUN} int"


def world(rng, run, claims, txns):
    pick = rng.choice
    for k in rng.sample(range(60), 25):
        claims[k] = (k, pick([f"C{k // 2}", f"C{k}", None]), pick(["Open", "Closed", "Draft", None]), pick([0, 0, 1]), pick("NNNY"), run)
        txns[k] = (k, pick([1.25, -3.5, 1e6, None]), pick(["claimcost", "aoexpense", "other"]),
                   pick(["LossPayment", "ExpensePayment", "LossReserve", "x"]), pick([0, 0, 1]), pick("NNNY"), run)


@pytest.mark.parametrize("seed", [3, 4])
def test_partials_follow_updates_and_deletes(spark, tmp_path, seed):
    wh, rng = Warehouse(spark, str(tmp_path), buckets=5), random.Random(seed)
    claims, txns = {}, {}
    for run in (1, 2, 3):
        world(rng, run, claims, txns)
        frames = {CLAIM: spark.createDataFrame(list(claims.values()), CLAIMS), TRANSACTION: spark.createDataFrame(list(txns.values()), TXNS)}
        parts = []
        for table, df in frames.items():
            replica = wh.replica(table)
            if run == 1:
                replica.write(df)
            else:
                buckets = replica.touched(df.filter(f"{n.RUN} = {run}"))
                replica.write_buckets(df.filter(replica.bucket_of().isin(buckets)), buckets)
            parts.append(refresh_partials(wh, table))
        assert rows(merged_metrics(*parts)) == rows(replica_metrics(*frames.values()))
        assert rows(merged_metrics(*parts, run)) == rows(replica_run_metrics(*frames.values(), run))


def test_only_rewritten_buckets_are_read(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path), buckets=6)
    df = spark.createDataFrame([(k, f"C{k}", "Open", 0, "N", 1) for k in range(80)], CLAIMS)
    replica = wh.replica(CLAIM)
    replica.write(df)
    refresh_partials(wh, CLAIM)
    replica.write_buckets(df.filter(replica.bucket_of() == 2), [2])
    read = []
    plain = type(replica).read

    def noted(self, buckets=None, version=None):
        read.append(buckets)
        return plain(self, buckets, version)

    monkeypatch.setattr(type(replica), "read", noted)
    assert "bits" in refresh_partials(wh, CLAIM).columns
    refresh_partials(wh, CLAIM)
    assert read == [[2]]
    assert merged_metrics(wh.partials(CLAIM).read(), spark.createDataFrame([], "part int, run int, LossPayment decimal(38,6), "
                          "ExpensePayment decimal(38,6), LossReserve decimal(38,6), ExpenseReserve decimal(38,6)")
                          ).filter("metric_type = 'ClaimCount'").first()["value"] == 80
    assert "replica" not in plan(wh.partials(CLAIM).read())


def test_first_numbers_meet_nothing_and_rows_meet_them_by_hash(spark):
    claims = spark.createDataFrame([(k, f"CLM-{k % 70}", "Open", 0, "N", 1) for k in range(80)], CLAIMS)
    numbers = new_numbers(claims, None)
    assert "LeftAnti" not in plan(numbers)
    found = [r["_number"] for r in numbers.collect()]
    assert sorted(found) == list(range(1, 71))
    later = new_numbers(claims.withColumn("claimnumber", F.concat("claimnumber", F.lit("x"))), numbers)
    assert min(r["_number"] for r in later.collect()) == 71
    made = claim_partials(claims, numbers, F.lit(0))
    assert "xxhash64" in plan(made)
    money = spark.createDataFrame([], "part int, run int, LossPayment decimal(38,6), ExpensePayment decimal(38,6), "
                                      "LossReserve decimal(38,6), ExpenseReserve decimal(38,6)")
    assert merged_metrics(made, money).filter("metric_type = 'ClaimCount'").first()["value"] == 70


def test_the_sources_of_a_balance_are_built_side_by_side(spark, tmp_path, monkeypatch):
    both = threading.Barrier(2, timeout=60)
    monkeypatch.setattr(balancing, "refresh_or_keep", lambda wh, table, *_: both.wait() * 0 or spark.range(1))
    assert set(balancing._sources(Warehouse(spark, str(tmp_path)), 1, "CC")) == {CLAIM, TRANSACTION}
