"""The refine job against the plain operators, over several runs."""

import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators.scd2 import (
    close_gone,
    expire_gone,
    flag_gone,
    gone_hashes,
    number_inserts,
    scd2_initial,
    scd2_merge,
    scd2_step,
)
from tidemark.plans.jobspec import JobSpec
from tidemark.plans.refine import refine, refined_source
from tidemark.plans.warehouse import Warehouse
from tidemark.session import Staging

SPEC = JobSpec(9, "detail", ("id",), "sk", "cc_claim", ("id",), "")
SHOWN = ("id", "v", "sk", n.ACTIVE, n.EFFECTIVE, n.EXPIRY, n.UPDATED, n.LAST_RUN, n.INSERT_RUN)


def runs(seed):
    """Per run: source rows, and driving rows with deletes and retirements."""
    rng = random.Random(seed)
    for run in (1, 2, 3):
        picked = rng.sample(range(30), 20)
        source = [(k, rng.choice("ab"), f"{1000 + run}") for k in picked]
        driving = [(k, rng.choice([run - 1, run]), rng.choice("NNY"), rng.choice([0, 0, 1])) for k in range(30)]
        yield run, source, driving


@pytest.mark.parametrize("compat, reactivate", [(False, False), (True, False), (False, True)])
def test_refine_equals_the_operators(spark, tmp_path, compat, reactivate):
    wh = Warehouse(spark, str(tmp_path))
    expected = None
    for run, source, driving in runs(11):
        ts = f"2024-01-0{run} 00:00:00"
        data = spark.createDataFrame(source, f"id int, v string, {n.DELIVERY} string")
        gone = spark.createDataFrame(driving, f"id int, {n.RUN} int, {n.SOFT_DELETE} string, retired int")
        wh.replica("cc_claim").write(gone)
        metrics = refine(wh, SPEC, data, run, ts, run - 1, reactivate=reactivate, compat=compat).first()

        src = refined_source(SPEC, data, run, ts, compat)
        if expected is None:
            state = scd2_initial(src, "sk", run)
        else:
            state = scd2_merge(expected, number_inserts(src, expected, "sk", reactivate), run, ts, reactivate)
        inserted = state.filter(f"{n.INSERT_RUN} = '{run}'").count()
        closed = state.filter(f"{n.LAST_RUN} = '{run}' and {n.INSERT_RUN} <> '{run}'").count()
        state = expire_gone(state, gone, ["id"], ["id"], run - 1, run, ts, compat)
        expected = spark.createDataFrame(state.collect(), state.schema)
        assert rows(wh.refined("detail").read(), *SHOWN) == rows(expected, *SHOWN)
        assert metrics["rows_inserted"] == inserted
        assert metrics["rows_updated"] == (0 if run == 1 else closed)
    numbers = sorted(r["sk"] for r in expected.select("sk").collect())
    assert numbers == list(range(1, len(numbers) + 1))
    before = rows(wh.refined("detail").read(), *SHOWN)
    assert rows(wh.refined("detail").compact(), *SHOWN) == before


def test_rows_with_a_null_key_and_duplicates(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.replica("cc_claim").write(
        spark.createDataFrame([], f"id int, {n.RUN} int, {n.SOFT_DELETE} string")
    )
    data = spark.createDataFrame(
        [(1, "old", "1001"), (1, "new", "1002"), (None, "x", "1001")], f"id int, v string, {n.DELIVERY} string"
    )
    metrics = refine(wh, SPEC, data, 1, "2024-01-01 00:00:00").first()
    assert rows(wh.refined("detail").read(), "id", "v", "sk") == [(1, "new", 1)]
    assert (metrics["rows_read"], metrics["rows_inserted"], metrics["status"]) == (1, 1, "S")


def test_a_run_joins_the_open_versions_once(spark):
    data = spark.createDataFrame([(1, "a", "1001")], f"id int, v string, {n.DELIVERY} string")
    source = refined_source(SPEC, data, 1, "2024-01-01 00:00:00")
    target = scd2_initial(source, "sk", 1)
    driving = spark.createDataFrame([], f"id int, {n.RUN} int, {n.SOFT_DELETE} string")
    numbered = number_inserts(source, target, "sk")
    moved = scd2_step(target, numbered, 2, "2024-01-02 00:00:00")
    state = expire_gone(moved, driving, ["id"], ["id"], 0, 2, "2024-01-02 00:00:00", split=False)
    assert plan(state).count("FullOuter") == plan(moved).count("FullOuter") >= 1


def test_hashes_are_made_after_the_shuffle_of_the_latest_rows(spark):
    data = spark.createDataFrame([(1, "a", "1001")], f"ID int, v string, {n.DELIVERY} string")
    text = plan(refined_source(SPEC, data, 1, "2024-01-01 00:00:00"))
    below = text[text.index("Exchange") :]
    assert "md5" in text and "md5" not in below


def test_versions_do_not_move_for_the_keys_that_are_gone(spark):
    data = spark.createDataFrame([(k, "a", "1001") for k in (1, 2, 3)], f"id int, v string, {n.DELIVERY} string")
    source = refined_source(SPEC, data, 1, "2024-01-01 00:00:00")
    target = scd2_initial(source, "sk", 1)
    driving = spark.createDataFrame(
        [(1, 2, "Y"), (2, 2, "N"), (3, 1, "Y"), (None, 2, "Y")], f"id long, {n.RUN} int, {n.SOFT_DELETE} string"
    )
    numbered = number_inserts(source, target, "sk")
    hashes = gone_hashes(target, numbered, driving, ["id"], ["id"], 1)
    sides = [flag_gone(side, hashes) for side in (target, numbered)]
    state = close_gone(scd2_step(*sides, 2, "2024-01-02 00:00:00"), 2, "2024-01-02 00:00:00")
    assert rows(state, "id", n.ACTIVE, n.LAST_RUN) == [(1, "N", "2"), (2, "Y", "1"), (3, "Y", "1")]
    text = plan(state)
    assert text[: text.index("FullOuter")].count("Join") == 1  # the merge is the last one
    spelled = driving.withColumn("id", F.concat(F.col("id").cast("string"), F.lit(" ")))
    assert gone_hashes(target, numbered, spelled, ["id"], ["id"], 1) is None  # blanks are trimmed there


def test_only_rows_that_add_a_version_are_staged_and_a_first_load_moves_bytes(spark, tmp_path, monkeypatch):
    staged = {}
    plain = Staging.put

    def noted(self, df, name):
        out = plain(self, df, name)
        staged[name] = (out.count(), out.schema[n.KEY_HASH].dataType.simpleString())
        return out

    wh = Warehouse(spark, str(tmp_path))
    wh.replica(SPEC.driving_table).write(
        spark.createDataFrame([(6, 2, "Y", 0)], f"id int, {n.RUN} int, {n.SOFT_DELETE} string, retired int")
    )
    first = spark.createDataFrame([(k, "a", "1001") for k in range(9)], f"id int, v string, {n.DELIVERY} string")
    monkeypatch.setattr(Staging, "put", noted)
    refine(wh, SPEC, first, 1, "2024-01-01 00:00:00", previous_run=9)
    assert staged.pop("source") == (9, "binary")
    second = spark.createDataFrame(
        [(k, "b" if k < 2 else "a", "1002") for k in range(1, 11)], f"id int, v string, {n.DELIVERY} string"
    )
    metrics = refine(wh, SPEC, second, 2, "2024-01-02 00:00:00", previous_run=1).first()
    assert staged == {"inserts": (3, "string")}
    assert (metrics["rows_read"], metrics["rows_inserted"], metrics["rows_updated"]) == (3, 3, 1)
    state = wh.refined(SPEC.target).read()
    assert state.schema[n.KEY_HASH].dataType.simpleString() == "string"
    assert sorted((r["id"], r["v"], r[n.ACTIVE]) for r in state.collect()) == sorted(
        [(0, "a", "Y"), (1, "a", "N"), (1, "b", "Y"), (6, "a", "N"), (9, "a", "Y"), (10, "a", "Y")]
        + [(k, "a", "Y") for k in (2, 3, 4, 5, 7, 8)]
    )
    again = refine(wh, SPEC, second, 3, "2024-01-03 00:00:00", previous_run=2).first()
    assert staged["inserts"][0] == again["rows_inserted"] == again["rows_read"] == 0
