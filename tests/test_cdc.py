import random

import pytest
from helpers import plan, rows

from tidemark import names as n
from tidemark.operators.cdc import (
    Batch,
    cdc_incremental,
    cdc_initial,
    cdc_reconcile,
    cdc_reconcile_initial,
    change_counts,
    incremental_changes,
    initial_latest,
)
from tidemark.operators.merge import merge_upsert
from tidemark.operators.update import soft_delete, update_where_in

TS = "2024-01-01 00:00:00"
CDC = f"{n.OPERATION} int, {n.PAYLOAD_TS} bigint, {n.SEQUENCE} string"


def batch(spark, fingerprint, last, data, columns="v string"):
    """Events as (id, *values, op, time)."""
    full = [(*e, f"{e[-1]:04d}") for e in data]
    return Batch(fingerprint, last, spark.createDataFrame(full, f"id string, {columns}, {CDC}"))


def initial(spark, *events):
    full = [(*e, f"{e[-1]:04d}", "f1", "100") for e in events]
    df = spark.createDataFrame(full, f"id string, v string, {CDC}, {n.FINGERPRINT} string, {n.DELIVERY} string")
    return cdc_initial(df, 1, TS)


STATE = ("id", "v", n.RUN, n.SOFT_DELETE)


def test_initial_drops_deletes_and_null_codes(spark):
    target = initial(spark, ("a", "1", 0, 1), ("b", "1", 0, 1), ("b", "1", 1, 2), ("c", "1", None, 1), ("d", "1", 3, 1))
    assert rows(target, *STATE) == [("a", "1", 1, "N"), ("d", "1", 1, "N")]


@pytest.mark.parametrize("small", [False, True])
def test_upsert_delete_resurrect_unknown(spark, small):
    target = initial(spark, ("a", "1", 0, 1), ("b", "1", 0, 1), ("c", "1", 0, 1))
    one = [batch(spark, "f1", "200", [("a", "2", 4, 5), ("b", "x", 1, 5), ("zz", "x", 1, 5), ("d", "1", 0, 5)])]
    state = cdc_incremental(target, one, 2, TS, broadcast_changes=small)
    assert rows(state, *STATE) == [
        ("a", "2", 2, "N"), ("b", "1", 2, "Y"), ("c", "1", 1, "N"), ("d", "1", 2, "N"),
    ]
    two = [batch(spark, "f1", "300", [("b", "9", 4, 9)])]
    again = cdc_incremental(state, two, 3, TS, broadcast_changes=small)
    assert rows(again.filter("id = 'b'"), *STATE) == [("b", "9", 3, "N")]


def test_other_codes_are_ignored_and_counted(spark):
    target = initial(spark, ("a", "1", 0, 1))
    changes = incremental_changes(
        target, [batch(spark, "f1", "200", [("a", "2", 3, 5), ("b", "2", None, 5)])], 2, TS
    )
    assert rows(change_counts(changes)) == [(2, 0, 2)]
    state = cdc_incremental(target, [batch(spark, "f1", "200", [("a", "2", 3, 5), ("b", "2", None, 5)])], 2, TS)
    assert rows(state, *STATE) == [("a", "1", 1, "N")]


def test_upsert_clears_the_validation_flag(spark):
    from pyspark.sql import functions as F

    target = initial(spark, ("a", "1", 0, 1), ("b", "1", 0, 1)).withColumn(n.VALIDATION, F.lit("F"))
    state = cdc_incremental(target, [batch(spark, "f1", "200", [("a", "2", 4, 5)])], 2, TS)
    assert rows(state, "id", n.VALIDATION) == [("a", None), ("b", "F")]


def test_type_drift_becomes_null(spark):
    target = initial(spark, ("a", "1", 0, 1)).selectExpr("* except (v)", "cast(v as int) as v")
    state = cdc_incremental(
        target, [batch(spark, "f1", "200", [("a", "oops", 4, 5), ("b", "12.7", 0, 5), ("c", "8", 0, 5)])], 2, TS
    )
    assert rows(state, "id", "v") == [("a", None), ("b", 12), ("c", 8)]


@pytest.mark.parametrize("small", [False, True])
def test_new_and_missing_columns(spark, small):
    target = initial(spark, ("a", "1", 0, 1), ("b", "1", 0, 1))
    wide = batch(spark, "f2", "200", [("a", "2", "w", 4, 5)], "v string, w string")
    state = cdc_incremental(target, [wide], 2, TS, broadcast_changes=small)
    assert rows(state, "id", "v", "w") == [("a", "2", "w"), ("b", "1", None)]
    narrow = batch(spark, "f1", "300", [("a", "3", 4, 9)])
    state = cdc_incremental(state, [narrow], 3, TS, broadcast_changes=small)
    assert rows(state, "id", "v", "w") == [("a", "3", "w"), ("b", "1", None)]


@pytest.mark.parametrize("small", [False, True])
def test_two_schema_versions_in_one_run(spark, small):
    """Net effect in delivery order: f1 (older) then f2."""
    target = initial(spark, ("a", "1", 0, 1), ("b", "1", 0, 1), ("c", "1", 0, 1))
    wide = batch(
        spark, "f2", "150",
        [("a", "2", "w1", 4, 5), ("b", "2", "w2", 4, 5), ("d", "2", "w3", 0, 5), ("c", "x", "x", 1, 5)],
        "v string, w string",
    )
    narrow = batch(spark, "f1", "250", [("a", "3", 4, 6), ("b", "x", 1, 6), ("d", "4", 4, 6), ("c", "5", 4, 6)])
    state = cdc_incremental(target, [narrow, wide], 2, TS, broadcast_changes=small)
    assert rows(state, "id", "v", "w", n.SOFT_DELETE, n.FINGERPRINT) == [
        ("a", "3", "w1", "N", "f1"), ("b", "2", "w2", "Y", "f2"),
        ("c", "5", None, "N", "f1"), ("d", "4", "w3", "N", "f1"),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_net_effect_equals_batch_by_batch(spark, seed):
    rng = random.Random(seed)
    target = initial(spark, *[(f"k{i}", "0", 0, 1) for i in range(12)])
    batches, clock = [], 10
    for b in range(3):
        wide = b != 1
        data = []
        for _ in range(15):
            clock += 1
            values = (f"v{clock}", f"w{clock}") if wide else (f"v{clock}",)
            data.append((f"k{rng.randrange(18)}", *values, rng.choice([0, 1, 1, 2, 3, 4]), clock))
        columns = "v string, w string" if wide else "v string"
        batches.append(batch(spark, f"f{b}", str(1000 + b), data, columns))
    together = cdc_incremental(target, batches, 2, TS)
    one_by_one = target
    for b in batches:
        one_by_one = cdc_incremental(one_by_one, [b], 2, TS)
    shown = ("id", "v", "w", n.OPERATION, n.FINGERPRINT, n.DELIVERY, n.RUN, n.SOFT_DELETE)
    assert rows(together, *shown) == rows(one_by_one, *shown)
    broadcast = cdc_incremental(target, batches, 2, TS, broadcast_changes=True)
    assert rows(together, *shown) == rows(broadcast, *shown)
    # applying the same batches again changes nothing
    assert rows(cdc_incremental(together, batches, 2, TS), *shown) == rows(together, *shown)


def test_reconcile_balances(spark):
    target = initial(spark, ("a", "1", 0, 1), ("b", "1", 0, 1))
    data = [("a", "2", 4, 5), ("a", "3", 4, 6), ("b", "x", 1, 5), ("c", "1", 0, 5), ("zz", "x", 1, 5)]
    batches = [batch(spark, "f1", "200", data)]
    changes = incremental_changes(target, batches, 2, TS)
    state = cdc_incremental(target, batches, 2, TS)
    row = cdc_reconcile(batches[0].rows, changes, state, 2).first()
    # b keeps its insert code and takes this run's id, so it counts as inserted
    assert tuple(row) == (5, 1, 2, 2, 1, 2, 5, "S")


def test_key_deleted_in_one_version_and_upserted_in_the_next(spark):
    """Counted once, by its final outcome."""
    target = initial(spark, ("a", "1", 0, 1))
    batches = [batch(spark, "f1", "200", [("a", "x", 1, 5)]), batch(spark, "f2", "300", [("a", "2", 4, 6)])]
    changes = incremental_changes(target, batches, 2, TS)
    state = cdc_incremental(target, batches, 2, TS)
    raw = batches[0].rows.select("id").union(batches[1].rows.select("id"))
    row = cdc_reconcile(raw, changes, state, 2).first()
    assert (row["rows_read"], row["rows_loaded"], row["rows_deleted"], row["status"]) == (2, 2, 0, "S")


def test_reconcile_fails_on_ignored_rows(spark):
    target = initial(spark, ("a", "1", 0, 1))
    batches = [batch(spark, "f1", "200", [("b", "2", 3, 5)])]
    changes = incremental_changes(target, batches, 2, TS)
    state = cdc_incremental(target, batches, 2, TS)
    assert cdc_reconcile(batches[0].rows, changes, state, 2).first()["status"] == "F"


def test_reconcile_initial(spark):
    events = [("a", "1", 0, 1), ("a", "2", 4, 2), ("b", "1", 1, 1)]
    full = [(*e, f"{e[-1]:04d}", "f1", "100") for e in events]
    raw = spark.createDataFrame(
        full, f"id string, v string, {CDC}, {n.FINGERPRINT} string, {n.DELIVERY} string"
    )
    row = cdc_reconcile_initial(raw, initial_latest(raw, 1, TS), cdc_initial(raw, 1, TS), 1).first()
    assert (row["rows_read"], row["rows_duplicate"], row["rows_deleted"], row["status"]) == (3, 1, 1, "S")


def test_broadcast_merge_does_not_shuffle_the_target(spark):
    target = spark.range(10).selectExpr("cast(id as string) id", "'x' as v")
    source = spark.createDataFrame([("3", "y"), ("77", "z")], "id string, v string")
    out = merge_upsert(target, source, broadcast_source=True)
    assert "FullOuter" not in plan(out)
    assert "FullOuter" in plan(merge_upsert(target, source))
    assert rows(out) == sorted([(str(i), "y" if i == 3 else "x") for i in range(10)] + [("77", "z")])


def test_merge_upsert_is_idempotent_and_keeps_missing_columns(spark):
    target = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "id int, v string, w string")
    source = spark.createDataFrame([(2, "B", 9), (3, "C", 8)], "id int, V string, extra int")
    once = merge_upsert(target, source)
    assert once.columns == ["id", "v", "w", "extra"]
    assert rows(once) == [(1, "a", "p", None), (2, "B", "q", 9), (3, "C", None, 8)]
    assert rows(merge_upsert(once, source)) == rows(once)


def test_soft_delete_and_null_keys(spark):
    target = spark.createDataFrame(
        [("a", "N", 1), ("b", "N", 1), (None, "N", 1)], f"id string, {n.SOFT_DELETE} string, {n.RUN} int"
    )
    gone = spark.createDataFrame([("a",), ("a",), ("q",), (None,)], "id string")
    assert rows(soft_delete(target, gone, 5)) == [("a", "Y", 5), ("b", "N", 1), (None, "N", 1)]


def test_update_rejects_unknown_column(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError):
        update_where_in(df, df, [(F.col("id"), F.col("id"))], {"nope": F.lit(1)})
