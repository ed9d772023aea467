import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators.scd2 import (
    duplicate_active_keys,
    expire_gone,
    expire_retired,
    expire_soft_deleted,
    number_inserts,
    scd2_hash,
    scd2_initial,
    scd2_merge,
    scd2_metadata,
    scd2_reconcile,
    scd2_rows_read,
)
from tidemark.operators.surrogate import assign_surrogate, number_new_rows

T = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]


def source(spark, data, run, columns="id int, v string"):
    df = spark.createDataFrame(data, columns)
    return scd2_metadata(scd2_hash(df, ["id"]), "sk", run, T[run - 1])


def load(spark, target, data, run, reactivate=False):
    src = source(spark, data, run)
    if target is None:
        return scd2_initial(src, "sk", run)
    return scd2_merge(target, number_inserts(src, target, "sk", reactivate), run, T[run - 1], reactivate)


SHOWN = ("id", "v", n.ACTIVE, n.INSERT_RUN, n.LAST_RUN)


def test_unchanged_changed_new_missing(spark):
    first = load(spark, None, [(1, "a"), (2, "b"), (3, "c")], 1)
    second = load(spark, first, [(1, "a"), (2, "B"), (4, "d")], 2)
    assert rows(second, *SHOWN) == [
        (1, "a", "Y", "1", "1"),
        (2, "B", "Y", "2", "2"),
        (2, "b", "N", "1", "2"),
        (3, "c", "Y", "1", "1"),
        (4, "d", "Y", "2", "2"),
    ]
    closed = second.filter("v = 'b'").first()
    assert str(closed[n.EXPIRY]) == T[1] and str(closed[n.UPDATED]) == T[1]
    assert str(closed[n.EFFECTIVE]) == T[0]
    assert sorted(r["sk"] for r in second.collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("reactivate, expected", [(False, 0), (True, 1)])
def test_key_with_closed_versions_only(spark, reactivate, expected):
    first = load(spark, None, [(1, "a"), (2, "b")], 1)
    first = first.withColumn(n.ACTIVE, F.when(F.col("id") == 1, "N").otherwise("Y"))
    second = load(spark, first, [(1, "changed"), (2, "b")], 2, reactivate)
    assert second.filter("id = 1 and ETL_ActiveRow_Flag = 'Y'").count() == expected
    # the source row still counts as read, so the load reports a failure unless it is inserted
    read = scd2_rows_read(source(spark, [(1, "changed"), (2, "b")], 2), first)
    assert read.first()["rows_read"] == 1
    status = scd2_reconcile(read, second, 2).first()["status"]
    assert status == ("S" if reactivate else "F")


def test_merge_without_numbering_looks_up_closed_keys(spark):
    first = load(spark, None, [(1, "a"), (2, "b")], 1)
    first = first.withColumn(n.ACTIVE, F.when(F.col("id") == 1, "N").otherwise("Y"))
    out = scd2_merge(first, source(spark, [(1, "x"), (2, "b"), (3, "c")], 2), 2, T[1])
    assert rows(out, "id", "v", n.ACTIVE) == [(1, "a", "N"), (2, "b", "Y"), (3, "c", "Y")]


def test_only_version_closed_with_same_content_is_not_read(spark):
    first = load(spark, None, [(1, "a"), (2, "b")], 1).withColumn(n.ACTIVE, F.lit("N"))
    assert scd2_rows_read(source(spark, [(1, "a"), (2, "x")], 2), first).first()[0] == 1
    assert scd2_rows_read(source(spark, [(1, "a"), (2, "x")], 2)).first()[0] == 2


def test_new_business_column_is_added(spark):
    first = load(spark, None, [(1, "a")], 1)
    src = source(spark, [(1, "a", "w"), (2, "b", "w")], 2, "id int, v string, w string")
    out = scd2_merge(first, number_inserts(src, first, "sk"), 2, T[1])
    assert rows(out, "id", "v", "w", n.ACTIVE) == [
        (1, "a", "w", "Y"), (1, "a", None, "N"), (2, "b", "w", "Y"),
    ]


@pytest.mark.parametrize("seed", [3, 4])
def test_random_runs_keep_one_active_row_and_dense_keys(spark, seed):
    rng = random.Random(seed)
    target = None
    for run in (1, 2, 3):
        data = [(k, rng.choice("abc")) for k in rng.sample(range(40), 25)]
        target = load(spark, target, data, run)
        target = spark.createDataFrame(target.collect(), target.schema)
        assert duplicate_active_keys(target).count() == 0
        numbers = sorted(r["sk"] for r in target.select("sk").collect())
        assert numbers == list(range(1, len(numbers) + 1))
        # running the same source again changes nothing
        again = load(spark, target, data, run)
        assert rows(again, *SHOWN, "sk") == rows(target, *SHOWN, "sk")


def test_hashes(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a", "bc"), (4, "ab", "c")], "id int, p string, q string")
    def change(compat):
        return {r["id"]: r[n.CHANGE_HASH] for r in scd2_hash(df, ["id"], compat=compat).collect()}
    strict, compat = change(False), change(True)
    assert strict[1] != strict[2] and strict[3] != strict[4]
    assert compat[1] == compat[2] and compat[3] == compat[4]
    permuted = {r["id"]: r[n.CHANGE_HASH] for r in scd2_hash(df.select("q", "id", "p"), ["id"]).collect()}
    assert permuted == strict


def test_hash_of_a_table_that_is_all_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "x int, y string")
    hashed = scd2_hash(df, ["x", "y"]).collect()
    assert len({r[n.CHANGE_HASH] for r in hashed}) == 2


def test_exclusions_do_not_change_the_hash(spark):
    a = spark.createDataFrame([(1, "v", 1)], "id int, v string, CYC_RUN_SK int")
    b = spark.createDataFrame([(1, "v", 2)], "id int, v string, CYC_RUN_SK int")
    one, two = (scd2_hash(x, ["id"]).first()[n.CHANGE_HASH] for x in (a, b))
    assert one == two


def driving(spark):
    return spark.createDataFrame(
        [(" 1 ", 5, "Y", 0), ("2", 6, "Y", 0), ("3", 6, "N", 1), ("4", 6, "N", 0)],
        f"id string, {n.RUN} int, {n.SOFT_DELETE} string, retired int",
    )


def test_propagation_only_after_the_previous_run(spark):
    refined = load(spark, None, [(i, "a") for i in (1, 2, 3, 4)], 1)
    args = (driving(spark), ["id"], ["id"])
    assert rows(expire_soft_deleted(refined, *args, 5, 7, T[2]).filter("ETL_ActiveRow_Flag = 'N'"), "id") == [(2,)]
    assert rows(expire_soft_deleted(refined, *args, 4, 7, T[2]).filter("ETL_ActiveRow_Flag = 'N'"), "id") == [(1,), (2,)]
    assert rows(expire_retired(refined, *args, 5, 7, T[2]).filter("ETL_ActiveRow_Flag = 'N'"), "id") == [(3,)]
    both = expire_gone(refined, *args, 5, 7, T[2]).filter("ETL_ActiveRow_Flag = 'N'")
    assert rows(both, "id", n.LAST_RUN) == [(2, "7"), (3, "7")]


def test_propagation_spares_closed_versions_unless_compat(spark):
    refined = load(spark, load(spark, None, [(2, "a")], 1), [(2, "b")], 2)
    args = (driving(spark), ["id"], ["id"], 5, 7, T[3])
    guarded = {r["v"]: str(r[n.EXPIRY]) for r in expire_soft_deleted(refined, *args).collect()}
    assert guarded == {"a": T[1], "b": T[3]}
    every = {r["v"]: str(r[n.EXPIRY]) for r in expire_soft_deleted(refined, *args, compat=True).collect()}
    assert every == {"a": T[3], "b": T[3]}


def test_propagation_without_retired_column(spark):
    refined = load(spark, None, [(3, "a")], 1)
    out = expire_retired(refined, driving(spark).drop("retired"), ["id"], ["id"], 5, 7, T[2])
    assert rows(out, n.ACTIVE) == [("Y",)]


def test_composite_keys(spark):
    df = spark.createDataFrame([(1, "x", "a"), (1, "y", "a")], "k1 int, k2 string, v string")
    refined = scd2_initial(scd2_metadata(scd2_hash(df, ["k1", "k2"]), "sk", 1, T[0]), "sk", 1)
    gone = spark.createDataFrame([(1, "y", 9, "Y")], f"a int, b string, {n.RUN} int, {n.SOFT_DELETE} string")
    out = expire_soft_deleted(refined, gone, ["k1", "k2"], ["a", "b"], 5, 9, T[1])
    assert rows(out, "k2", n.ACTIVE) == [("x", "Y"), ("y", "N")]


def test_reconcile_after_expiry_counts_merge_closings_only(spark):
    first = load(spark, None, [(1, "a"), (2, "b"), (3, "c")], 1)
    src = source(spark, [(1, "A"), (2, "b"), (3, "c")], 2)
    merged = scd2_merge(first, number_inserts(src, first, "sk"), 2, T[1])
    gone = spark.createDataFrame([(3, 2, "Y")], f"id int, {n.RUN} int, {n.SOFT_DELETE} string")
    final = expire_soft_deleted(merged, gone, ["id"], ["id"], 1, 2, T[1])
    read = scd2_rows_read(src, first)
    assert rows(scd2_reconcile(read, final, 2, after_expiry=True)) == rows(scd2_reconcile(read, merged, 2))
    assert scd2_reconcile(read, merged, 2).first()["status"] == "S"


def test_surrogates_are_dense_in_hash_order(spark):
    df = spark.range(1000).select("id", F.md5(F.col("id").cast("string")).alias("h"))
    out = assign_surrogate(df, "sk", 100, key_hash="h", prefix=2).orderBy("h").collect()
    assert [r["sk"] for r in out] == list(range(101, 1101))


def test_surrogates_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, h string")
    assert assign_surrogate(df, "sk", key_hash="h").count() == 0


def test_new_rows_continue_after_the_highest(spark):
    df = spark.range(6).select(
        "id", F.md5(F.col("id").cast("string")).alias(n.KEY_HASH),
        F.when(F.col("id") < 3, F.col("id") + 7).otherwise(0).alias("sk"),
    )
    out = {r["id"]: r["sk"] for r in number_new_rows(df, "sk").collect()}
    assert [out[i] for i in range(3)] == [7, 8, 9]
    assert sorted(out[i] for i in range(3, 6)) == [10, 11, 12]
