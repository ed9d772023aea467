"""Schema versions, rows read, folded states, purged history: against plain versions, on odd rows."""

import random

import pytest
from helpers import plan, rows

from tidemark import names as n
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.fold import latest_state, merge_states, state_at
from tidemark.operators.purge import purge_history
from tidemark.operators.versions import fingerprint_changed, rows_read, rows_read_now, schema_versions

FILES = "table_name string, gw_fingerprint string, gw_timestamp string"


def plain_changes(files):
    """(table, time, fingerprint) -> previous fingerprint and whether it changed, in order."""
    key = lambda f: (int(f[2]), f[1] is not None, f[1] or "")
    out, runs = [], []
    for table in {f[0] for f in files}:
        before, seen, version = None, [], 0
        for f in sorted((f for f in files if f[0] == table), key=key):
            changed = before is not None and before[1] != f[1]
            out.append((table, f[1], f[2], before[1] if before else None, changed))
            if before is None or changed:
                version += 1
                runs.append([table, version, f[1], int(f[2]), int(f[2]), 0, f[1] in seen])
                seen.append(f[1])
            runs[-1][4], runs[-1][5] = int(f[2]), runs[-1][5] + 1
            before = f
    return sorted(out, key=repr), sorted(map(tuple, runs), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_changes_and_versions(spark, seed):
    draw = random.Random(seed)
    files = {
        (draw.choice(["a", "b", None]), draw.choice(["x", "y", None]), str(draw.randrange(0, 60))) for _ in range(80)
    }
    df = spark.createDataFrame(sorted(files, key=repr), FILES)
    changes, runs = plain_changes(files)
    # A stretch of time does not show in the result.
    for stretch in (1, 7, 1000):
        assert rows(fingerprint_changed(df, stretch)) == changes
        assert rows(schema_versions(df, stretch)) == runs


def test_no_deliveries(spark):
    none = spark.createDataFrame([], FILES + ", version int, extra string")
    assert fingerprint_changed(none).columns == [*none.columns, "previous_fingerprint", "fingerprint_changed"]
    assert fingerprint_changed(none).count() == schema_versions(none).count() == 0


def test_a_table_with_most_deliveries_is_split(spark):
    """The rows of a table meet by stretch of time; what is one task per table is one row a stretch."""
    shown = plan(schema_versions(spark.createDataFrame([("a", "x", "1")], FILES)))
    assert shown.count("hashpartitioning(table_name") == 2
    assert "_stretch" in shown[shown.rindex("hashpartitioning(table_name"):].split("\n")[0]


MANIFEST = "table_name string, written string, total string, extra int"


def test_rows_read(spark):
    entries = [("a", "1", "10", 0), ("a", "9", None, 0), ("a", "10", "30", 0), ("a", "10", "25", 1),
               ("a", "11", "31", 0), ("a", "12", "5", 0), ("a", "13", "7", 0), ("b", "5", "4", 0),
               ("b", "6", "no number", 0), ("b", "7", "4", 0), ("c", None, "3", 0), ("c", "1", "8", 0), (None, "1", "2", 0)]
    df = spark.createDataFrame(entries, MANIFEST)
    got = {(r[0], r[1], r[3]): tuple(r)[4:] for r in rows_read(df).collect()}
    assert got == {
        ("a", "1", 0): (None, False, 10), ("a", "9", 0): (10, False, None), ("a", "10", 0): (10, False, 20),
        ("a", "10", 1): (10, False, 15), ("a", "11", 0): (30, False, 1), ("a", "12", 0): (31, True, 5),
        ("a", "13", 0): (5, False, 2), ("b", "5", 0): (None, False, 4), ("b", "6", 0): (4, False, None),
        ("b", "7", 0): (4, False, 0), ("c", None, 0): (None, False, 3), ("c", "1", 0): (None, False, 8),
        (None, "1", 0): (None, False, 2),
    }
    newest = df.where("table_name = 'a' AND written = '11' OR table_name = 'b' AND written = '7' OR table_name IS NULL")
    now = {(r[0], r[1], r[3]): tuple(r)[4:] for r in rows_read_now(newest, df).collect()}
    assert now == {k: got[k] for k in (("a", "11", 0), ("b", "7", 0), (None, "1", 0))}
    assert rows_read(df.limit(0)).count() == rows_read_now(df.limit(0), df).count() == 0


FEED = f"id int, {n.DELIVERY} string, {n.PAYLOAD_TS} string, {n.SEQUENCE} string, value string"


def feed(spark, seed, size=120):
    draw = random.Random(seed)
    some = lambda *x: draw.choice([*x, None])
    rows_ = [(some(1, 2, 3), draw.choice("123456"), some("1", "2"), some("7", "8"), some("p", "q", "r")) for _ in range(size)]
    return spark.createDataFrame(rows_ + rows_[:5], FEED)


@pytest.mark.parametrize("seed", range(3))
def test_fold_is_the_latest_row(spark, seed):
    df = feed(spark, seed)
    assert rows(latest_state(df, ["id"])) == rows(latest_per_key(df, ["id"]))
    states = latest_state(df, ["id"], per=[n.DELIVERY])
    for cutoff in (0, 2, 4, 9):
        want = latest_per_key(df.where(f"CAST({n.DELIVERY} AS BIGINT) <= {cutoff}"), ["id"])
        assert rows(state_at(states, ["id"], cutoff)) == rows(want)
    # Any order, any cut, repeats.
    parts = [latest_state(df.where(f"{n.DELIVERY} = '{d}'"), ["id"]) for d in "351642"]
    folded = merge_states([merge_states(parts[:2], ["id"]), *parts[1:], parts[0]], ["id"])
    assert rows(folded) == rows(latest_per_key(df, ["id"]))


def test_fold_combines_before_the_shuffle(spark):
    shown = plan(latest_state(feed(spark, 0), ["id"]))
    assert "partial_max_by" in shown and "Window" not in shown


HISTORY = (
    f"sk bigint, {n.KEY_HASH} string, {n.CHANGE_HASH} string, {n.ACTIVE} string, a int, z int, note string"
)


def history(spark, versions):
    from pyspark.sql import functions as F

    day = lambda c: F.timestamp_seconds(F.col(c) * 86400)
    df = spark.createDataFrame(versions, HISTORY)
    return df.withColumns({n.EFFECTIVE: day("a"), n.EXPIRY: day("z"), n.CREATED: day("a")}).drop("a", "z")


def days(df):
    from pyspark.sql import functions as F

    return rows(df.select("sk", n.ACTIVE, *[F.unix_date(F.col(c).cast("date")).alias(c) for c in (n.EFFECTIVE, n.EXPIRY, n.CREATED)], "note"))


def test_purge(spark):
    df = history(spark, [
        (1, "k", "x", "N", 0, 5, "gone"), (2, "k", "y", "N", 5, 8, "joined"), (3, "k", "y", "N", 8, 12, "past"),
        (4, "k", "z", "N", 12, 14, "last"), (5, "k", "w", "Y", 14, 9999, "open"),
        (6, "m", "x", "N", 0, 4, "gone"), (7, "m", "y", "N", 4, 6, "last of its key"),
        (8, "p", "x", "N", 0, 3, "gap"), (9, "p", "x", "N", 4, 11, "gap"),
        (10, "q", None, "N", 0, 3, "no hash"), (11, "q", None, "N", 3, 11, "no hash"), (12, "r", "x", "N", 0, None, "no end"),
        (13, "s", "x", None, 0, 3, "no flag"),
    ])
    assert [r[0] for r in days(purge_history(df, "1970-01-11 00:00:00"))] == sorted([3, 4, 5, 7, 9, 11, 12, 13], key=lambda x: repr((x, 0)))
    got = {r[0]: r[2:5] for r in days(purge_history(df, "1970-01-11 00:00:00"))}
    assert got[3] == (5, 12, 5) and got[9] == (4, 11, 4) and got[11] == (3, 11, 3)
    again = purge_history(purge_history(df, "1970-01-11 00:00:00"), "1970-01-11 00:00:00")
    assert days(again) == days(purge_history(df, "1970-01-11 00:00:00"))
    assert purge_history(df.limit(0), "1970-01-11 00:00:00").count() == 0


def test_purge_shuffles_closed_versions_only(spark, tmp_path):
    df = history(spark, [(1, "k", "x", "N", 0, 5, "old"), (2, "k", "y", "Y", 5, 99, "open")])
    df.write.partitionBy(n.ACTIVE).parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h")).select(*df.columns)
    shown = plan(purge_history(stored, "1970-01-11 00:00:00"))
    assert shown.count("Exchange hashpartitioning") == 1 and shown.count("PartitionFilters: [") == 2
    assert "PartitionFilters: []" not in shown
