from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import control as c
from tidemark.plans.jobspec import JobSpec, render_sql
from tidemark.plans.warehouse import CONTROL

NOW = "2024-03-01 00:00:00"
FILES = "table_name string, gw_fingerprint string, gw_timestamp string, xcenter string"


def listed(spark, *data):
    df = spark.createDataFrame([(*d, "CC") for d in data], FILES)
    return df.withColumn("cloud_path", F.concat_ws("/", "table_name", "gw_fingerprint", "gw_timestamp"))


def metadata(spark, *data):
    """(table, latest, previous, status)"""
    full = [(i, t, latest, prev, "f0", None, st, None, None, "CC", 1) for i, (t, latest, prev, st) in enumerate(data, 1)]
    return spark.createDataFrame(full, CONTROL["table_load_metadata"])


def history(spark, *data):
    return spark.createDataFrame(list(data), "table_name string, fingerprint string")


def test_detect_full_then_only_newer(spark):
    found = listed(spark, ("cc_a", "f", "999"), ("cc_a", "f", "1000"), ("cc_a", "g", "1001"), ("cc_b", "f", "5"))
    known_pairs = history(spark, ("CC_A", "f"), ("CC_A", "g"), ("CC_B", "f"))
    meta = metadata(spark, ("CC_A", "1001", "999", "I"), ("CC_B", "5", None, "I"))
    nothing = found.limit(0)
    assert c.detect_new(found, meta, nothing, known_pairs).count() == 4
    assert rows(c.load_type(nothing)) == [("FULL",)]
    known = found.filter("gw_timestamp in ('999', '5')")
    assert rows(c.detect_new(found, meta, known, known_pairs), "gw_timestamp") == [("1000",), ("1001",)]
    assert rows(c.load_type(known)) == [("INCREMENTAL",)]
    # equal timestamps are not news; a fingerprint the manifest does not know is not listed
    assert c.detect_new(found, meta, found, known_pairs).count() == 0
    assert rows(c.detect_new(found, meta, known, history(spark, ("CC_A", "g"))), "gw_timestamp") == [("1001",)]


def test_new_files_identity(spark):
    found = listed(spark, ("cc_a", "f", "1"), ("cc_a", "g", "1"), ("cc_b", "f", "1"))
    meta = metadata(spark, ("CC_A", "1", None, "I"), ("CC_B", "1", None, "C"))
    known = listed(spark, ("cc_a", "f", "1"))
    assert rows(c.new_files(found, meta, known, 7), "gw_fingerprint", "cyc_run_sk") == [("g", 7)]
    assert c.new_files(found, meta, known, 7, compat=True).count() == 0


def test_shift_is_idempotent_unless_compat(spark):
    meta = metadata(spark, ("CC_A", "10", "5", "C"), ("CC_X", "1", None, "C"))
    manifest = spark.createDataFrame(
        [("CC/cc_a", "20", {"f0": "1", "f9": "15"}, "3", "CC", NOW, 2)], CONTROL["manifest"]
    )
    once = c.shift_load_metadata(meta, manifest, 2, NOW, "CC")
    shown = ("table_name", "latest_lastsuccessfulwritetimestamp", "previous_lastsuccessfulwritetimestamp",
             "latest_fingerprint", "previous_fingerprint", "load_status", "cyc_run_sk")
    expected = [("CC_A", "20", "10", "f9", "f0", "I", 2), ("CC_X", "1", None, "f0", None, "C", 1)]
    assert rows(once, *shown) == expected
    assert rows(c.shift_load_metadata(once, manifest, 2, NOW, "CC"), *shown) == expected
    twice = c.shift_load_metadata(once, manifest, 2, NOW, "CC", compat=True)
    assert rows(twice, *shown)[0][1:4] == ("20", "20", "f0")


def test_latest_fingerprint_without_history(spark):
    df = spark.createDataFrame([({},), (None,)], "schemahistory map<string,string>")
    assert rows(df.select(c.latest_fingerprint().alias("x"))) == [(None,), (None,)]


def jobs(spark, *data):
    """(job_sk, table, type, status, active, valid)"""
    full = [(j, "n", 10, "d", typ, t, t, st, act, None, val) for j, t, typ, st, act, val in data]
    return spark.createDataFrame(full, CONTROL["jobs"])


def test_sync_adds_missing_jobs_and_sets_validity(spark):
    meta = metadata(spark, ("CC_A", "1", None, "I"), ("CC_B", "1", None, "C"), ("CC_C", "1", None, "I"))
    out = c.sync_job_list(jobs(spark, (10001, "cc_b", "RAW", "F", "Y", "Y")), meta, 10, "RAW", "raw", "CC", NOW)
    assert rows(out, "job_sk", "tgt_file_tbl", "job_sts_cd", "cur_cyc_valid") == [
        (10001, "cc_b", "C", "N"), (10002, "cc_a", "C", "Y"), (10003, "cc_c", "C", "Y"),
    ]
    first = c.sync_job_list(jobs(spark), meta, 10, "RAW", "raw", "CC", NOW)
    assert rows(first, "job_sk")[0] == (10001,)


def test_ready_jobs(spark):
    meta = metadata(spark, ("CC_A", "1", None, "C"), ("CC_B", "1", None, "I"))
    all_jobs = jobs(
        spark, (1, "cc_a", "RPL", "C", "Y", "Y"), (2, "cc_b", "RPL", "C", "Y", "Y"), (3, "cc_a", "RPL", "I", "Y", "Y"),
        (4, "cc_a", "RPL", "C", "N", "Y"), (5, "cc_a", "RPL", "C", "Y", "N"), (6, "cc_a", "RAW", "C", "Y", "Y"),
    )
    assert rows(c.ready_for_replica(all_jobs, meta, 10, "CC", 9), "job_sk", "cyc_run_sk") == [(1, 9)]


def files(spark, *data):
    """(table, ts, loaded, registered)"""
    full = [(i, t, "f", ts, "p", loaded, reg, reg, "CC", 1) for i, (t, ts, loaded, reg) in enumerate(data)]
    schema = CONTROL["file_loads"].replace("timestamp", "string").replace("gw_string", "gw_timestamp")
    df = spark.createDataFrame(full, schema)
    return df.withColumns({x: F.col(x).cast("timestamp") for x in ("insert_date_time", "update_date_time")})


def test_pending_window_and_files(spark):
    f = files(spark, ("cc_a", "999", False, NOW), ("cc_a", "1000", False, NOW), ("cc_a", "5", True, NOW), ("cc_b", "7", True, NOW))
    j = jobs(spark, (1, "cc_a", "RAW", "C", "Y", "Y"), (2, "cc_b", "RAW", "C", "Y", "Y"))
    assert rows(c.pending_window(j, f, 10, "CC"), "table_name", "start_timestamp", "end_timestamp") == [("cc_a", 999, 1000)]
    assert [r["gw_timestamp"] for r in c.pending_files(f, "CC_A", "CC", 0, 5000).collect()] == ["999", "1000"]
    done = c.mark_loaded(f, "CC_A", "CC", 999, NOW)
    ends = spark.createDataFrame([("cc_a", 999)], "table_name string, end_timestamp bigint")
    assert rows(c.mark_loaded_until(f, ends, "CC", NOW)) == rows(done)
    assert rows(done, "gw_timestamp", "is_loaded") == [("1000", False), ("5", True), ("7", True), ("999", True)]


def test_archive_moves_old_loaded_rows_only(spark):
    f = files(spark, ("a", "1", True, "2024-01-29 00:00:00"), ("b", "1", True, "2024-02-01 00:00:00"), ("c", "1", False, "2024-01-01 00:00:00"))
    kept, archive = c.archive_older_than(f, f.limit(0), NOW, "CC")
    assert rows(archive, "table_name") == [("a",)]
    assert rows(kept, "table_name") == [("b",), ("c",)]


def test_archive_then_replace_keeps_other_centres(spark):
    cur = spark.createDataFrame([(1, "CC"), (2, "PC"), (3, None)], "id int, xcenter string")
    new = spark.createDataFrame([(9, "CC")], "id int, xcenter string")
    now, old = c.archive_then_replace(cur, cur.limit(0), new, "CC")
    assert rows(now, "id") == [(2,), (3,), (9,)]
    assert rows(old, "id") == [(1,)]


def test_restart_flags(spark):
    cycles = spark.createDataFrame([(1, "I"), (2, "F"), (3, "F"), (4, "S"), (5, "I")], "cyc_run_sk int, cyc_sts_cd string")
    steps = spark.createDataFrame(
        [(1, 1, 10, "F"), (2, 1, 10, "I"), (3, 2, 10, "F"), (4, 3, 10, "S"), (5, 4, 10, "S"), (6, 2, 11, "S")],
        "step_run_sk int, cyc_run_sk int, step_sk int, step_sts_cd string",
    )
    assert rows(c.restart_flags(cycles, steps, 10)) == [
        (1, "Y", "N"), (2, "N", "Y"), (3, "N", "N"), (4, "Y", "N"), (5, "Y", "N"),
    ]
    assert rows(c.previous_good_run(steps, 10)) == [(4,)]
    assert rows(c.previous_good_run(steps, 99)) == [(0,)]
    assert rows(c.cycle_status(steps, ["cyc_run_sk"])) == [(1, "F"), (2, "F"), (3, "S"), (4, "S")]


def test_job_spec_joins_query_parts_in_order(spark):
    all_jobs = spark.createDataFrame([(1, "claim_detail"), (2, "other")], "job_sk int, tgt_file_tbl string")
    values = [
        ("tfm_query_2", "FROM @catalog.@src_schema.cc_claim"), ("src_keys", "id, part"), ("SurrogateKey", "sk"),
        ("partition", ""), ("scdexclusions", "a,b"), ("Driving_Table", "cc_claim"), ("Driving_Table_PK", "id,part"),
        ("tfm_query_1", "SELECT *"),
    ]
    order = {"tfm_query_1": 1, "tfm_query_2": 2}
    params = spark.createDataFrame(
        [(order.get(k, 9), 1, k, v) for k, v in values], "parm_sk int, job_sk int, parm_nm string, parm_val string"
    )
    spec = JobSpec.load(all_jobs, params, 1)
    assert spec.query == "SELECT * FROM @catalog.@src_schema.cc_claim"
    assert (spec.keys, spec.driving_keys, spec.exclusions) == (("id", "part"), ("id", "part"), ("a", "b"))
    assert render_sql(spec.query, "cat", "sch") == "SELECT * FROM cat.sch.cc_claim"
    assert render_sql(spec.query) == "SELECT * FROM cc_claim"


def test_shift_stays_within_the_centre(spark):
    meta = metadata(spark, ("CC_A", "10", "5", "C"))
    both = meta.unionByName(meta.withColumn("xcenter", F.lit("PC")))
    manifest = spark.createDataFrame(
        [("PC/cc_a", "20", {"f9": "15"}, "3", "PC", NOW, 2)], CONTROL["manifest"]
    )
    moved = c.shift_load_metadata(both, manifest, 2, NOW, "PC")
    shown = ("xcenter", "latest_lastsuccessfulwritetimestamp", "load_status")
    assert rows(moved, *shown) == [("CC", "10", "C"), ("PC", "20", "I")]
    assert rows(c.new_table_metadata(meta, manifest, "PC")) == [("CC_A",)]
