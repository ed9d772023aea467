"""Counts that are taken in the write: right, and without a look at the new state."""

from helpers import rows
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.plans.jobspec import JobSpec
from tidemark.plans.refine import refine
from tidemark.plans.warehouse import Warehouse
from tidemark.sources.buckets import BucketTable
from tidemark.sources.counting import Counting
from tidemark.sources.snapshot import HistoryTable

SPEC = JobSpec(9, "detail", ("id",), "sk", "cc_claim", ("id",), "")


def executions(spark):
    store = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [store.apply(i).physicalPlanDescription() for i in range(store.size())]


def test_bucket_and_history_tables_count_what_they_write(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"), F.when(F.col("id") < 60, "Y").otherwise("N").alias("flag"))
    some = {"n": F.count(F.lit(1)), "k1": F.count_if(F.col("k") == 1), "big": F.coalesce(F.max("id"), F.lit(-1))}
    counting = Counting(some, ("k",))
    table = BucketTable(spark, str(tmp_path / "b"))
    assert table.write(df, counting).columns == ["id", "flag"]
    assert rows(counting.row(spark)) == [(100, 33, 99)]
    counting = Counting(some, ("k",))
    table.write_buckets(df.limit(0), [3], counting)
    assert rows(counting.row(spark)) == [(0, 0, -1)]
    counting = Counting(some, ("k",))
    HistoryTable(spark, str(tmp_path / "h"), "flag").write_all(df, counting)
    assert rows(counting.row(spark)) == [(100, 33, 99)]


def test_refine_does_not_read_the_state_it_wrote(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    driving = [(k, 2, "Y" if k == 3 else "N") for k in range(6)]
    wh.replica("cc_claim").write(spark.createDataFrame(driving, f"id int, {n.RUN} int, {n.SOFT_DELETE} string"))
    first = spark.createDataFrame([(k, "a", "1001") for k in range(4)], f"id int, v string, {n.DELIVERY} string")
    refine(wh, SPEC, first, 1, "2024-01-01 00:00:00", previous_run=9)
    before = len(executions(spark))
    second = spark.createDataFrame([(k, "b" if k == 2 else "a", "1002") for k in range(6)], f"id int, v string, {n.DELIVERY} string")
    metrics = refine(wh, SPEC, second, 2, "2024-01-02 00:00:00", previous_run=1).first()
    # Key 3 is closed by its delete, which is not an update of the load.
    assert (metrics["rows_read"], metrics["rows_inserted"], metrics["rows_updated"], metrics["status"]) == (3, 3, 1, "S")
    texts = executions(spark)[before:]
    writes = [i for i, text in enumerate(texts) if "InsertIntoHadoopFsRelationCommand" in text and "refined/detail" in text]
    assert writes and not any("refined/detail" in text and "Scan parquet" in text for text in texts[writes[-1] + 1 :])
