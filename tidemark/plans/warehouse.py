"""Where a pipeline keeps its zones and control tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import names as n
from tidemark.sources.buckets import BucketTable
from tidemark.sources.snapshot import HistoryTable, LogTable, SnapshotTable

# --- fixed values: control table columns -----------------------------------------
CONTROL = {
    "manifest": (
        "datafilespath string, lastsuccessfulwritetimestamp string, "
        "schemahistory map<string,string>, totalprocessedrecordscount string, "
        "xcenter string, audit_dt_tm string, cyc_run_sk int"
    ),
    "table_load_metadata": (
        "table_id int, table_name string, latest_lastsuccessfulwritetimestamp string, "
        "previous_lastsuccessfulwritetimestamp string, latest_fingerprint string, "
        "previous_fingerprint string, load_status string, insert_date_time timestamp, "
        "update_date_time timestamp, xcenter string, cyc_run_sk int"
    ),
    "file_loads": (
        "file_load_id bigint, table_name string, gw_fingerprint string, gw_timestamp string, "
        "cloud_path string, is_loaded boolean, insert_date_time timestamp, "
        "update_date_time timestamp, xcenter string, cyc_run_sk int"
    ),
    "raw_table_load": (
        "table_name string, gw_fingerprint string, gw_timestamp string, cloud_path string, "
        "xcenter string, cyc_run_sk int"
    ),
    "jobs": (
        "job_sk int, job_nm string, step_sk int, job_desc string, job_typ_cd string, "
        "src_file_tbl string, tgt_file_tbl string, job_sts_cd string, acti_ind string, "
        "aud_dt_tm timestamp, cur_cyc_valid string"
    ),
}
CONTROL["replica_load"] = CONTROL["raw_table_load"]
CONTROL["manifest_archive"] = CONTROL["manifest"]
CONTROL["file_loads_archive"] = CONTROL["file_loads"]


#: Control tables that only grow; every other one is replaced by its new state.
LOGS = (
    "raw_table_load", "replica_load", "file_loads_archive", "balance_metrics", "validation_error_log",
    "validation_runs",
)


class Warehouse:
    """Folders below one root that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.buckets = buckets
        self.root = root.rstrip("/")
        self.raw = f"{self.root}/raw"

    def control(self, name: str) -> SnapshotTable | LogTable:
        kind = LogTable if name in LOGS else SnapshotTable
        return kind(self.spark, f"{self.root}/control/{name}")

    def control_rows(self, name: str) -> DataFrame:
        """Current rows of a control table; empty before its first write."""
        return self.control(name).read_or(self.spark.createDataFrame([], CONTROL[name]))

    def replica(self, table: str) -> BucketTable:
        """A run rewrites the buckets its changes fall into; ``buckets`` is set for new tables."""
        return BucketTable(self.spark, f"{self.root}/replica/{table}", ("id",), self.buckets)

    def refined(self, table: str) -> HistoryTable:
        return HistoryTable(self.spark, f"{self.root}/refined/{table}", n.ACTIVE)

    def balance_source(self, table: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/balance/{table}")

    def partials(self, table: str) -> SnapshotTable:
        """Partial aggregates of a replica, for the balance."""
        return SnapshotTable(self.spark, f"{self.root}/balance/{table}_partials")

    def claim_numbers(self) -> LogTable:
        """Dense numbers of the claim numbers, which bitmaps of partial aggregates are over."""
        return LogTable(self.spark, f"{self.root}/balance/claim_numbers")

    def publish_replicas(self, tables: list[str]) -> None:
        """Make current replicas visible to SQL under their table names."""
        for table in tables:
            if self.replica(table).exists():
                self.replica(table).register(table)
