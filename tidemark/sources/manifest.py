"""Manifest file: one JSON object keyed by table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import as_timestamp

ENTRY = (
    "struct<dataFilespath:string, lastSuccessfulWriteTimestamp:string, "
    "schemaHistory:map<string,string>, totalProcessedRecordsCount:string>"
)


def read_manifest(
    spark: SparkSession, path: str, xcenter: str, run_sk: int, run_ts
) -> DataFrame:
    """One row per table entry; the schema history stays a map.

    The object's keys are data, so it is parsed as a map: no column per table and no schema
    inference.
    """
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", f"map<string,{ENTRY}>")).alias("_k", "_e"))
    return entries.select(
        F.col("_e.dataFilespath").alias("datafilespath"),
        F.col("_e.lastSuccessfulWriteTimestamp").alias("lastsuccessfulwritetimestamp"),
        F.col("_e.schemaHistory").alias("schemahistory"),
        F.col("_e.totalProcessedRecordsCount").alias("totalprocessedrecordscount"),
        F.lit(xcenter).alias("xcenter"),
        F.date_format(as_timestamp(run_ts), "yyyy-MM-dd HH:mm:ss").alias("audit_dt_tm"),
        F.lit(run_sk).alias("cyc_run_sk"),
    )
