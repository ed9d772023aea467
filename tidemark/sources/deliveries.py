"""Delivery folders ``{root}/{table}/{fingerprint}/{delivery}/*.parquet``.

The raw zone that ``land_to_raw`` writes names its folders ``GW_FINGERPRINT=..`` and
``GW_TIMESTAMP=..``; every reader here understands both forms.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import names as n
from tidemark.functions.columns import path_segment, with_delivery_columns
from tidemark.session import hadoop_path

KEYS = ["table_name", "gw_fingerprint", "gw_timestamp"]


def folder(root: str, table: str, fingerprint: str, delivery: str, raw: bool = False) -> str:
    """Path of one delivery folder, in landing or raw form."""
    if raw:
        return f"{root}/{table}/{n.FINGERPRINT}={fingerprint}/{n.DELIVERY}={delivery}"
    return f"{root}/{table}/{fingerprint}/{delivery}"


def read_raw(spark: SparkSession, root: str, table: str, merge_schema: bool = False) -> DataFrame:
    """All deliveries of a table, with fingerprint and delivery columns from the path."""
    reader = spark.read.option("mergeSchema", merge_schema).option("recursiveFileLookup", True)
    return with_delivery_columns(reader.parquet(f"{root}/{table}"))


def read_folders(
    spark: SparkSession, paths: Sequence[str], merge_schema: bool = False
) -> DataFrame:
    """Exactly the named folders in one scan; with ``merge_schema`` missing columns are NULL."""
    reader = spark.read.option("mergeSchema", merge_schema).option("recursiveFileLookup", True)
    return with_delivery_columns(reader.parquet(*paths))


def read_zone(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the partitioned raw zone, so that filters on fingerprint and delivery prune
    folders. Both columns are read as text; Spark would otherwise guess numbers."""
    path = f"{root}/{table}"
    reader = spark.read.option("mergeSchema", True)
    text = {n.FINGERPRINT, n.DELIVERY}
    fields = [
        T.StructField(f.name, T.StringType() if f.name in text else f.dataType)
        for f in reader.parquet(path).schema.fields
    ]
    return reader.schema(T.StructType(fields)).parquet(path)


def _files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Path and size of every parquet file below ``paths``; contents are not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(paths)
    )
    return listing.select("path", "length")


def _parsed(files: DataFrame) -> DataFrame:
    path = F.col("path")
    return files.select(
        path_segment(path, 4).alias("table_name"),
        path_segment(path, 3).alias("gw_fingerprint"),
        path_segment(path, 2).alias("gw_timestamp"),
        "length",
    )


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if it does not exist."""
    fs, handle = hadoop_path(spark, path)
    if not fs.exists(handle):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(handle) if s.isDirectory()]
    return sorted(x for x in found if not x.startswith((".", "_")))


def _holds_rows(spark: SparkSession, path: str) -> bool:
    fs, handle = hadoop_path(spark, path)
    return any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(handle))


def list_deliveries(
    spark: SparkSession,
    root: str,
    xcenter: str,
    tables: Sequence[str] | None = None,
    after: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per delivery folder below ``root``, of all tables or of the named ones.

    Only folder names are listed, not the files of every delivery ever made. ``after`` gives a
    table's last known delivery time; older folders are not looked into.
    """
    after = after or {}

    def of_table(table: str) -> list[tuple[str, str, str]]:
        found = []
        for fingerprint in _names(spark, f"{root}/{table}"):
            for delivery in _names(spark, f"{root}/{table}/{fingerprint}"):
                time = delivery.split("=")[-1]
                if time.isdigit() and int(time) <= after.get(table.lower(), -1):
                    continue
                if _holds_rows(spark, f"{root}/{table}/{fingerprint}/{delivery}"):
                    found.append((table, fingerprint.split("=")[-1], time))
        return found

    wanted = _names(spark, root) if tables is None else sorted(tables)
    with ThreadPoolExecutor(max_workers=8) as pool:
        rows = [row for part in pool.map(of_table, wanted) for row in part]
    listed = spark.createDataFrame(rows, ", ".join(f"{k} string" for k in KEYS)).distinct()
    return listed.select(
        *KEYS, F.concat_ws("/", *KEYS).alias("cloud_path"), F.lit(xcenter).alias("xcenter")
    )


def folder_bytes(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per delivery folder."""
    return _parsed(_files(spark, [root])).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def land_to_raw(
    spark: SparkSession,
    pending: Iterable[tuple[str, str]],
    landing: str,
    raw: str,
    table: str,
) -> None:
    """Bring pending (fingerprint, delivery) folders of a table into the raw zone.

    One Spark job per schema version reads its folders and writes them partitioned by
    fingerprint and delivery. Only the partitions written are replaced, so a repeated run
    does not double rows.
    """
    by_fingerprint: dict[str, list[str]] = {}
    for fingerprint, delivery in pending:
        by_fingerprint.setdefault(fingerprint, []).append(delivery)
    for fingerprint, deliveries in sorted(by_fingerprint.items()):
        paths = [folder(landing, table, fingerprint, d) for d in sorted(deliveries)]
        (
            read_folders(spark, paths)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy(n.FINGERPRINT, n.DELIVERY)
            .parquet(f"{raw}/{table}")
        )


def write_delivery(
    df: DataFrame, root: str, table: str, fingerprint: str, delivery: str
) -> None:
    """Write one delivery folder as snappy parquet."""
    path = folder(root, table, fingerprint, delivery)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def folder_rows(df: DataFrame) -> DataFrame:
    """Rows per delivery, from a frame with fingerprint and delivery columns."""
    return df.groupBy(
        F.col(n.FINGERPRINT).alias("gw_fingerprint"), F.col(n.DELIVERY).alias("gw_timestamp")
    ).agg(F.count(F.lit(1)).alias("rows"))


def rows_reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows per delivery on both sides of a landing; 'S' when equal and not empty."""
    keys = ["gw_fingerprint", "gw_timestamp"]
    left = source.withColumnRenamed("rows", "rows_read")
    right = target.withColumnRenamed("rows", "rows_written")
    joined = left.join(right, keys, "left").fillna(0, ["rows_written"])
    equal = (F.col("rows_read") == F.col("rows_written")) & (F.col("rows_read") > 0)
    return joined.withColumn("status", F.when(equal, "S").otherwise("F"))
