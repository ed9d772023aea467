"""Session settings and the shared folder used to cut lineage.

Nothing here is needed to call an operator; the jobs in ``tidemark.plans`` use
``Staging`` to write an intermediate result once and read it several times.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings every job relies on (all are runtime settings)."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or _set_by_caller(spark)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return _set_by_caller(spark)


def _set_by_caller(spark: SparkSession) -> str | None:
    folder = spark.sparkContext._jsc.sc().getCheckpointDir()
    return folder.get() if folder.isDefined() else None


def hadoop_path(spark: SparkSession, path: str):
    """(filesystem, path) handles of the file system that serves ``path``."""
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


#: Codec of stored tables: hex texts of hashes and digits take about half of what snappy leaves.
CODEC = "zstd"
#: Folders that one task writes side by side; beyond them it sorts its rows by folder.
OPEN_FOLDERS = "32"


def write_folders(df: DataFrame, path: str, *columns: str) -> None:
    """Write ``df`` to folders named by ``columns``. A task keeps a file open for each folder in place
    of sorting its rows by folder, which spills once they outgrow its memory."""
    df.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_FOLDERS)
    writer = df.write.mode("errorifexists").option("compression", CODEC)
    writer.partitionBy(*columns).parquet(path)


class Staging:
    """Parquet scratch tables of one job run; ``close()`` removes them.

    A written table survives the loss of executors, is read with column pruning,
    and makes every later read of the same intermediate result agree.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or shared_dir(spark)}/stage-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bytes_of(self, name: str) -> int:
        """Stored bytes of a table."""
        fs, handle = hadoop_path(self.spark, f"{self.root}/{name}")
        return fs.getContentSummary(handle).getLength()

    def close(self) -> None:
        fs, handle = hadoop_path(self.spark, self.root)
        fs.delete(handle, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_exc) -> None:
        self.close()


def has_at_most(df: DataFrame, rows: int) -> bool:
    """True when ``df`` holds no more than ``rows`` rows.

    The probe stops after ``rows + 1`` rows, so it is cheap on a staged table. It never
    removes rows from a result.
    """
    return df.limit(rows + 1).count() <= rows


def data_bytes(df: DataFrame) -> int:
    """Bytes of the values of ``df``: text and binary by length, nested values by their JSON
    text, everything else at 16 bytes."""
    sizes = [F.lit(16 * len(df.columns)).cast("long")]
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)))
    return df.agg(F.sum(reduce(add, sizes)).alias("bytes")).first()["bytes"] or 0


def fits_broadcast(df: DataFrame, rows: int = 200_000, limit: int = 64 << 20) -> bool:
    """True when a staged ``df`` is small enough, in rows and in bytes, to be sent to every
    executor. Both are measured, not estimated."""
    return has_at_most(df, rows) and data_bytes(df) <= limit
