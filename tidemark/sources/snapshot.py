"""Tables that are replaced as a whole.

Plain Spark refuses to overwrite a path it reads from. A snapshot table writes every new
state to ``{path}/v=<number>`` and readers take the highest version that holds the
``_SUCCESS`` file Spark writes last, so a failed or unfinished write is never seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.session import CODEC, hadoop_path, write_folders
from tidemark.sources.counting import Counting


class SnapshotTable:
    def __init__(
        self, spark: SparkSession, path: str, partition_by: Sequence[str] = (), keep: int = 2
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = tuple(partition_by)
        self.keep = max(keep, 1)

    def _numbers(self, committed: bool) -> list[int]:
        fs, root = hadoop_path(self.spark, self.path)
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("v=") and (not committed or self._done(name)):
                found.append(int(name[2:]))
        return sorted(found)

    def _done(self, name: str) -> bool:
        fs, marker = hadoop_path(self.spark, f"{self.path}/{name}/_SUCCESS")
        return fs.exists(marker)

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return self._numbers(committed=True)

    def exists(self) -> bool:
        return bool(self.versions())

    def location(self, version: int | None = None) -> str:
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"no committed version under {self.path}")
        return f"{self.path}/v={versions[-1] if version is None else version}"

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.location(version))

    def read_or(self, default: DataFrame) -> DataFrame:
        """Current state, or ``default`` (usually an empty frame) before the first write."""
        return self.read() if self.exists() else default

    def write(self, df: DataFrame) -> DataFrame:
        """Commit ``df`` as the next version and return it as read back."""
        number = max(self._numbers(committed=False), default=0) + 1
        writer = df.write.mode("errorifexists").option("compression", CODEC)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/v={number}")
        self._clean()
        return self.read(number)

    def append(self, df: DataFrame) -> DataFrame:
        """Commit the current rows plus ``df``; for small control tables."""
        if self.exists():
            df = self.read().unionByName(df, allowMissingColumns=True)
        return self.write(df)

    def register(self, name: str, across_sessions: bool = False) -> None:
        """Make the current version visible to SQL, in this session or (under
        ``global_temp``) in all sessions of the application."""
        if across_sessions:
            self.read().createOrReplaceGlobalTempView(name)
        else:
            self.read().createOrReplaceTempView(name)

    def save_as_table(self, name: str) -> None:
        """Register the current version in the catalog, without moving its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.catalog.createTable(name, path=self.location(), source="parquet")

    def _clean(self) -> None:
        committed = self.versions()
        # A write that failed leaves a folder without the marker; those below the newest
        # committed version will never get one.
        left = [n for n in self._numbers(committed=False) if n not in committed and n < committed[-1]]
        for number in [*committed[: -self.keep], *left]:
            fs, old = hadoop_path(self.spark, f"{self.path}/v={number}")
            fs.delete(old, True)


class LogTable:
    """A table that only grows: each append is one committed folder, nothing is rewritten.

    Appends do not depend on each other, so jobs may append side by side. Folders have the
    columns of the first one; rows that lack a column hold NULL there.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folders(self) -> list[str]:
        fs, root = hadoop_path(self.spark, self.path)
        if not fs.exists(root):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(root))
        paths = [f"{self.path}/{name}" for name in names if name.startswith("rows-")]
        return [p for p in paths if fs.exists(hadoop_path(self.spark, f"{p}/_SUCCESS")[1])]

    def exists(self) -> bool:
        return bool(self._folders())

    def read(self) -> DataFrame:
        folders = self._folders()
        if not folders:
            raise FileNotFoundError(f"nothing was appended to {self.path}")
        schema = self.spark.read.parquet(folders[0]).schema
        return self.spark.read.schema(schema).parquet(*folders)

    def read_or(self, default: DataFrame) -> DataFrame:
        return self.read() if self.exists() else default

    def append(self, df: DataFrame) -> None:
        df.write.mode("errorifexists").option("compression", CODEC).parquet(
            f"{self.path}/rows-{uuid.uuid4().hex}"
        )


#: Partition column of the folders of a history table; no table may have a column of this name.
VERSION = "tidemark__version"


class HistoryTable:
    """A history table whose closed versions are written once.

    ``{path}/tidemark__version=<n>`` is split by the active flag. Its active part holds ALL versions
    open after run n, its closed part only those CLOSED by run n; in ``…=<n>-full`` both
    are complete. The current state is the active part of the last version plus the closed
    parts since the last full one. A run thus writes as many rows as are open, however long
    the history is, and one Spark write commits both parts.
    """

    def __init__(self, spark: SparkSession, path: str, flag: str, keep: int = 2):
        self.spark = spark
        self.path = path.rstrip("/")
        self.flag = flag
        self.keep = max(keep, 1)

    def _at(self, relative: str):
        return hadoop_path(self.spark, f"{self.path}/{relative}")

    def _has(self, relative: str) -> bool:
        fs, handle = self._at(relative)
        return fs.exists(handle)

    def _folders(self, committed: bool = True) -> list[tuple[int, str]]:
        """(number, folder name) of the versions, oldest first."""
        fs, root = hadoop_path(self.spark, self.path)
        if not fs.exists(root):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(root)]
        names = [x for x in names if x.startswith(f"{VERSION}=")]
        found = [(int(x.split("=")[1].split("-")[0]), x) for x in names]
        return sorted(f for f in found if not committed or self._has(f"{f[1]}/_SUCCESS"))

    def exists(self) -> bool:
        return bool(self._folders())

    def _since_full(self) -> list[tuple[int, str]]:
        folders = self._folders()
        if not folders:
            raise FileNotFoundError(f"no committed version under {self.path}")
        start = max(i for i, (_, name) in enumerate(folders) if name.endswith("-full"))
        return folders[start:]

    def read(self) -> DataFrame:
        """Current state, as one scan. Rows of versions older than a column hold NULL there."""
        folders = self._since_full()
        number, newest = folders[-1]
        parts = [f"{name}/{self.flag}=N" for _, name in folders] + [f"{newest}/{self.flag}=Y"]
        paths = [f"{self.path}/{part}" for part in parts if self._has(part)]
        schema = self._schema(number)
        if not paths:
            return self.spark.createDataFrame([], schema)
        partitions = [T.StructField(VERSION, T.StringType())]
        stored = T.StructType([f for f in schema.fields if f.name != self.flag] + partitions
                              + [T.StructField(self.flag, T.StringType())])
        rows = self.spark.read.schema(stored).option("basePath", self.path).parquet(*paths)
        return rows.select(*[f.name for f in schema.fields])

    def parts(self) -> int:
        """Versions that a read has to gather."""
        return len(self._since_full()) if self.exists() else 0

    def write_all(self, df: DataFrame, counting: Counting | None = None) -> DataFrame:
        """Commit a complete state: the first load, a compaction, or a rewritten history."""
        return self._commit(df, "-full", counting)

    def write_step(self, df: DataFrame, counting: Counting | None = None) -> DataFrame:
        """Commit a run: every version that is open now, and those the run closed."""
        return self._commit(df, "" if self.exists() else "-full", counting)

    def compact(self) -> DataFrame:
        """Gather the closed parts of all runs in one new full version."""
        return self.write_all(self.read())

    def _commit(self, df: DataFrame, suffix: str, counting: Counting | None = None) -> DataFrame:
        if counting:
            df = counting.on(df)
        if VERSION in (c.lower() for c in df.columns):
            raise ValueError(f"{VERSION} is no name for a column of a history table")
        number = max((k for k, _ in self._folders(committed=False)), default=0) + 1
        self._save_schema(number, df.schema)
        write_folders(df, f"{self.path}/{VERSION}={number}{suffix}", self.flag)
        self._clean()
        return self.read()

    def _save_schema(self, number: int, schema: T.StructType) -> None:
        fs, handle = self._at(f"schema-{number}.json")
        out = fs.create(handle, True)
        out.write(bytearray(schema.json().encode()))
        out.close()

    def _schema(self, number: int) -> T.StructType:
        text = self.spark.read.text(f"{self.path}/schema-{number}.json", wholetext=True)
        return T.StructType.fromJson(json.loads(text.first()[0]))

    def _clean(self) -> None:
        """Drop active parts nobody reads any more, and everything before the last full
        version; the last ``keep`` versions stay readable."""
        folders = self._folders()
        needed = {name for _, name in self._since_full()}
        for _, name in folders[: -self.keep]:
            relative = f"{name}/{self.flag}=Y" if name in needed else name
            if self._has(relative):
                fs, handle = self._at(relative)
                fs.delete(handle, True)
