"""Tables of which a run rewrites only the parts its changes fall into.

Rows are dealt to a fixed number of buckets by a hash of their key. A write replaces whole buckets
and leaves the files of all others where they are; a small state file, put in place by one rename,
names the folder that holds each bucket, so readers see a write as a whole or not at all.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import hadoop_path, write_folders
from tidemark.sources.counting import Counting

#: Bytes meant for a bucket when a table is first written, and for a task and its file.
BUCKET_BYTES, FILE_BYTES = 4 << 30, 256 << 20
#: Folder columns; no table may have columns of these names.
WRITE, BUCKET = "tidemark__write", "tidemark__bucket"


class BucketTable:
    """``{path}/tidemark__write=<n>/tidemark__bucket=<k>`` and ``state-<n>.json``.

    The number of buckets belongs to the table: it is taken from the state once there is one. A first
    write whose size is told takes at least as many as its bytes ask for. A bucket is written by as
    many tasks, each with a file of its own, as its bytes ask for, so neither a large table nor one
    hot bucket (rows with NULL in the key share one) is left to a few tasks.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str] = ("id",), buckets: int = 16,
        keep: int = 2,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = tuple(keys)
        self.wanted = max(buckets, 1)
        self.keep = max(keep, 1)

    # ------------------------------------------------------------------ state

    def _numbers(self, prefix: str, suffix: str = "") -> list[int]:
        fs, root = hadoop_path(self.spark, self.path)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        cut = [x.removeprefix(prefix).removesuffix(suffix) for x in names if x.startswith(prefix)]
        return sorted(int(x) for x in cut if x.isdigit())

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return self._numbers("state-", ".json")

    def exists(self) -> bool:
        return bool(self.versions())

    def _state(self, version: int | None = None) -> dict:
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"no committed version under {self.path}")
        number = versions[-1] if version is None else version
        text = self.spark.read.text(f"{self.path}/state-{number}.json", wholetext=True)
        return json.loads(text.first()[0])

    @property
    def buckets(self) -> int:
        return self._state()["buckets"] if self.exists() else self.wanted

    def contents(self) -> dict[int, int]:
        """Bucket to the number of the write that holds it."""
        return {int(b): number for b, number in self._state()["folders"].items()} if self.exists() else {}

    def bucket_of(self, *keys: Column) -> Column:
        """Bucket of a row, from its key as text, so that a wider key type changes nothing."""
        keys = keys or tuple(F.col(f"`{k}`") for k in self.keys)
        return F.pmod(F.xxhash64(*[k.cast("string") for k in keys]), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets that hold the keys of ``rows``; at most as many as there are buckets."""
        found = rows.select(self.bucket_of().alias("b")).distinct().collect()
        return sorted(r["b"] for r in found)

    # ------------------------------------------------------------------- read

    def read(self, buckets: Iterable[int] | None = None, version: int | None = None) -> DataFrame:
        """All rows, or those of some buckets, as one scan of the folders that hold them."""
        state = self._state(version)
        schema = T.StructType.fromJson(state["schema"])
        chosen = state["folders"] if buckets is None else [str(b) for b in buckets]
        paths = [
            f"{self.path}/{WRITE}={state['folders'][b]}/{BUCKET}={b}"
            for b in chosen if b in state["folders"]
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType(
            [*schema.fields, T.StructField(WRITE, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())]
        )
        rows = self.spark.read.schema(stored).option("basePath", self.path).parquet(*paths)
        return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields])

    def read_or(self, default: DataFrame) -> DataFrame:
        return self.read() if self.exists() else default

    def register(self, name: str) -> None:
        self.read().createOrReplaceTempView(name)

    # ------------------------------------------------------------------ write

    def note(self, name: str, default=None):
        """What the last write noted under ``name``."""
        return self._state().get("notes", {}).get(name, default) if self.exists() else default

    def write(
        self, df: DataFrame, counting: Counting | None = None, notes: dict | None = None, size: int = 0
    ) -> DataFrame:
        """Commit a complete state; ``notes`` are committed with it, added to the earlier ones. ``size``
        is the bytes that are known to come, which counts where more than what is stored."""
        if not self.exists():
            self.wanted = max(self.wanted, -(-size // BUCKET_BYTES))
        return self._commit(df, None, counting, notes, size)

    def write_buckets(
        self, df: DataFrame, buckets: Sequence[int], counting: Counting | None = None, notes: dict | None = None
    ) -> DataFrame:
        """Commit new contents of ``buckets`` and return those rows; all other buckets stay. New
        columns are NULL there; a changed type needs ``write``."""
        old = {f["name"].lower(): f["type"] for f in self._state()["schema"]["fields"]}
        new = {f["name"].lower(): f["type"] for f in json.loads(df.schema.json())["fields"]}
        changed = sorted(c for c in old if c in new and old[c] != new[c]) + sorted(set(old) - set(new))
        if changed:
            raise ValueError(f"columns {changed} differ from the stored ones: write the whole table")
        return self._commit(df, list(buckets), counting, notes)

    def bytes_of(self, buckets: Iterable[int] | None = None) -> dict[int, int]:
        """Stored bytes of each bucket, or of some."""
        sizes = {}
        for b, number in self.contents().items():
            if buckets is None or b in buckets:
                fs, folder = hadoop_path(self.spark, f"{self.path}/{WRITE}={number}/{BUCKET}={b}")
                sizes[b] = fs.getContentSummary(folder).getLength()
        return sizes

    def _dealt(self, df: DataFrame, buckets: list[int] | None, size: int) -> DataFrame:
        """Rows dealt to tasks by bucket and, in a bucket of several files, by a hash of the row. Where
        nothing tells the bytes to come, AQE deals them by what the shuffle holds."""
        chosen = list(range(self.buckets)) if buckets is None else buckets
        stored = self.bytes_of(chosen)
        even = size // max(1, len(chosen))
        files = {b: max(1, -(-max(stored.get(b, 0), even) // FILE_BYTES)) for b in chosen}
        if not size and (buckets is None or max(files.values(), default=1) == 1):
            return df.hint("rebalance", BUCKET)
        firsts = dict(zip(files, accumulate(files.values(), initial=0)))
        firsts, several = (F.create_map(*[F.lit(x) for pair in m.items() for x in pair]) for m in (firsts, files))
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in self._hashable(df)]), F.coalesce(several[F.col(BUCKET)], F.lit(1)))
        to = (F.coalesce(firsts[F.col(BUCKET)], F.col(BUCKET)) + part).cast("int")
        return df.repartitionById(sum(files.values()), to)

    def _hashable(self, df: DataFrame) -> list[str]:
        """Columns that part the rows of a bucket: all but maps, which have no hash."""
        return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()] or [BUCKET]

    def _commit(
        self, df: DataFrame, buckets: list[int] | None, counting: Counting | None, notes: dict | None,
        size: int = 0,
    ) -> DataFrame:
        clash = {WRITE, BUCKET} & {c.lower() for c in df.columns}
        if clash:
            raise ValueError(f"{sorted(clash)} are no names for columns of a bucket table")
        count = self.buckets
        number = max([0, *self.versions(), *self._numbers(f"{WRITE}=")]) + 1
        folders = {} if buckets is None else self._state()["folders"]
        for b in buckets or ():
            folders.pop(str(b), None)
        dealt = df.withColumn(BUCKET, self.bucket_of())
        target = f"{self.path}/{WRITE}={number}"
        dealt = self._dealt(dealt, buckets, size)
        if counting:
            dealt = counting.on(dealt)
        write_folders(dealt, target, BUCKET)
        fs, handle = hadoop_path(self.spark, target)
        written = [s.getPath().getName() for s in fs.listStatus(handle) if s.isDirectory()]
        made = [x.split("=")[1] for x in written if x.startswith(f"{BUCKET}=")]
        state = {
            "buckets": count,
            "schema": json.loads(df.drop(*(counting.dropped if counting else ())).schema.json()),
            "folders": {**folders, **dict.fromkeys(made, number)},
            "notes": {**(self._state().get("notes", {}) if self.exists() else {}), **(notes or {})},
        }
        self._save(number, state)
        self._clean()
        return self.read(None if buckets is None else buckets)

    def _save(self, number: int, state: dict) -> None:
        fs, draft = hadoop_path(self.spark, f"{self.path}/.state-{number}.draft")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not fs.rename(draft, hadoop_path(self.spark, f"{self.path}/state-{number}.json")[1]):
            raise OSError(f"version {number} of {self.path} was written by another job")

    def _clean(self) -> None:
        """Remove what none of the last ``keep`` versions needs, failed writes included."""
        versions = self.versions()
        kept = versions[-self.keep :]
        needed = {(n, b) for v in kept for b, n in self._state(v)["folders"].items()}
        for number in self._numbers(f"{WRITE}="):
            if number >= kept[-1]:
                continue
            fs, folder = hadoop_path(self.spark, f"{self.path}/{WRITE}={number}")
            names = [s.getPath().getName() for s in fs.listStatus(folder)]
            held = {x for x in names if (number, x.split("=")[-1]) in needed}
            for name in held and [x for x in names if x.startswith(f"{BUCKET}=") and x not in held]:
                fs.delete(hadoop_path(self.spark, f"{self.path}/{WRITE}={number}/{name}")[1], True)
            if not held:
                fs.delete(folder, True)
        for version in versions[: -self.keep]:
            fs, file = hadoop_path(self.spark, f"{self.path}/state-{version}.json")
            fs.delete(file, False)
