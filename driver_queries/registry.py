"""Registry, table access, and SQL text that both engines understand."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import CODEC, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given parquet tables of one scale, and views derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self, name: str) -> str:
        """A new path in the shared folder."""
        return f"{shared_dir(self.spark)}/driver-{name}-{uuid.uuid4().hex}"

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Write a derived table once, as the jobs do, and read it back."""
        path = self.scratch(name)
        df.write.option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Run SQL whose ``{name}`` fields are the given frames or tables."""
        used = {field for _, field, _, _ in Formatter().parse(text) if field}
        return self.spark.sql(text, **{u: frames.get(u) or self.table(u) for u in used})


def portable(text: str) -> str:
    """The same text with plain table names, for the SQL check."""
    used = {field for _, field, _, _ in Formatter().parse(text) if field}
    return text.format(**{u: u for u in used})


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``, with its check SQL if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Show timestamps as text, alike in both engines."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})
