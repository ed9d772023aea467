"""Queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors reach."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def public_vocabulary(name: str) -> str:
    """Path of an installed vocabulary file; every worker has it in the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)
