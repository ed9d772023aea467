"""Scratch tables of an operator, with what their making leaves behind given back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import Staging

#: Drops a query's shuffle files when it ends; a written table does not need them any more.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch(Staging):
    """As ``Staging``: each table is written once to the shared folder and read from there, so a
    lost executor costs no recomputation. The shuffles behind a written table are dropped at once,
    so a job of several steps takes the disk of its largest step, not of all."""

    def put(self, df: DataFrame, name: str) -> DataFrame:
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            return super().put(df, name)
        finally:
            self.spark.conf.set(CLEANUP, before)
