"""Counts taken while a table is written, so that its new state need not be read for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


class Counting:
    """Aggregates over the rows of one write, by name; they must not be NULL on no rows.

    The rows are observed after the last shuffle, in the stage that writes the files. Spark counts
    each partition of that stage once, when its task is accepted: neither a retried or speculative
    task nor a shuffle computed again after an executor is lost counts twice. ``dropped`` names
    columns that the aggregates need and the table does not get.
    """

    def __init__(self, columns: dict[str, Column], dropped: tuple[str, ...] = ()):
        self.columns = columns
        self.dropped = dropped
        self.observation = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        """``df`` as it goes into the write."""
        named = [c.alias(name) for name, c in self.columns.items()]
        return df.observe(self.observation, *named).drop(*self.dropped)

    def row(self, spark) -> DataFrame:
        """The counts as one row; waits for the write."""
        values = self.observation.get
        schema = ", ".join(f"`{name}` bigint" for name in self.columns)
        return spark.createDataFrame([tuple(values[name] for name in self.columns)], schema)
