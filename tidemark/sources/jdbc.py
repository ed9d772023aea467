"""Control tables in a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table_or_query: str,
    is_query: bool = False,
    driver: str | None = None,
    timeout: int = 60,
    fetch_size: int = 10_000,
    split: tuple[str, int, int, int] | None = None,
) -> dict[str, str]:
    """Reader options; ``split`` = (numeric column, lower, upper, partitions).

    A split read needs a table form, so a query is then wrapped as a derived table.
    """
    options = {"url": url, "queryTimeout": str(timeout), "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if split:
        column, lower, upper, partitions = split
        options["dbtable"] = f"({table_or_query}) split_source" if is_query else table_or_query
        options["partitionColumn"] = column
        options["lowerBound"] = str(lower)
        options["upperBound"] = str(upper)
        options["numPartitions"] = str(partitions)
    else:
        options["query" if is_query else "dbtable"] = table_or_query
    return options


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, **options) -> DataFrame:
    """Whole table, or a query that the database runs."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table_or_query, **options)).load()


def append_jdbc(
    df: DataFrame, url: str, table: str, driver: str | None = None, connections: int = 8
) -> None:
    """Append rows over a bounded number of connections."""
    properties = {"numPartitions": str(connections), "batchsize": "10000"}
    if driver:
        properties["driver"] = driver
    df.write.jdbc(url, table, mode="append", properties=properties)
