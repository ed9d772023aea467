"""Change-data-capture deliveries to replica and history tables, on plain Spark."""

__version__ = "0.1.0"
