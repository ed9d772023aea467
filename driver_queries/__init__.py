"""Queries the driver runs on its tables, each with the SQL that must give the same rows."""

from driver_queries import balance, cdc, control, files, jobs, quality, refined, scd2, versions  # noqa: F401
from driver_queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
