"""Projections: audit columns, path columns, keys and small predicates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n


def as_timestamp(value) -> Column:
    """A run time given as text, datetime or Column, as a timestamp expression."""
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")


def named(df: DataFrame, column: str) -> str | None:
    """The spelling ``df`` uses for ``column`` (names compare without case), or None."""
    wanted = column.lower()
    return next((c for c in df.columns if c.lower() == wanted), None)


def path_segment(path: Column, from_right: int) -> Column:
    """Segment of a slash path counted from the right; ``name=value`` yields value."""
    segment = F.element_at(F.split(path, "/"), -from_right)
    return F.regexp_replace(segment, "^[^=]*=", "")


def last_segment(path: Column) -> Column:
    """Upper-cased last path segment: ``CC/cc_claim`` gives ``CC_CLAIM``."""
    return F.upper(F.element_at(F.split(path, "/"), -1))


def with_delivery_columns(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Add schema fingerprint and delivery time from ``.../fingerprint/delivery/file``."""
    path = F.col("_metadata.file_path") if path is None else path
    return df.select(
        "*",
        path_segment(path, 3).alias(n.FINGERPRINT),
        path_segment(path, 2).alias(n.DELIVERY),
    )


def with_audit(df: DataFrame, run_sk: int, run_ts, soft_delete: bool = True) -> DataFrame:
    """Add run id, load time, empty validation flag and (optionally) soft delete 'N'."""
    extra = {
        n.RUN: F.lit(run_sk).cast("int"),
        n.AUDIT_TS: as_timestamp(run_ts),
        n.VALIDATION: F.lit(None).cast("string"),
    }
    if soft_delete:
        extra[n.SOFT_DELETE] = F.lit("N")
    return df.withColumns(extra)


def spatial_to_hex(df: DataFrame, columns: Sequence[str] = n.SPATIAL_COLUMNS) -> DataFrame:
    """Replace each present ``{wkb, srid}`` struct by the hex text of its bytes."""
    present = [c for c in (named(df, wanted) for wanted in columns) if c]
    return df.withColumns({c: F.hex(F.col(f"`{c}`.wkb")) for c in present}) if present else df


def business_columns(
    columns: Iterable[str], keys: Iterable[str], exclusions: Iterable[str]
) -> list[str]:
    """Lower-cased columns that count as a change, in sorted order."""
    out = {c.strip().lower() for c in columns}
    skip = {c.strip().lower() for c in (*keys, *exclusions)}
    return sorted(out - skip)


def differs(left: Column, right: Column) -> Column:
    """NULL-safe inequality."""
    return ~left.eqNullSafe(right)


def epoch(column: str | Column) -> Column:
    """Delivery time text as a number, so that 999 sorts before 1000."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("bigint")


def drop_if_exists(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in (named(df, x) for x in columns) if c])
