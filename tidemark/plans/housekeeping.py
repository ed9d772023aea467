"""End-of-cycle copies and archives."""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.operators.control import older_than, snapshot_copy
from tidemark.plans.parallel import for_each
from tidemark.plans.warehouse import CONTROL, Warehouse

BACKED_UP = (
    "manifest", "manifest_archive", "table_load_metadata", "file_loads", "file_loads_archive",
    "raw_table_load", "replica_load", "jobs",
)
#: Runs after which the closed versions of a history table are gathered.
MOST_PARTS = 24


def housekeeping(
    wh: Warehouse,
    xcenter: str,
    now,
    days: int = 30,
    tables: Sequence[str] = BACKED_UP,
    refined: Sequence[str] = (),
    most_parts: int = MOST_PARTS,
) -> None:
    """Copy the control tables of a centre to ``<name>_backup``, move old file rows, and compact
    the named history tables that have gathered more than ``most_parts`` parts."""

    def back_up(name: str) -> None:
        wanted = xcenter if "xcenter" in CONTROL[name] else None
        wh.control(f"{name}_backup").write(snapshot_copy(wh.control_rows(name), wanted))

    for_each(wh.spark, back_up, list(tables))
    archive_files(wh, xcenter, now, days)
    for name in refined:
        if wh.refined(name).parts() > most_parts:
            wh.refined(name).compact()


def archive_files(wh: Warehouse, xcenter: str, now, days: int = 30) -> None:
    """Move old file rows to the archive. The archive is only appended to, first, with the rows it does
    not hold yet; then the file table is written without them. A run that dies between the two leaves
    the rows in both, and the next one takes them out of the file table without archiving them again."""
    kept, moved = older_than(wh.control_rows("file_loads"), now, xcenter, days)
    there = wh.control_rows("file_loads_archive").select("file_load_id")
    moved = moved.join(there, "file_load_id", "left_anti").select(*kept.columns)
    if not moved.isEmpty():
        wh.control("file_loads_archive").append(moved)
    wh.control("file_loads").write(kept)
