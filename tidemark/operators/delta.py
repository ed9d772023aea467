"""Which rows of a left join can differ from those of an earlier run.

A refined table is a driving table joined with tables it refers to. A row of the result changes only
if its driving row or a row it refers to changed, so a run needs the driving rows changed since the
last good run and those that refer to a changed row; every other row would be hashed and classified
only to be found unchanged. Rows carry the run that wrote them, deletes included (soft deletes are
writes), so changes are a filter that reaches the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.session import Staging, fits_broadcast


@dataclass(frozen=True)
class Reference:
    """A table that driving rows refer to: ``foreign_key`` of the driving row holds its ``key``."""

    table: DataFrame
    foreign_key: str
    key: str = "id"


def changed_since(previous_run: int) -> Column:
    """Rows written after ``previous_run``; a row without a run counts as changed."""
    return F.coalesce(F.col(n.RUN) > previous_run, F.lit(True))


def changed_keys(table: DataFrame, key: str, previous_run: int) -> DataFrame:
    """Distinct keys of the rows of ``table`` that changed; one narrow column moves."""
    rows = table.filter(changed_since(previous_run)).select(F.col(key).alias("_key"))
    return rows.filter(F.col("_key").isNotNull()).distinct()


def affected_rows(
    driving: DataFrame, references: Sequence[Reference], previous_run: int, staging: Staging
) -> DataFrame:
    """Rows of ``driving`` whose joined result may differ from that of ``previous_run``, once each.

    The changed keys of each reference are staged, so their size is known: a small set goes to the
    tasks that scan the driving table, which then does not move before it is cut down; a large one is
    joined on the foreign key, on which the join with the reference itself finds the rows dealt
    already. Rows without a foreign key never join.
    """
    rows, hits = driving, [changed_since(previous_run)]
    for i, reference in enumerate(references):
        keys = staging.put(changed_keys(reference.table, reference.key, previous_run), f"changed-{i}")
        hit, key = f"_hit_{i}", f"_key_{i}"
        found = keys.select(F.col("_key").alias(key), F.lit(True).alias(hit))
        on = F.col(reference.foreign_key) == F.col(key)
        if fits_broadcast(keys):
            rows = rows.join(F.broadcast(found), on, "left").drop(key)
        else:
            referring = rows.filter(F.col(reference.foreign_key).isNotNull())
            alone = rows.filter(F.col(reference.foreign_key).isNull())
            rows = referring.join(found, on, "left").drop(key).unionByName(alone, allowMissingColumns=True)
        hits.append(F.coalesce(F.col(hit), F.lit(False)))
    return rows.filter(reduce(or_, hits)).select(*[f"`{c}`" for c in driving.columns])


def referred_rows(rows: DataFrame, reference: Reference, staging: Staging, name: str = "referred") -> DataFrame:
    """The rows of a reference that ``rows`` need. If their keys are few, the reference is cut down
    where it is scanned; otherwise it is returned as it is, for a plain join."""
    needed = rows.select(F.col(reference.foreign_key).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    needed = staging.put(needed, name)
    if not fits_broadcast(needed):
        return reference.table
    return reference.table.join(F.broadcast(needed), F.col(reference.key) == F.col("_key"), "left_semi")
