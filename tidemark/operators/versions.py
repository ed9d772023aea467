"""Schema versions of delivered tables: runs of deliveries under one fingerprint.

Deliveries of one table are ordered by time, then fingerprint; a NULL fingerprint is a value of its
own. All of it is done in two levels: within stretches of time, then over what is left of each
stretch, so a table with a large share of all deliveries is split over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import epoch

#: Milliseconds of a stretch: a day.
STRETCH = 86_400_000
TABLE, FINGERPRINT, TIME = "table_name", "gw_fingerprint", "gw_timestamp"


def _timed(files: DataFrame, stretch: int) -> DataFrame:
    time = epoch(TIME)
    return files.withColumns({"_time": time, "_stretch": F.floor(time / stretch)})


def fingerprint_changed(files: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Add ``previous_fingerprint`` and ``fingerprint_changed``: whether the delivery before this one, of
    the same table, had another. The first delivery of a table has changed nothing."""
    files = _timed(files, stretch)
    order = ["_time", FINGERPRINT]
    within = Window.partitionBy(TABLE, "_stretch").orderBy(*order)
    found = F.struct(F.col(FINGERPRINT).alias("fp"))
    rows = files.withColumn("_before", F.lag(found).over(within))
    # The last fingerprint of each stretch reaches the first delivery of the next one.
    last = files.groupBy(TABLE, "_stretch").agg(F.max(F.struct(*order)).alias("_last"))
    along = Window.partitionBy(TABLE).orderBy("_stretch")
    edge = F.lag(F.struct(F.col(f"_last.{FINGERPRINT}").alias("fp"))).over(along)
    edges = last.select(F.col(TABLE).alias("_t"), F.col("_stretch").alias("_s"), edge.alias("_edge"))
    joined = rows.join(edges, rows[TABLE].eqNullSafe(F.col("_t")) & rows["_stretch"].eqNullSafe(F.col("_s")), "left")
    before = F.coalesce("_before", "_edge")
    changed = before.isNotNull() & ~before["fp"].eqNullSafe(F.col(FINGERPRINT))
    return joined.withColumns({"previous_fingerprint": before["fp"], "fingerprint_changed": changed}).drop(
        "_time", "_stretch", "_before", "_edge", "_t", "_s"
    )


def _islands(rows: DataFrame, group: list[str], order: list[str], aggregates: list) -> DataFrame:
    """Runs of neighbours with one fingerprint within each group, numbered from 1."""
    window = Window.partitionBy(*group).orderBy(*order)
    value = F.struct(F.col(FINGERPRINT).alias("fp"))
    before = F.lag(value).over(window)
    begins = (before.isNull() | ~before["fp"].eqNullSafe(F.col(FINGERPRINT))).cast("int")
    begun = rows.withColumn("_begins", begins)
    numbered = begun.withColumn("_island", F.sum("_begins").over(window))
    return numbered.groupBy(*group, "_island", FINGERPRINT).agg(*aggregates)


def schema_versions(files: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """One row per schema version of a table: ``table_name, version, gw_fingerprint, first_timestamp,
    last_timestamp, deliveries, came_back``. A fingerprint that comes back begins a new version, and
    ``came_back`` says so."""
    files = _timed(files, stretch)
    parts = _islands(
        files, [TABLE, "_stretch"], ["_time", FINGERPRINT],
        [F.min("_time").alias("_first"), F.max("_time").alias("_last"), F.count(F.lit(1)).alias("_n")],
    ).withColumnRenamed("_island", "_part")
    runs = _islands(
        parts, [TABLE], ["_stretch", "_part"],
        [F.min("_first").alias("first_timestamp"), F.max("_last").alias("last_timestamp"),
         F.sum("_n").alias("deliveries")],
    )
    earlier = Window.partitionBy(TABLE, FINGERPRINT).orderBy("_island")
    return runs.select(
        TABLE, F.col("_island").cast("int").alias("version"), FINGERPRINT, "first_timestamp",
        "last_timestamp", "deliveries", (F.row_number().over(earlier) > 1).alias("came_back"),
    )


def rows_read(manifests: DataFrame, table: str = "table_name", time: str = "written", total: str = "total") -> DataFrame:
    """Add ``previous_total``, ``rows_read`` and ``restarted`` to manifest entries of many runs.

    An entry's total counts all rows since the count began; what was read since is the total less
    the last one known before, at an EARLIER time: entries without a total are passed over, and of
    entries with equal times none is before the other (of several at the last earlier time, the
    largest total counts). A total below the one before has begun anew, and counts whole. One table
    has one entry a run, so a window per table streams over as many rows as there were runs.
    """
    at, count = epoch(time), F.col(total).try_cast("bigint")
    before = Window.partitionBy(table).orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    entry = F.when(F.col("_count").isNotNull() & F.col("_at").isNotNull(), F.struct("_at", "_count"))
    known = F.when(F.col("_at").isNotNull(), F.max(entry).over(before))
    rows = manifests.withColumns({"_at": at, "_count": count}).withColumn("_known", known)
    rows = rows.withColumn("previous_total", F.col("_known._count"))
    less = F.col("_count") < F.col("previous_total")
    return rows.withColumns({
        "restarted": F.coalesce(less, F.lit(False)),
        "rows_read": F.col("_count") - F.when(less, 0).otherwise(F.coalesce("previous_total", F.lit(0))),
    }).drop("_at", "_count", "_known")


def rows_read_now(manifest: DataFrame, archive: DataFrame, table: str = "table_name", time: str = "written", total: str = "total") -> DataFrame:
    """:func:`rows_read` for the manifest of one run, which has one entry a table: the archive is read
    once, and each of its rows meets that entry only."""
    entries = manifest.select(table, time, total).distinct()
    wanted = entries.select(F.col(table).alias("_t"), epoch(time).alias("_now")).distinct()
    old = archive.select(F.col(table).alias("_o"), epoch(time).alias("_at"), F.col(total).try_cast("bigint").alias("_count"))
    hits = wanted.join(old.dropna(), (F.col("_o") == F.col("_t")) & (F.col("_at") < F.col("_now")))
    last = hits.groupBy("_t", "_now").agg(F.max(F.struct("_at", "_count")).alias("_known"))
    joined = manifest.join(last, (F.col(table) == F.col("_t")) & (epoch(time) == F.col("_now")), "left")
    count, previous = F.col(total).try_cast("bigint"), F.col("_known._count")
    return joined.withColumns({
        "previous_total": previous,
        "restarted": F.coalesce(count < previous, F.lit(False)),
        "rows_read": count - F.when(count < previous, 0).otherwise(F.coalesce(previous, F.lit(0))),
    }).drop("_t", "_now", "_known")
