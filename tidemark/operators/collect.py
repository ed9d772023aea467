"""Key lists as text, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collect_chunks(
    df: DataFrame,
    value: str,
    group: Sequence[str] = (),
    chunk_rows: int = 10_000,
    separator: str = ",",
) -> DataFrame:
    """Comma list of ``value`` per group: columns ``group``, ``chunk``, ``n_values``, ``values``.

    A group of up to ``chunk_rows`` values gives one sorted list; a larger one is spread over
    ceil(size / chunk_rows) lists by hash, so that no list, and no task, has to hold a whole
    group. Repeated values are counted before the shuffle and spread in runs of at most
    ``chunk_rows``, so a single hot value is split as well. NULL values are left out.
    """
    rows = df.filter(F.col(value).isNotNull())
    counted = rows.groupBy(*group, F.col(value).cast("string").alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    last_run = F.floor((F.col("_n") - 1) / chunk_rows).cast("long")
    runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), last_run)))
    runs = runs.withColumn("_w", F.least(F.lit(chunk_rows), F.col("_n") - F.col("_run") * chunk_rows))
    totals = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_total"))
    if group:
        renamed = totals.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_total")
        same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
        runs = runs.join(renamed, same).drop(*[f"_g{i}" for i in range(len(group))])
    else:
        runs = runs.withColumn("_total", totals.scalar())
    chunks = F.ceil(F.col("_total") / chunk_rows)
    spread = F.conv(F.substring(F.md5(F.concat_ws("#", "_v", "_run")), 1, 8), 16, 10).cast("bigint")
    runs = runs.withColumn("chunk", F.pmod(spread, chunks).cast("int"))
    packed = F.flatten(
        F.collect_list(F.array_repeat(F.col("_v"), F.col("_w").cast("int")))
    )
    return runs.groupBy(*group, "chunk").agg(
        F.sum("_w").alias("n_values"),
        F.concat_ws(separator, F.sort_array(packed)).alias("values"),
    )
