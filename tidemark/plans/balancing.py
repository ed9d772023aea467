"""Balance sources and the two balance jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.schema import union_aligned
from tidemark.operators import partials
from tidemark.operators.balance import (
    RAW_TO_REPLICA,
    balance_raw_vs_replica,
    balance_replica_vs_refined,
    compare_metrics,
    cycle_folders,
    source_metrics,
)
from tidemark.operators.dedup import latest_per_key
from tidemark.plans.parallel import for_each
from tidemark.plans.replicate import table_batches
from tidemark.plans.warehouse import Warehouse

CLAIM, TRANSACTION = "cc_claim", "cc_transaction"


def balance_source(raw: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Latest row per key of the deliveries of a cycle."""
    return latest_per_key(raw, keys, n.RECENCY)


def refresh_or_keep(
    wh: Warehouse, table: str, files: DataFrame, loaded: DataFrame
) -> DataFrame | None:
    """Rebuild a table's balance source when it was loaded in this cycle, else keep the one
    of the last cycle; None before the first load."""
    store = wh.balance_source(table)
    batches = table_batches(wh, table, cycle_folders(files, loaded, table))
    if batches:
        return store.write(balance_source(union_aligned([b.rows for b in batches])))
    return store.read() if store.exists() else None


def _sources(wh: Warehouse, run_sk: int, xcenter: str) -> dict[str, DataFrame]:
    """The rows that this cycle delivered, by table."""
    mine = F.col("xcenter") == xcenter
    files = wh.control_rows("file_loads").filter(mine)
    loaded = wh.control_rows("raw_table_load").filter(mine & (F.col("cyc_run_sk") == run_sk))

    def source(table: str) -> DataFrame:
        found = refresh_or_keep(wh, table, files, loaded)
        return wh.replica(table).read().limit(0) if found is None else found

    tables = (CLAIM, TRANSACTION)
    return dict(zip(tables, for_each(wh.spark, source, tables)))


def balance_run(wh: Warehouse, cyc_sk: int, run_sk: int, run_ts, xcenter: str) -> DataFrame:
    """Metrics raw -> replica of this cycle."""
    sources = _sources(wh, run_sk, xcenter)
    return balance_raw_vs_replica(
        sources[CLAIM],
        sources[TRANSACTION],
        wh.replica(CLAIM).read(),
        wh.replica(TRANSACTION).read(),
        cyc_sk,
        run_sk,
        run_ts,
    )


def refresh_partials(wh: Warehouse, table: str) -> DataFrame:
    """Partial aggregates of a replica, computed again for the buckets rewritten since the last call;
    the other buckets are not read. ``table`` is the claim or the transaction table."""
    replica = wh.replica(table)
    store, numbers = wh.partials(table), wh.claim_numbers()
    current = replica.contents()
    known: dict[int, int] = {}
    if store.exists():
        rows = store.read().select("part", "written").distinct()
        known = {r["part"]: r["written"] for r in rows.collect()}  # one row a bucket
    # A bucket without live rows has no partials and is looked at again.
    stale = sorted({b for b, number in current.items() if known.get(b) != number} | (set(known) - set(current)))
    if not stale and store.exists():
        return store.read()
    rows, part = replica.read([b for b in stale if b in current]), replica.bucket_of()
    if table == CLAIM:
        fresh = partials.new_numbers(rows, numbers.read() if numbers.exists() else None)
        numbers.append(fresh)
        made = partials.claim_partials(rows, numbers.read(), part)
    else:
        made = partials.money_partials(rows, part)
    written = F.create_map(*[F.lit(x) for b, number in current.items() for x in (b, number)])
    made = made.withColumn("written", F.get(F.array(written[F.col("part")]), F.lit(0)))
    if store.exists():
        made = store.read().filter(~F.col("part").isin(stale)).unionByName(made)
    return store.write(made)


def balance_run_partial(wh: Warehouse, cyc_sk: int, run_sk: int, run_ts, xcenter: str) -> DataFrame:
    """As ``balance_run``, with the replica side merged from its partial aggregates."""
    sources = _sources(wh, run_sk, xcenter)
    parts = for_each(wh.spark, lambda table: refresh_partials(wh, table), (CLAIM, TRANSACTION))
    merged = partials.merged_metrics(*parts, run_sk)
    return compare_metrics(
        source_metrics(sources[CLAIM], sources[TRANSACTION]), merged, RAW_TO_REPLICA, cyc_sk, run_sk, run_ts
    )


def balance_refined(
    wh: Warehouse, cyc_sk: int, run_sk: int, run_ts, detail: str, financial: str
) -> DataFrame:
    """Metrics replica -> refined."""
    return balance_replica_vs_refined(
        wh.replica(CLAIM).read(),
        wh.replica(TRANSACTION).read(),
        wh.refined(detail).read(),
        wh.refined(financial).read(),
        cyc_sk,
        run_sk,
        run_ts,
    )


def publish_metrics(spark: SparkSession, wh: Warehouse, metrics: DataFrame) -> DataFrame:
    """Append metric rows to the metrics table and return the rows just added."""
    rows = spark.createDataFrame(metrics.collect(), metrics.schema)  # five rows
    wh.control("balance_metrics").append(rows)
    return rows
