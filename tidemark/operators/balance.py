"""Count and money totals compared between layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.columns import as_timestamp

# --- fixed values: claim states, cost types and money metrics ------------------
CLAIM_STATES = ("Open", "Closed", "Reopened")
LOSS_COSTS = ("claimcost",)
EXPENSE_COSTS = ("aoexpense", "dccexpense")
MONEY_METRICS = (
    ("LossPayment", LOSS_COSTS),
    ("ExpensePayment", EXPENSE_COSTS),
    ("LossReserve", LOSS_COSTS),
    ("ExpenseReserve", EXPENSE_COSTS),
)
CLAIM_COUNT = "ClaimCount"
RAW_TO_REPLICA = "Raw To Replica"
REPLICA_TO_REFINED = "Replica To Refined"

# Money is summed as decimal: the total does not depend on the order of the tasks.
EXACT = "decimal(28,6)"
VALUE = "decimal(38,6)"


def claim_count(claims: DataFrame, keep: Column) -> DataFrame:
    """Metric row: distinct claim numbers under ``keep``."""
    return claims.filter(keep).agg(
        F.lit(CLAIM_COUNT).alias("metric_type"),
        F.countDistinct("claimnumber").cast(VALUE).alias("value"),
    )


def money_totals(transactions: DataFrame, keep: Column) -> DataFrame:
    """Four metric rows from one pass: each total is a conditional sum."""
    amount = F.col("amount").cast(EXACT)
    sums = []
    for metric, costs in MONEY_METRICS:
        mine = F.col("costtype").isin(*costs) & (F.col("costcategory") == metric)
        total = F.coalesce(F.sum(F.when(mine, amount)), F.lit(0))
        sums.append(total.cast(VALUE).alias(metric))
    wide = transactions.filter(keep).agg(*sums)
    return wide.unpivot([], [m for m, _ in MONEY_METRICS], "metric_type", "value")


def layer_metrics(
    claims: DataFrame, transactions: DataFrame, keep_claims: Column, keep_money: Column
) -> DataFrame:
    """The five (metric_type, value) rows of one layer."""
    return claim_count(claims, keep_claims).unionByName(money_totals(transactions, keep_money))


def source_metrics(claims: DataFrame, transactions: DataFrame) -> DataFrame:
    """Raw side: the deduplicated deliveries without deletes and retired rows."""
    live = (F.col("retired") == 0) & (F.col(n.OPERATION) != n.OP_DELETE)
    return layer_metrics(claims, transactions, live & F.col("state").isin(*CLAIM_STATES), live)


def replica_run_metrics(claims: DataFrame, transactions: DataFrame, run_sk: int) -> DataFrame:
    """Replica side of raw -> replica: rows of this run that are not deleted."""
    live = (F.col(n.RUN) == run_sk) & (F.col("retired") == 0) & (F.col(n.SOFT_DELETE) == "N")
    return layer_metrics(claims, transactions, live & F.col("state").isin(*CLAIM_STATES), live)


def replica_metrics(claims: DataFrame, transactions: DataFrame) -> DataFrame:
    """Replica side of replica -> refined: all live rows, whatever run and state."""
    live = (F.col("retired") == 0) & (F.col(n.SOFT_DELETE) == "N")
    return layer_metrics(claims, transactions, live, live)


def refined_metrics(claim_detail: DataFrame, claim_financial: DataFrame) -> DataFrame:
    """Refined side: active versions."""
    active = F.col(n.ACTIVE) == "Y"
    return layer_metrics(claim_detail, claim_financial, active, active)


def compare_metrics(
    source: DataFrame, target: DataFrame, process: str, cyc_sk: int, run_sk: int, run_ts
) -> DataFrame:
    """One row per metric; PASSED when both values agree at two decimals."""
    left = source.select("metric_type", F.col("value").alias("_s"))
    right = target.select("metric_type", F.col("value").alias("_t"))
    money = "decimal(38,2)"
    joined = left.join(right, "metric_type")
    source_value, target_value = F.round("_s", 2).cast(money), F.round("_t", 2).cast(money)
    return joined.select(
        F.lit(cyc_sk).alias("cyc_sk"),
        F.lit(run_sk).alias("curr_cyc_run_sk"),
        "metric_type",
        F.lit(process).alias("process"),
        source_value.alias("source_value"),
        target_value.alias("target_value"),
        F.when(source_value == target_value, "PASSED").otherwise("FAILED").alias("status"),
        as_timestamp(run_ts).alias("aud_date_time"),
    )


def balance_raw_vs_replica(
    source_claims: DataFrame,
    source_transactions: DataFrame,
    claims: DataFrame,
    transactions: DataFrame,
    cyc_sk: int,
    run_sk: int,
    run_ts,
) -> DataFrame:
    return compare_metrics(
        source_metrics(source_claims, source_transactions),
        replica_run_metrics(claims, transactions, run_sk),
        RAW_TO_REPLICA,
        cyc_sk,
        run_sk,
        run_ts,
    )


def balance_replica_vs_refined(
    claims: DataFrame,
    transactions: DataFrame,
    claim_detail: DataFrame,
    claim_financial: DataFrame,
    cyc_sk: int,
    run_sk: int,
    run_ts,
) -> DataFrame:
    return compare_metrics(
        replica_metrics(claims, transactions),
        refined_metrics(claim_detail, claim_financial),
        REPLICA_TO_REFINED,
        cyc_sk,
        run_sk,
        run_ts,
    )


def verdict(metrics: DataFrame) -> DataFrame:
    """One row: 'S' when every metric passed, else 'F'; no metrics is no success."""
    passed = F.coalesce(F.bool_and(F.col("status") == "PASSED"), F.lit(False))
    return metrics.agg(F.when(passed, "S").otherwise("F").alias("balance_recon_status"))


def cycle_folders(files: DataFrame, loaded: DataFrame, table: str) -> DataFrame:
    """Folders of a table inside the delivery range loaded in this cycle."""
    mine = loaded.filter(F.upper("table_name") == table.upper())
    ts = F.col("gw_timestamp").cast("bigint")
    low, high = mine.agg(F.min(ts)).scalar(), mine.agg(F.max(ts)).scalar()
    return files.filter((F.upper("table_name") == table.upper()) & ts.between(low, high))
