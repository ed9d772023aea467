"""Balance totals kept as partial aggregates that merge.

A total over a whole table is the sum of totals over its parts. Each part (a bucket of a replica, cut
by run) keeps its money sums and, for the count of distinct claims, bitmaps over dense numbers of the
claim numbers; bitmaps of several parts merge by OR, so a claim number in two parts counts once. A run
that rewrites some parts computes those again and merges them with the others as they are: updates
and deletes need no subtraction, and a balance reads the parts in place of the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators.balance import CLAIM_COUNT, CLAIM_STATES, EXACT, MONEY_METRICS, VALUE
from tidemark.operators.surrogate import assign_surrogate, highest

NUMBER = "_number"
#: Partial aggregates of a part are kept apart by these.
CUT = ("run", "balanced_state")


def new_numbers(values: DataFrame, known: DataFrame | None, column: str = "claimnumber") -> DataFrame:
    """``column, _number`` for the values that ``known`` lacks, numbered on from its highest; all of
    them from 1 where nothing is known."""
    fresh = values.select(column).filter(F.col(column).isNotNull()).distinct()
    if known is not None:
        fresh = fresh.join(known.select(column), column, "left_anti")
    ranges = F.substring(F.md5(F.col(column).cast("string")), 1, 3)
    start = 0 if known is None else highest(known, NUMBER)
    return assign_surrogate(fresh, NUMBER, start, column, ranges=ranges).select(column, NUMBER)


def live() -> Column:
    return (F.col("retired") == 0) & (F.col(n.SOFT_DELETE) == "N")


def claim_partials(claims: DataFrame, numbers: DataFrame, part: Column) -> DataFrame:
    """``part, run, balanced_state, page, bits`` of the live claims. A page holds 32,768 numbers in
    4 kB; bitmaps combine before the shuffle."""
    rows = claims.filter(live()).select(
        part.alias("part"), F.col(n.RUN).alias("run"),
        F.coalesce(F.col("state").isin(*CLAIM_STATES), F.lit(False)).alias("balanced_state"), "claimnumber",
    )
    # Claim numbers begin alike, so a sort by them compares whole texts; a hash in front tells them apart.
    rows, numbers = (x.withColumn("_hash", F.xxhash64("claimnumber")) for x in (rows, numbers))
    placed = rows.join(numbers, ["_hash", "claimnumber"]).withColumn("page", F.bitmap_bucket_number(NUMBER))
    return placed.groupBy("part", *CUT, "page").agg(F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias("bits"))


def money_partials(transactions: DataFrame, part: Column) -> DataFrame:
    """``part, run`` and one exact sum per money metric of the live transactions."""
    amount = F.col("amount").cast(EXACT)
    sums = [
        F.coalesce(F.sum(F.when(F.col("costtype").isin(*costs) & (F.col("costcategory") == metric), amount)), F.lit(0))
        .cast(VALUE).alias(metric)
        for metric, costs in MONEY_METRICS
    ]
    return transactions.filter(live()).groupBy(part.alias("part"), F.col(n.RUN).alias("run")).agg(*sums)


def merged_metrics(claims: DataFrame, money: DataFrame, run_sk: int | None = None) -> DataFrame:
    """The five (metric_type, value) rows of all parts, or of one run's rows in the balanced states."""
    if run_sk is not None:
        claims = claims.filter((F.col("run") == run_sk) & F.col("balanced_state"))
        money = money.filter(F.col("run") == run_sk)
    pages = claims.groupBy("page").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    count = pages.agg(
        F.lit(CLAIM_COUNT).alias("metric_type"), F.coalesce(F.sum("n"), F.lit(0)).cast(VALUE).alias("value")
    )
    names = [m for m, _ in MONEY_METRICS]
    sums = money.agg(*[F.coalesce(F.sum(m), F.lit(0)).cast(VALUE).alias(m) for m in names])
    return count.unionByName(sums.unpivot([], names, "metric_type", "value"))
