"""User-defined SQL rules: each returns the keys of the rows that break it."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.columns import as_timestamp
from tidemark.operators.collect import collect_chunks
from tidemark.operators.update import flag_failed


@dataclass(frozen=True)
class Rule:
    val_sk: int
    query: str
    table_name: str
    primary_key: str
    val_rule: str = ""


@dataclass(frozen=True)
class RuleResult:
    flagged: DataFrame
    counts: DataFrame
    error_log: DataFrame


def select_rules(control: DataFrame, xcenter: str) -> DataFrame:
    """Active, idle rules of one centre, in rule order."""
    return control.filter(
        (F.col("acti_ind") == "Y") & (F.col("status") == "C") & (F.col("xcenter") == xcenter)
    ).orderBy("val_sk")


def failing_rows(spark: SparkSession, query: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run the rule's SQL with ``tables`` visible under their names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return spark.sql(query)


#: A rule that looks at one row at a time: its key and a condition on one table, nothing else.
ROW_RULE = re.compile(
    r"\s*SELECT\s+(?:(?P<a>\w+)\.)?(?P<key>\w+)\s+FROM\s+(?P<table>\w+)(?:\s+(?:AS\s+)?(?P<alias>(?!WHERE\b)\w+))?"
    r"\s+WHERE\s+(?P<condition>.+?)\s*;?\s*",
    re.IGNORECASE | re.DOTALL,
)
#: Words that make a condition more than a look at one row, or end it.
BEYOND_A_ROW = re.compile(
    r"\b(SELECT|JOIN|GROUP|HAVING|ORDER|SORT|CLUSTER|DISTRIBUTE|LIMIT|OFFSET|UNION|INTERSECT|EXCEPT|MINUS|OVER|WINDOW|LATERAL|QUALIFY)\b"
    r"|--|/\*",
    re.IGNORECASE,
)


def row_condition(rule: Rule) -> tuple[str, str] | None:
    """(alias, condition) of a rule that looks at one row of its table at a time; None for any other,
    and whenever in doubt. Such rules share a scan."""
    found = ROW_RULE.fullmatch(rule.query)
    if not found or found["table"].lower() != rule.table_name.lower() or BEYOND_A_ROW.search(found["condition"]):
        return None
    alias = found["alias"] or found["table"]
    if found["key"].lower() != rule.primary_key.lower() or (found["a"] or alias).lower() != alias.lower():
        return None
    return alias, found["condition"]


def failed_by_row(table: DataFrame, rules: Mapping[int, Rule]) -> DataFrame | None:
    """``key, rule`` of the rows that fail row rules of one key column, from one scan of ``table``;
    ``rules`` by their number. None if there is none."""
    hits, rows = [], table
    for number, rule in rules.items():
        alias, condition = row_condition(rule)
        rows = rows.alias(alias)  # an alias hides the one before, so each condition is bound in turn
        rows = rows.select("*", F.when(F.expr(condition), F.lit(number)).alias(f"_rule_{number}"))
        hits.append(F.col(f"_rule_{number}"))
    if not hits:
        return None
    key = next(iter(rules.values())).primary_key
    failed = rows.select(F.col(key).alias("key"), F.array_compact(F.array(*hits)).alias("rules"))
    return failed.filter(F.size("rules") > 0).select("key", F.explode("rules").alias("rule"))


def rule_hits(
    mine: DataFrame, failed: Mapping[str, DataFrame], numbers: Iterable[int], bucket: Column
) -> DataFrame:
    """One row over the rows of a run: their number, those each rule fails (``failed_<number>``), and the
    buckets of the failing ones. ``failed`` has ``key, rule`` by key column; one join per key column,
    however many rules there are."""
    rows, lists = mine, []
    for i, (key, frame) in enumerate(failed.items()):
        per_key = frame.filter(F.col("key").isNotNull()).groupBy(F.col("key").alias(f"_key_{i}")).agg(
            F.collect_set("rule").alias(f"_rules_{i}")  # at most the number of rules
        )
        rows = rows.join(per_key, F.col(key) == F.col(f"_key_{i}"), "left")
        lists.append(F.coalesce(f"_rules_{i}", F.array().cast("array<int>")))
    rules = F.concat(*lists) if lists else F.array().cast("array<int>")
    rows = rows.select(rules.alias("rules"), bucket.alias("bucket"))
    return rows.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.collect_set(F.when(F.size("rules") > 0, F.col("bucket"))).alias("buckets"),
        *[F.count_if(F.array_contains("rules", i)).alias(f"failed_{i}") for i in numbers],
    )


def rule_counts(flagged: DataFrame, run_sk: int) -> DataFrame:
    """One row: rows of this run, failed (flag set by this or an earlier rule), passed."""
    mine = flagged.filter(F.col(n.RUN) == run_sk)
    counts = mine.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(F.col(n.VALIDATION) == "F").alias("failed_count"),
    )
    return counts.select(
        "total_count",
        (F.col("total_count") - F.col("failed_count")).alias("passed_count"),
        "failed_count",
        F.when(F.col("failed_count") == 0, "S").otherwise("F").alias("status"),
    )


def _logged(failed: DataFrame, value: str, rule: Rule, val_run_sk: int, run_ts, *more: str) -> DataFrame:
    return failed.select(
        F.lit(rule.table_name).alias("gw_table_name"),
        F.lit(rule.primary_key).alias("gw_primary_key"),
        F.col(value).cast("string").alias("gw_error_values"),
        F.lit(str(rule.val_sk)).alias("val_sk"),
        F.lit(str(val_run_sk)).alias("val_run_sk"),
        as_timestamp(run_ts).alias("inserted_date"),
        *more,
    )


def error_log(failed: DataFrame, rule: Rule, val_run_sk: int, run_ts) -> DataFrame:
    """One row per failing key, however many there are; a NULL key gives none."""
    keys = failed.filter(F.col(rule.primary_key).isNotNull())
    return _logged(keys, rule.primary_key, rule, val_run_sk, run_ts)


def error_lists(
    failed: DataFrame, rule: Rule, val_run_sk: int, run_ts, chunk_rows: int = 10_000
) -> DataFrame:
    """The failing keys as comma lists, for readers that want text: ``chunk`` numbers lists of
    about ``chunk_rows`` keys (keys are dealt to lists by hash)."""
    lists = collect_chunks(failed, rule.primary_key, chunk_rows=chunk_rows)
    return _logged(lists, "values", rule, val_run_sk, run_ts, "chunk")


def run_rule(
    rule: Rule, failed: DataFrame, target: DataFrame, run_sk: int, val_run_sk: int, run_ts
) -> RuleResult:
    """Flag the failing rows of this run, count, and log the failing keys if any was flagged."""
    flagged = flag_failed(target, failed, rule.primary_key, run_sk)
    counts = rule_counts(flagged, run_sk)
    any_failed = counts.select(F.col("failed_count") > 0).scalar()
    log = error_log(failed, rule, val_run_sk, run_ts).filter(any_failed)
    return RuleResult(flagged, counts, log)


def validation_summary(
    counts: DataFrame, rule: Rule, xcenter: str, step_sk: int, run_sk: int, val_run_sk: int, run_ts
) -> DataFrame:
    """Run-history row of a rule."""
    now = as_timestamp(run_ts)
    return counts.select(
        F.lit(val_run_sk).alias("val_run_sk"),
        F.lit(rule.val_sk).alias("val_sk"),
        F.lit(rule.val_rule).alias("val_rule"),
        F.lit(rule.table_name).alias("table_name"),
        F.lit(rule.primary_key).alias("primary_key"),
        F.lit(xcenter).alias("xcenter"),
        F.lit(step_sk).alias("step_sk"),
        F.lit(run_sk).alias("cyc_run_sk"),
        F.col("status").alias("val_status"),
        now.alias("val_start_dtm"),
        now.alias("val_end_dtm"),
        "total_count",
        "passed_count",
        "failed_count",
        now.alias("aud_dt_tm"),
    )


def bytes_reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Per folder: bytes on both sides; 'S' when equal and not empty."""
    keys = ["table_name", "gw_fingerprint", "gw_timestamp"]
    left = source.select(*keys, F.col("bytes").alias("data_read"))
    right = target.select(*keys, F.col("bytes").alias("data_written"))
    joined = left.join(right, keys, "left")
    written = F.coalesce("data_written", F.lit(0))
    equal = (F.col("data_read") == written) & (F.col("data_read") > 0)
    return joined.select(
        *keys,
        "data_read",
        written.alias("data_written"),
        F.when(equal, "S").otherwise("F").alias("status"),
    )
