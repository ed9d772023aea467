"""Run every rule of a replica table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators.quality import (
    Rule,
    error_log,
    failed_by_row,
    failing_rows,
    row_condition,
    rule_hits,
    select_rules,
    validation_summary,
)
from tidemark.operators.update import flag_failed
from tidemark.plans.warehouse import Warehouse
from tidemark.session import Staging


def load_rules(control: DataFrame, xcenter: str) -> list[Rule]:
    """Rule texts of a centre; there are few and each is one statement."""
    chosen = select_rules(control, xcenter)
    return [
        Rule(r["val_sk"], r["val_query"], r["table_name"], r["primary_key"], r["val_rule"])
        for r in chosen.collect()
    ]


def validate_table(
    wh: Warehouse,
    table: str,
    rules: Sequence[Rule],
    xcenter: str,
    step_sk: int,
    run_sk: int,
    run_ts,
    first_val_run: int,
) -> DataFrame:
    """Check all rules of one table; returns one summary row per rule.

    Validation runs are numbered from ``first_val_run``, which the caller moves on from table
    to table. A rule may join other replicas: the caller publishes them first. Rules see the table as
    it was before this step.

    Rules that look at one row at a time share one scan of the table, every other rule runs its own
    query; the failing keys of all are staged in one write. A second, narrow scan of the run's rows
    counts for all rules at once and finds the buckets to flag, and only those are written, in ONE
    new version of the replica.
    """
    if not rules:
        return wh.spark.createDataFrame([], _summary_schema(wh.spark))
    replica = wh.replica(table)
    state = replica.read()
    by_key: dict[str, dict[int, Rule]] = {}
    for i, rule in enumerate(rules):
        by_key.setdefault(rule.primary_key, {})[i] = rule
    with Staging(wh.spark) as staging:
        failed = {}
        for k, (key, mine) in enumerate(by_key.items()):
            local = {i: rule for i, rule in mine.items() if row_condition(rule)}
            frames = [failed_by_row(state, local)] if local else []
            for i, rule in mine.items():
                if i not in local:
                    found = failing_rows(wh.spark, rule.query, {table: state})
                    frames.append(found.select(F.col(rule.primary_key).alias("key"), F.lit(i).alias("rule")))
            failed[key] = staging.put(reduce(DataFrame.unionByName, frames), f"failed-{k}")
        hits = rule_hits(
            state.filter(F.col(n.RUN) == run_sk), failed, range(len(rules)), replica.bucket_of()
        ).first()
        summaries, logs = [], []
        for i, rule in enumerate(rules):
            total, bad = hits["total_count"], hits[f"failed_{i}"]
            counts = wh.spark.createDataFrame(
                [(total, total - bad, bad, "S" if bad == 0 else "F")],
                "total_count bigint, passed_count bigint, failed_count bigint, status string",
            )
            val_run = first_val_run + i
            summaries.append(validation_summary(counts, rule, xcenter, step_sk, run_sk, val_run, run_ts))
            if bad:
                keys = failed[rule.primary_key].filter(F.col("rule") == i).select(F.col("key").alias(rule.primary_key))
                logs.append(error_log(keys, rule, val_run, run_ts))
        if logs:
            wh.control("validation_error_log").append(reduce(DataFrame.unionByName, logs))
            flagged = replica.read(hits["buckets"])
            for key, frame in failed.items():
                # Of a rule without failures in this run no key is in this run either.
                flagged = flag_failed(flagged, frame.select(F.col("key").alias(key)), key, run_sk)
            replica.write_buckets(flagged, hits["buckets"])
    summary = reduce(DataFrame.unionByName, summaries)
    wh.control("validation_runs").append(summary)
    return summary


def _summary_schema(spark):
    counts = spark.createDataFrame(
        [], "total_count bigint, passed_count bigint, failed_count bigint, status string"
    )
    none = Rule(0, "", "", "")
    return validation_summary(counts, none, "", 0, 0, 0, "2000-01-01 00:00:00").schema
