"""One cycle over all tables, as a plain function: no scheduler, no state machine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidemark.operators.quality import Rule
from tidemark.plans.balancing import balance_refined, balance_run_partial, publish_metrics
from tidemark.plans.housekeeping import housekeeping
from tidemark.plans.ingest import REPLICA_STEP, ingest
from tidemark.plans.jobspec import JobSpec
from tidemark.plans.parallel import for_each
from tidemark.plans.refine import refine_job
from tidemark.plans.replicate import failed_job, replicate, waiting_tables
from tidemark.plans.validate import validate_table
from tidemark.plans.warehouse import Warehouse


@dataclass
class CycleResult:
    loaded: list[str]
    replicas: list[DataFrame] = field(default_factory=list)
    refined: list[DataFrame] = field(default_factory=list)
    validations: list[DataFrame] = field(default_factory=list)
    balances: list[DataFrame] = field(default_factory=list)


def run_cycle(
    wh: Warehouse,
    landing: str,
    xcenter: str,
    specs: Sequence[JobSpec],
    cyc_sk: int,
    run_sk: int,
    run_ts,
    previous_run: int = 0,
    rules: Mapping[str, Sequence[Rule]] | None = None,
    balance: bool = True,
    refined_balance: tuple[str, str] | None = None,
    first_val_run: int | None = None,
    workers: int = 8,
) -> CycleResult:
    """Ingest, replicate, balance, validate, refine, balance again, clean up.

    ``refined_balance`` names the detail and the financial table to hold against the replicas;
    without it the refined layer is not balanced. Rules need ``first_val_run``, the number of
    the first validation run. A table whose replication fails gives a metrics row of status 'F'
    and the others go on; the next cycle takes its deliveries up again.

    Tables of one layer do not depend on each other and run side by side.
    """
    known = {spec.target for spec in specs}
    if refined_balance and not known >= set(refined_balance):
        raise ValueError(f"no job writes {sorted(set(refined_balance) - known)}")
    if rules and first_val_run is None:
        raise ValueError("rules need first_val_run")
    result = CycleResult(ingest(wh, landing, xcenter, run_sk, run_ts, workers))
    result.replicas = for_each(
        wh.spark,
        lambda table: _replicated(wh, table, run_sk, run_ts, xcenter),
        waiting_tables(wh, xcenter),
        workers,
    )
    if balance:
        metrics = balance_run_partial(wh, cyc_sk, run_sk, run_ts, xcenter)
        result.balances.append(publish_metrics(wh.spark, wh, metrics))
    every = _known_tables(wh)
    number = first_val_run or 0
    for table, its_rules in (rules or {}).items():
        wh.publish_replicas(every)  # as the rules before have left them
        result.validations.append(
            validate_table(wh, table, its_rules, xcenter, REPLICA_STEP, run_sk, run_ts, number)
        )
        number += len(its_rules)
    wh.publish_replicas(every)
    result.refined = for_each(
        wh.spark,
        lambda spec: refine_job(wh, spec, run_sk, run_ts, previous_run),
        specs,
        workers,
    )
    if balance and refined_balance:
        metrics = balance_refined(wh, cyc_sk, run_sk, run_ts, *refined_balance)
        result.balances.append(publish_metrics(wh.spark, wh, metrics))
    housekeeping(wh, xcenter, run_ts, refined=sorted(known))
    return result


def _replicated(wh: Warehouse, table: str, run_sk: int, run_ts, xcenter: str) -> DataFrame:
    try:
        return replicate(wh, table, run_sk, run_ts, xcenter)
    except Exception as error:  # noqa: BLE001  one table's failure is its metrics row
        return failed_job(wh, table, error)


def _known_tables(wh: Warehouse) -> list[str]:
    rows = wh.control_rows("table_load_metadata").select("table_name").distinct()
    return sorted({r["table_name"].lower() for r in rows.collect()})
