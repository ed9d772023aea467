"""Replica to refined history table of one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators.control import job_metrics
from tidemark.operators.dedup import unique_source
from tidemark.operators.delta import Reference, affected_rows
from tidemark.operators.scd2 import (
    INSERT,
    KNOWN,
    REPLACED,
    classified_rows,
    close_gone,
    expire_gone,
    flag_gone,
    gone_hashes,
    is_active,
    number_inserts,
    pack_hashes,
    read_counts,
    scd2_balance,
    scd2_hash,
    scd2_initial,
    scd2_merge,
    scd2_metadata,
    scd2_rows_read,
    scd2_step,
    step_counts,
    unpack_hashes,
)
from tidemark.plans.jobspec import JobSpec
from tidemark.plans.warehouse import Warehouse
from tidemark.session import Staging
from tidemark.sources.counting import Counting


def refined_source(
    spec: JobSpec, rows: DataFrame, run_sk: int, run_ts, compat: bool = False
) -> DataFrame:
    """Hashed, stamped and unique source rows of a job."""
    lowered = rows.select(*[F.col(f"`{c}`").alias(c.lower()) for c in rows.columns])
    order = [c for c in spec.order if c.lower() in lowered.columns]
    # The hashes, most of a narrow row, are made after the shuffle that finds the latest rows.
    latest = unique_source(lowered, [k.strip().lower() for k in spec.keys], order)
    unique = scd2_hash(latest, spec.keys, spec.exclusions, compat)
    return scd2_metadata(unique, spec.surrogate, run_sk, run_ts)


def refine(
    wh: Warehouse,
    spec: JobSpec,
    rows: DataFrame,
    run_sk: int,
    run_ts,
    previous_run: int = 0,
    reactivate: bool = False,
    compat: bool = False,
) -> DataFrame:
    """Create or update the history table and return the metrics row of the job.

    The source is classified (against three columns of the history) as it comes, and only the rows
    that add a version are staged: no other row changes anything, so none moves again. A first load
    stages all rows, and moves hashes as bytes, half of their text. Merge and delete propagation are
    one plan over the open versions (keys of whole numbers meet both by their key hash, so no version
    moves for the propagation), and the run
    writes those and the versions it closed; the counts are taken in that write. ``compat`` changes closed
    versions as well, so it writes the whole table, once for the merge and once for the propagation.
    """
    refined = wh.refined(spec.target)
    driving = wh.replica(spec.driving_table).read()
    gone = (driving, spec.keys, spec.driving_keys, previous_run, run_sk, run_ts)
    with Staging(wh.spark) as staging:
        source = refined_source(spec, rows, run_sk, run_ts, compat)
        first = not refined.exists()
        if first:
            source = staging.put(pack_hashes(source), "source")
            read = scd2_rows_read(source)
            loaded = scd2_initial(source, spec.surrogate, run_sk)
            counting = Counting(step_counts(run_sk, F.lit(False)))
            state = expire_gone(loaded, *gone, compat, split=False)
            refined.write_all(unpack_hashes(state), counting)
        else:
            target = refined.read()
            reading = Counting(read_counts(), (KNOWN,))
            known = reading.on(classified_rows(source, target, reactivate))
            inserts = staging.put(known.filter(INSERT), "inserts")
            read = reading.row(wh.spark)
            numbered = number_inserts(inserts, target, spec.surrogate, classified=inserts)
            if compat:
                counting = Counting(step_counts(run_sk))
                state = refined.write_all(scd2_merge(target, numbered, run_sk, run_ts), counting)
            else:
                counting = Counting(step_counts(run_sk, F.col(REPLACED)), (REPLACED,))
                active = target.filter(is_active())
                hashes = gone_hashes(active, numbered, *gone[:4])
                if hashes is None:
                    moved = scd2_step(active, numbered, run_sk, run_ts, mark=True)
                    state = expire_gone(moved, *gone, split=False)
                else:
                    sides = (flag_gone(side, hashes) for side in (active, numbered))
                    state = close_gone(scd2_step(*sides, run_sk, run_ts, mark=True), run_sk, run_ts)
                refined.write_step(state, counting)
        balance = scd2_balance(read, counting.row(wh.spark))
        metrics = job_metrics(balance, spec.job_sk, spec.target)
        metrics = wh.spark.createDataFrame(metrics.collect(), metrics.schema)
        if compat and not first:
            refined.write_all(expire_gone(state, *gone, compat))
        return metrics


def delta_source(wh: Warehouse, spec: JobSpec, previous_run: int, staging: Staging) -> DataFrame | None:
    """Source rows of a job that changes since ``previous_run`` can have touched; None where only the
    whole source will do: before the first load, for a job that does not name its lookups, or one
    whose keys are not those of the driving table (several of its rows may make one)."""
    own = {k.lower() for k in spec.driving_keys}
    if not spec.lookups or not previous_run or not wh.refined(spec.target).exists() or own != {"id"}:
        return None
    driving = wh.replica(spec.driving_table).read()
    references = [Reference(wh.replica(t).read(), fk, key) for t, fk, key in spec.lookups]
    affected = affected_rows(driving, references, previous_run, staging)
    return spec.rows_of(staging.put(affected, "affected"))


def refine_job(
    wh: Warehouse, spec: JobSpec, run_sk: int, run_ts, previous_run: int = 0, reactivate: bool = False
) -> DataFrame:
    """``refine`` over the job's own query: over the affected rows if the job tells its lookups, else
    over all. Both give the same table. ``previous_run`` is the last good run of the job."""
    with Staging(wh.spark) as staging:
        rows = delta_source(wh, spec, previous_run, staging)
        rows = spec.rows(wh.spark) if rows is None else rows
        return refine(wh, spec, rows, run_sk, run_ts, previous_run, reactivate)


def previous_versions(refined: DataFrame) -> DataFrame:
    """Closed versions, for audits."""
    return refined.filter(F.col(n.ACTIVE) == "N")
