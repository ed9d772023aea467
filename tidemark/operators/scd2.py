"""Slowly changing dimension, type 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import names as n
from tidemark.functions.columns import as_timestamp, business_columns, differs, named
from tidemark.functions.hashing import row_hash
from tidemark.functions.schema import align_to_target, spelled_like
from tidemark.operators.surrogate import assign_surrogate, highest
from tidemark.operators.update import assign, update_where_in


def scd2_hash(
    df: DataFrame,
    keys: Sequence[str],
    exclusions: Sequence[str] = n.DEFAULT_EXCLUSIONS,
    compat: bool = False,
) -> DataFrame:
    """Add the key hash and the change hash in front of the lower-cased columns.

    The change hash covers the business columns in sorted order; a table that is all key
    hashes all its columns, and so does one whose other columns are all excluded.
    """
    lowered = df.select(*[F.col(f"`{c}`").alias(c.lower()) for c in df.columns])
    keys = [k.strip().lower() for k in keys]
    changing = business_columns(lowered.columns, keys, exclusions) or sorted(lowered.columns)
    return lowered.select(
        row_hash(keys, compat).alias(n.KEY_HASH),
        row_hash(changing, compat).alias(n.CHANGE_HASH),
        "*",
    )


def scd2_metadata(df: DataFrame, surrogate: str, run_sk: int, run_ts) -> DataFrame:
    """Add the version columns of an incoming row: active, open-ended, surrogate 0."""
    now = as_timestamp(run_ts)
    return df.withColumns(
        {
            surrogate: F.lit(0).cast("bigint"),
            n.ACTIVE: F.lit("Y"),
            n.EFFECTIVE: now,
            n.EXPIRY: as_timestamp(n.OPEN_END),
            n.CREATED: now,
            n.UPDATED: now,
            n.LAST_RUN: F.lit(str(run_sk)),
        }
    )


def scd2_initial(source: DataFrame, surrogate: str, run_sk: int, prefix: int = 3) -> DataFrame:
    """First load: every source row becomes version one, numbered from 1."""
    numbered = assign_surrogate(source, surrogate, prefix=prefix)
    return numbered.withColumn(n.INSERT_RUN, F.lit(str(run_sk)))


INSERT = "_insert"
KNOWN = "_known"
HASHES = (n.KEY_HASH, n.CHANGE_HASH)


def is_active() -> Column:
    """Active version; a form that reaches the parquet scan and never yields NULL."""
    return F.col(n.ACTIVE).eqNullSafe(F.lit("Y"))


def key_states(target: DataFrame) -> DataFrame:
    """One narrow row per key of the target; three columns are read. Few versions of a key lie in one
    map task, so rows are shuffled as they are and sorted once, not before the shuffle as well."""
    active = is_active()
    narrow = target.select(n.KEY_HASH, n.CHANGE_HASH, n.ACTIVE)
    return narrow.repartition(n.KEY_HASH).groupBy(n.KEY_HASH).agg(
        F.count(F.lit(1)).alias("_versions"),
        F.max(F.when(active, F.col(n.CHANGE_HASH))).alias("_active_hash"),
        F.max(n.CHANGE_HASH).alias("_any_hash"),
    )


def classify(source: DataFrame, target: DataFrame, reactivate: bool = False) -> DataFrame:
    """Key hash of each source row with what the load will do about it.

    ``_insert``: a version is added. ``_known``: the target already holds this content, as
    the active version or as the only version of the key.
    """
    pairs = source.select(n.KEY_HASH, n.CHANGE_HASH)
    return classified_rows(pairs, target, reactivate).select(n.KEY_HASH, INSERT, KNOWN)


def classified_rows(source: DataFrame, target: DataFrame, reactivate: bool = False) -> DataFrame:
    """As ``classify``, with all columns of the source."""
    pairs = source.join(key_states(target), n.KEY_HASH, "left")
    change = F.col(n.CHANGE_HASH)
    unseen = F.col("_versions").isNull()
    active = F.col("_active_hash").isNotNull()
    insert = unseen | (active & differs(change, F.col("_active_hash")))
    if reactivate:
        insert = insert | ~active
    known = (change == F.col("_active_hash")) | (
        (F.col("_versions") == 1) & (change == F.col("_any_hash"))
    )
    columns = [F.col(f"`{c}`") for c in source.columns]
    return pairs.select(*columns, insert.alias(INSERT), F.coalesce(known, F.lit(False)).alias(KNOWN))


def scd2_rows_read(
    source: DataFrame, target: DataFrame | None = None, classified: DataFrame | None = None
) -> DataFrame:
    """Source rows that are new work: all of them on a first load, else those the target
    does not hold yet. ``classified`` is the output of ``classify`` if it is at hand."""
    if target is None:
        return source.agg(F.count(F.lit(1)).alias("rows_read"))
    classified = classify(source, target) if classified is None else classified
    return classified.agg(*[c.alias(name) for name, c in read_counts().items()])


def read_counts() -> dict[str, Column]:
    """The count of ``scd2_rows_read`` over classified rows."""
    return {"rows_read": F.count_if(~F.col(KNOWN))}


def pack_hashes(source: DataFrame) -> DataFrame:
    """``source`` with the MD5 texts of ``scd2_hash`` as their 16 bytes, half of what moves. Only for
    hashes made here: those of a stored table may be other texts."""
    return source.withColumns({c: F.unhex(c) for c in HASHES})


def unpack_hashes(versions: DataFrame) -> DataFrame:
    return versions.withColumns({c: F.lower(F.hex(c)) for c in HASHES})


def number_inserts(
    source: DataFrame,
    target: DataFrame,
    surrogate: str,
    reactivate: bool = False,
    prefix: int = 3,
    classified: DataFrame | None = None,
) -> DataFrame:
    """Mark the source rows that will be inserted (``_insert``) and give them the next free
    surrogate keys.

    Works on (key hash, change hash, flag) only, so no wide row moves for the numbering. The
    numbering reads the classification twice; a job passes a stored one as ``classified``.
    """
    if classified is None:
        classified = classify(source, target, reactivate)
    inserts = classified.filter(INSERT).select(n.KEY_HASH)
    numbered = assign_surrogate(inserts, "_sk", highest(target, surrogate), prefix=prefix)
    joined = source.join(numbered, n.KEY_HASH, "left")
    return joined.withColumns(
        {
            INSERT: F.col("_sk").isNotNull(),
            surrogate: F.coalesce(F.col("_sk"), F.col(surrogate)).cast("bigint"),
        }
    ).drop("_sk")


def scd2_merge(
    target: DataFrame, source: DataFrame, run_sk: int, run_ts, reactivate: bool = False
) -> DataFrame:
    """Next state of a history table; ``source`` has one row per key hash.

    * active version with another change hash: closed, and a new version is added;
    * key the target has never seen: added;
    * same change hash, or key missing from the source: nothing happens;
    * key with closed versions only: nothing, unless ``reactivate``.

    Closed versions never change, so they are passed through without a shuffle. A source that
    went through ``number_inserts`` already says which unmatched keys are new; otherwise the
    distinct keys of the closed versions are looked up.
    """
    closed = target.filter(~is_active())
    if INSERT not in source.columns and not reactivate:
        closed_keys = closed.select(n.KEY_HASH).distinct().withColumn("_closed", F.lit(True))
        joined = source.join(closed_keys, n.KEY_HASH, "left")
        source = joined.withColumn(INSERT, F.col("_closed").isNull()).drop("_closed")
    moved = scd2_step(target.filter(is_active()), source, run_sk, run_ts)
    return closed.unionByName(moved, allowMissingColumns=True)


#: Marks the versions that a merge closed, where asked for.
REPLACED = "_replaced"


def scd2_step(
    active: DataFrame, source: DataFrame, run_sk: int, run_ts, mark: bool = False
) -> DataFrame:
    """The part of a merge that touches rows: active versions in, active and newly closed
    versions out.

    ONE full outer join; a changed pair yields two rows there, so neither side is evaluated
    twice. Source rows without ``_insert`` never add a version for an unmatched key. ``mark`` adds
    ``_replaced``, true on the versions closed here, which tells them from those that delete
    propagation closes in the same run.
    """
    source = align_to_target(spelled_like(source, active.schema), active)
    if INSERT not in source.columns:
        source = source.withColumn(INSERT, F.lit(True))
    added = [c for c in source.columns if c != INSERT and named(active, c) is None]
    incoming = source.withColumnsRenamed({c: f"_s_{c}" for c in source.columns})
    pairs = active.join(incoming, F.col(n.KEY_HASH) == F.col(f"_s_{n.KEY_HASH}"), "full_outer")
    old_exists = F.col(n.KEY_HASH).isNotNull()
    new_exists = F.col(f"_s_{n.KEY_HASH}").isNotNull()
    changed = old_exists & new_exists & differs(F.col(n.CHANGE_HASH), F.col(f"_s_{n.CHANGE_HASH}"))
    fresh = ~old_exists & new_exists & F.col(f"_s_{INSERT}")
    sides = (
        F.when(changed, F.array(F.lit(0), F.lit(1)))
        .when(old_exists, F.array(F.lit(0)))
        .when(fresh, F.array(F.lit(1)))
    )
    versions = pairs.withColumn("_changed", changed).withColumn("_side", F.explode(sides))
    expired = F.col("_changed") & (F.col("_side") == 0)
    closing = {c.lower(): v for c, v in _closing(run_sk, run_ts).items()}
    delivered = {c.lower() for c in source.columns}

    def value(c: str) -> Column:
        old = F.lit(None) if c in added else F.col(f"`{c}`")
        if c.lower() in closing:
            old = F.when(expired, closing[c.lower()]).otherwise(old)
        new = F.col(f"`_s_{c}`") if c.lower() in delivered else F.lit(None)
        if c.lower() == n.INSERT_RUN.lower():
            new = F.lit(str(run_sk))
        return F.when(F.col("_side") == 0, old).otherwise(new)

    marks = [expired.alias(REPLACED)] if mark else []
    return versions.select(*[value(c).alias(c) for c in [*active.columns, *added]], *marks)


def _closing(run_sk: int, run_ts) -> dict[str, Column]:
    """Columns set on a version that is closed."""
    now = as_timestamp(run_ts)
    return {
        n.ACTIVE: F.lit("N"),
        n.EXPIRY: now,
        n.UPDATED: now,
        n.LAST_RUN: F.lit(str(run_sk)),
    }


def scd2_reconcile(
    rows_read: DataFrame,
    target: DataFrame,
    run_sk: int,
    initial: bool = False,
    after_expiry: bool = False,
) -> DataFrame:
    """Counts of a history load; it succeeds when every row read became a version.

    Versions closed by delete propagation carry the same run id as versions closed by the
    merge. ``after_expiry`` counts on a table where both have happened: a merge closes a
    version only where it also adds one for the key.
    """
    run = str(run_sk)
    inserted = F.col(n.INSERT_RUN) == run
    if initial:
        updated = F.col(n.LAST_RUN) == "-1"
    else:
        updated = (F.col(n.LAST_RUN) == run) & (F.col(n.INSERT_RUN) != run)
    aggregates = [
        F.count_if(inserted).alias("rows_inserted"),
        F.count_if(updated).alias("rows_updated"),
    ]
    if after_expiry and not initial:
        touched = target.filter(inserted | updated)
        per_key = touched.groupBy(n.KEY_HASH).agg(*aggregates)
        counts = per_key.agg(
            F.coalesce(F.sum("rows_inserted"), F.lit(0)).alias("rows_inserted"),
            F.coalesce(
                F.sum(F.when(F.col("rows_inserted") > 0, F.col("rows_updated"))), F.lit(0)
            ).alias("rows_updated"),
        )
    else:
        counts = target.agg(*aggregates)
    return scd2_balance(rows_read, counts)


def step_counts(run_sk: int, replaced: Column | None = None) -> dict[str, Column]:
    """Counts of a history load over the rows it writes: versions of this run, and versions closed
    for them (told by ``replaced`` where delete propagation has closed others)."""
    run = str(run_sk)
    inserted = F.col(n.INSERT_RUN) == run
    if replaced is None:
        replaced = (F.col(n.LAST_RUN) == run) & (F.col(n.INSERT_RUN) != run)
    return {"rows_inserted": F.count_if(inserted), "rows_updated": F.count_if(replaced)}


def scd2_balance(rows_read: DataFrame, counts: DataFrame) -> DataFrame:
    """Reconciliation row from ``rows_read`` and one row of ``rows_inserted, rows_updated``."""
    read = F.coalesce(rows_read.select("rows_read").scalar(), F.lit(0)).cast("long")
    return counts.withColumn("rows_read", read).select(
        "rows_read",
        (F.col("rows_inserted") + F.col("rows_updated")).alias("rows_loaded"),
        "rows_inserted",
        "rows_updated",
        F.when(F.col("rows_read") == F.col("rows_inserted"), "S").otherwise("F").alias("status"),
    )


def current_rows(refined: DataFrame) -> DataFrame:
    """Active versions only."""
    return refined.filter(is_active())


def duplicate_active_keys(refined: DataFrame) -> DataFrame:
    """Keys with more than one active version; a healthy table has none."""
    active = current_rows(refined).groupBy(n.KEY_HASH).agg(F.count(F.lit(1)).alias("versions"))
    return active.filter("versions > 1")


def _expire(
    refined: DataFrame,
    gone: DataFrame,
    keys: Sequence[str],
    driving_keys: Sequence[str],
    run_sk: int,
    run_ts,
    compat: bool,
    split: bool = True,
) -> DataFrame:
    """``split`` reads active and closed rows apart, so that the closed rows of a stored table
    skip the join; on a computed frame that would compute it twice."""
    on = [
        (F.trim(F.col(k).cast("string")), F.trim(F.col(d).cast("string")))
        for k, d in zip(keys, driving_keys)
    ]
    values = _closing(run_sk, run_ts)
    if compat:
        return update_where_in(refined, gone, on, values)
    if not split:
        return update_where_in(refined, gone, on, values, guard=is_active())
    touched = update_where_in(refined.filter(is_active()), gone, on, values)
    return refined.filter(~is_active()).unionByName(touched)


def expire_soft_deleted(
    refined: DataFrame,
    driving: DataFrame,
    keys: Sequence[str],
    driving_keys: Sequence[str],
    previous_run: int,
    run_sk: int,
    run_ts,
    compat: bool = False,
) -> DataFrame:
    """Close the versions of keys soft-deleted in the driving table since ``previous_run``.

    Only active versions are closed (and only they are joined); ``compat`` rewrites the
    expiry of every version of the key.
    """
    gone = driving.filter((F.col(n.RUN) > previous_run) & (F.col(n.SOFT_DELETE) == "Y"))
    return _expire(refined, gone, keys, driving_keys, run_sk, run_ts, compat)


def expire_retired(
    refined: DataFrame,
    driving: DataFrame,
    keys: Sequence[str],
    driving_keys: Sequence[str],
    previous_run: int,
    run_sk: int,
    run_ts,
    compat: bool = False,
) -> DataFrame:
    """As ``expire_soft_deleted`` for rows with ``retired`` other than 0; a driving table
    without that column changes nothing."""
    retired = named(driving, "retired")
    if retired is None:
        return refined
    gone = driving.filter((F.col(n.RUN) > previous_run) & (F.col(retired) != 0))
    return _expire(refined, gone, keys, driving_keys, run_sk, run_ts, compat)


def expire_gone(
    refined: DataFrame,
    driving: DataFrame,
    keys: Sequence[str],
    driving_keys: Sequence[str],
    previous_run: int,
    run_sk: int,
    run_ts,
    compat: bool = False,
    split: bool = True,
) -> DataFrame:
    """Soft-delete and retire propagation in one pass over the given versions.

    Rows that are closed already pass through, so this also serves on the rows that
    ``scd2_step`` returns; there ``split=False`` keeps the plan from being run twice.
    """
    gone = gone_rows(driving, previous_run)
    return _expire(refined, gone, keys, driving_keys, run_sk, run_ts, compat, split)


def gone_rows(driving: DataFrame, previous_run: int) -> DataFrame:
    """Rows of the driving table soft-deleted or retired since ``previous_run``."""
    reason = F.col(n.SOFT_DELETE) == "Y"
    retired = named(driving, "retired")
    if retired is not None:
        reason = reason | (F.col(retired) != 0)
    return driving.filter((F.col(n.RUN) > previous_run) & reason)


#: Marks the versions of keys that are gone.
GONE = "_gone"


def gone_hashes(
    active: DataFrame,
    source: DataFrame,
    driving: DataFrame,
    keys: Sequence[str],
    driving_keys: Sequence[str],
    previous_run: int,
) -> DataFrame | None:
    """Distinct key hashes of the keys that ``expire_gone`` closes, for ``flag_gone``; None where keys
    are not all whole numbers: other texts may differ in blanks, which a hash tells apart."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

    def plain(df: DataFrame, columns: Sequence[str]) -> bool:
        found = [named(df, c.strip()) for c in columns]
        return all(c is not None and isinstance(df.schema[c].dataType, whole) for c in found)

    if len(keys) != len(driving_keys) or not (plain(active, keys) and plain(source, keys) and plain(driving, driving_keys)):
        return None
    columns = [c.strip() for c in driving_keys]
    rows = gone_rows(driving, previous_run).select(*[F.col(f"`{c}`") for c in columns]).dropna()
    return rows.select(row_hash(columns).alias(n.KEY_HASH)).distinct()


def flag_gone(versions: DataFrame, hashes: DataFrame) -> DataFrame:
    """``versions`` with ``_gone``. The join is on the column that a merge joins on, before it."""
    marked = hashes.withColumn(GONE, F.lit(True))
    return versions.join(marked, n.KEY_HASH, "left")


def close_gone(versions: DataFrame, run_sk: int, run_ts) -> DataFrame:
    """Close the active versions that ``flag_gone`` marked."""
    hit = F.coalesce(F.col(GONE), F.lit(False)) & is_active()
    return assign(versions, hit, _closing(run_sk, run_ts)).drop(GONE)
