"""Rebuilding a stored table as of an integrated day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from daybook.errors import NoSnapshotError
from daybook.functions.days import parse_day
from daybook.functions.names import col, cols, find_column
from daybook.operators.replay import among_keys, net_changes, snapshot_as_of
from daybook.sources.store import DumpStore, month_end, schema_of
from daybook.sources.tables import write_snapshot


def stored_snapshot_as_of(
    spark: SparkSession,
    store: DumpStore,
    day: str | date,
    *,
    from_log_only: bool = False,
    keys: list | None = None,
) -> DataFrame:
    """The table at the end of ``day``, with the columns it had then.

    Starts from the newest kept snapshot up to that day and replays the rest of
    the log; without one, or with ``from_log_only=True``, replays the whole log. Whole
    months that :func:`fold_log` has folded are read in that form.

    A column that some day's dump lacked starts from null after that day: what the
    log says of it before then holds no longer.

    ``keys`` asks for the rows of some keys: values of the key column, or tuples of several
    columns' values. They go into the filters of the scans; in a ``clustered`` store files
    and row groups without them are not read.
    """
    target = parse_day(day)
    commit = store.newest_commit(spark, target)
    if commit is None:
        raise NoSnapshotError(f"no day has been integrated under {store.root} up to {target}")
    gone = store.columns_last_absent(spark, commit)
    base_commit = None if from_log_only else _newest_kept(spark, store, commit["day"])
    log = store.log_to_replay(spark, target, None if base_commit is None else base_commit["day"])
    if keys is not None:
        log = log.where(among_keys(log, keys, store.spec))
    log = _blanked(log, {c: col(store.spec.day) > F.lit(day) for c, day in gone.items()})
    base, base_day = None, None
    if base_commit is not None:
        base_day = base_commit["day"]
        base = store.snapshot_by_key(spark, base_day, schema_of(base_commit), base_commit["buckets"])
        if keys is not None:
            base = base.where(among_keys(base, keys, store.spec))
        base = _blanked(base, {c: F.lit(False) for c, day in gone.items() if day > base_day})
    # The daily job logs one row per key and day at most, and no null keys.
    rows = snapshot_as_of(
        log, target, store.spec, unique_per_day=True, null_keys=False, base=base, base_day=base_day
    )
    return rows.select(*cols(schema_of(commit).names))


def _blanked(df: DataFrame, holds: dict[str, Column]) -> DataFrame:
    """The frame with the given columns null where their condition fails."""
    own = {find_column(df, c): condition for c, condition in holds.items()}
    if not own.keys() & set(df.columns):
        return df
    return df.select(*[F.when(own[c], col(c)).alias(c) if c in own else col(c) for c in df.columns])


def _newest_kept(spark: SparkSession, store: DumpStore, until: date) -> Row | None:
    kept = [d for d in store.kept_snapshots(spark) if d <= until]
    return store.newest_commit(spark, until, among=kept)


def fold_log(spark: SparkSession, store: DumpStore) -> list[date]:
    """Keep, of each closed month, every key's newest log row beside the daily log; returns the months folded now.

    A month is closed once a later one has an integrated day. The daily log stays: a day
    within a month is rebuilt from it. A run that dies is repeated by the next.
    """
    with store.claimed(spark) as claim:
        # One row per month with a day, of one row per calendar day.
        found = store.commits(spark).select(F.trunc("day", "month").alias("month")).distinct().collect()
        months = sorted(r["month"] for r in found)[:-1]
        done = set(store.folds(spark))
        folded = [m for m in months if m not in done]
        for month in folded:
            log = store.change_log(spark, month_end(month)).where(col(store.spec.day) >= F.lit(month))
            claim.check()
            store.write_fold(spark, month, net_changes(log, store.spec))
    return folded


def recompute_snapshot(
    spark: SparkSession,
    store: DumpStore,
    day: str | date,
    output: str,
    *,
    from_log_only: bool = False,
    num_files: int | None = None,
    max_rows_per_file: int | None = None,
) -> bool:
    """Write the table as of ``day``; writes nothing if the log has no row up to then.

    Returns whether it wrote.
    """
    target = parse_day(day)
    if store.newest_commit(spark, target) is None or store.change_log(spark, target).isEmpty():
        return False
    rows = stored_snapshot_as_of(spark, store, target, from_log_only=from_log_only)
    write_snapshot(rows, output, num_files=num_files, max_rows_per_file=max_rows_per_file)
    return True
