"""Reports on a stored table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.errors import NoSnapshotError
from daybook.functions.days import parse_day
from daybook.functions.names import require_columns
from daybook.operators.report import group_count, ranked_groups
from daybook.sources.store import DumpStore


def report_latest(
    spark: SparkSession,
    store: DumpStore,
    by: str | Column | list[str | Column],
    n: int | None = None,
) -> DataFrame:
    """Rows per group in the newest integrated dump, largest first; all groups unless ``n`` asks for fewer."""
    return group_count(store.latest_snapshot(spark), by, n)


def report_incremental(
    spark: SparkSession,
    store: DumpStore,
    by: str | list[str] | None = None,
    n: int | None = None,
    *,
    day: str | date | None = None,
) -> DataFrame:
    """The report on the newest integrated day, or on any day up to ``day``, from the counts that the store keeps.

    The same rows as :func:`report_latest` on that day; neither snapshots nor log are read.
    ``by`` takes some of the store's ``report_by`` columns, all by default. A column that
    the day's dump lacks is null.
    """
    until = None if day is None else parse_day(day)
    commit = store.newest_commit(spark, until)
    if commit is None:
        raise NoSnapshotError(f"no day has been integrated under {store.root} up to {until}")
    kept = store.group_counts(spark, commit)
    of = kept.select("of.*")
    wanted = of.columns if by is None else [by] if isinstance(by, str) else by
    names = require_columns(of, wanted, "what the store counts by")
    # Numbered, as a group column may be called anything.
    groups = [F.col("of")[name].alias(f"_{i}") for i, name in enumerate(names)]
    counts = kept.groupBy(*groups).agg(F.sum("change").alias("count")).where("count <> 0")
    return ranked_groups(counts, n).toDF(*names, "count")
