"""Rebuilding a table from its change log.

A key's newest day with a valid operation decides: all its I and U rows of that
day are the table's rows, and a day with only D rows removes the key. On one day
deletes come before inserts and updates. Null keys match nothing, so their I and
U rows pile up and their deletes do nothing. Unknown operations are ignored.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.days import parse_day
from daybook.functions.names import col, cols, find_column, require_columns, spare_name, spec_for
from daybook.functions.predicates import any_null, none_null
from daybook.operators.align import align_union, cast_to
from daybook.operators.joins import join_per_key
from daybook.spec import OPS, UPSERTS, TableSpec


def _images(changes: DataFrame, spec: TableSpec) -> DataFrame:
    control = [find_column(changes, c) for c in (spec.op, spec.day)]
    return changes.select(*cols([c for c in changes.columns if c not in control]))


def _touched_keys(changes: DataFrame, spec: TableSpec) -> DataFrame:
    valid = changes.where(col(spec.op).isin(*OPS) & none_null(cols(spec.keys)))
    return valid.select(*cols(spec.keys)).distinct()


def apply_changes(snapshot: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The snapshot after one day's changes: deletes first, then inserts and updates."""
    require_columns(snapshot, spec.keys, "the snapshot")
    keys = tuple(require_columns(changes, spec.keys, "the change set"))
    (op,) = require_columns(changes, [spec.op], "the change set")
    spec = TableSpec(keys, None, op, spec.day)
    fresh = _images(changes.where(col(op).isin(*UPSERTS)), spec)
    return _replace(snapshot, _touched_keys(changes, spec), fresh, spec)


def _replace(
    base: DataFrame, touched: DataFrame, fresh: DataFrame, spec: TableSpec, *, unique: bool = False
) -> DataFrame:
    keys = require_columns(base, spec.keys, "the snapshot")
    touched = touched.toDF(*keys)
    # Analysis only: the key types both sides can be compared in.
    types = base.select(*cols(keys)).union(touched).schema
    base, touched = cast_to(base, types), cast_to(touched, types)
    if unique:
        # No key is hot, and a bucketed base keeps its layout.
        kept = base.join(touched, keys, "left_anti").select(*cols(base.columns))
    else:
        kept = join_per_key(base, touched, keys, "left_anti")
    return align_union(kept, fresh)


def snapshot_as_of(
    log: DataFrame,
    day: str | date,
    spec: TableSpec,
    *,
    unique_per_day: bool = False,
    null_keys: bool = True,
    base: DataFrame | None = None,
    base_day: str | date | None = None,
) -> DataFrame:
    """The table as it stood at the end of ``day``.

    Both settings of ``unique_per_day`` give the same rows for any log. True is
    for logs with at most one row per key and day, such as those the daily job
    writes: one shuffle and a rank window. The default finds each key's newest
    day with a combined aggregate and joins on key and day, so neither a key nor
    a (key, day) group with many rows has to fit one task.

    ``base`` is the table at the end of ``base_day``: only later days are replayed.
    ``null_keys=False`` says the log has none, which saves looking for them.
    """
    target = parse_day(day)
    spec = spec_for(log, spec, "the change log", log=True)
    since = parse_day(base_day) if base_day is not None else None
    if (base is None) != (since is None):
        raise ValueError("base and base_day belong together")
    in_reach = col(spec.day) <= F.lit(target)
    if since is not None:
        if since > target:
            raise ValueError(f"the base of {since} is newer than {target}")
        in_reach = in_reach & (col(spec.day) > F.lit(since))
    valid = log.where(in_reach & col(spec.op).isin(*OPS))

    newest = _newest_by_window if unique_per_day else _newest_by_join
    rows = newest(valid.where(none_null(cols(spec.keys))), spec)
    if null_keys:
        rows = rows.unionByName(valid.where(any_null(cols(spec.keys)) & col(spec.op).isin(*UPSERTS)))
    rows = _images(rows, spec)
    if base is None:
        return rows
    return _replace(base, _touched_keys(valid, spec), rows, spec, unique=unique_per_day)


def among_keys(df: DataFrame, keys: list, spec: TableSpec) -> Column:
    """Whether a row's key is among some keys: values, or tuples if the key has several columns.

    A replay of the rows that fit gives the table's rows that fit, as keys do not mix. Each
    column has a condition of its own, too, which scans can use. A null key fits nothing.
    """
    names = require_columns(df, spec.keys, "the rows")
    given = [tuple(k) if isinstance(k, (tuple, list)) else (k,) for k in keys]
    if any(len(k) != len(names) for k in given):
        raise ValueError(f"a key has the columns {names}")
    given = [k for k in given if None not in k]
    if not given:
        return F.lit(False)
    types = [df.schema[n].dataType for n in names]
    each = reduce(and_, [col(n).isin([k[i] for k in given]) for i, n in enumerate(names)])
    if len(names) == 1:
        return each
    of = F.struct(*[col(n).alias(f"_{i}") for i, n in enumerate(names)])
    wanted = [F.struct(*[F.lit(v).cast(t).alias(f"_{i}") for i, (v, t) in enumerate(zip(k, types))]) for k in given]
    return each & of.isin(wanted)


def net_changes(log: DataFrame, spec: TableSpec) -> DataFrame:
    """Log rows of each key's newest day: all that a replay to the end of the log needs of it.

    For logs with at most one row per key and day, or few: a key's rows meet in one task,
    cut to those of its newest day before the shuffle. Rows with a null key all stay.
    """
    spec = spec_for(log, spec, "the change log", log=True)
    valid = log.where(col(spec.op).isin(*OPS))
    newest = _newest_rows(valid.where(none_null(cols(spec.keys))), spec)
    return newest.unionByName(valid.where(any_null(cols(spec.keys)) & col(spec.op).isin(*UPSERTS)))


def _newest_rows(valid: DataFrame, spec: TableSpec) -> DataFrame:
    # rank, not row_number: rows of one key and day belong together.
    newest_first = Window.partitionBy(*cols(spec.keys)).orderBy(col(spec.day).desc())
    rank = spare_name("_rank", valid)
    return valid.withColumn(rank, F.rank().over(newest_first)).where(col(rank) == 1).drop(rank)


def _newest_by_window(valid: DataFrame, spec: TableSpec) -> DataFrame:
    return _newest_rows(valid, spec).where(col(spec.op).isin(*UPSERTS))


def _newest_by_join(valid: DataFrame, spec: TableSpec) -> DataFrame:
    newest = valid.groupBy(*cols(spec.keys)).agg(F.max(col(spec.day)).alias(spec.day))
    images = valid.where(col(spec.op).isin(*UPSERTS))
    # On key and day, so a busy key spreads over its days and AQE can split the rest.
    return join_per_key(images, newest, [*spec.keys, spec.day], "inner").select(*cols(valid.columns))


def history(log: DataFrame, spec: TableSpec) -> DataFrame:
    """Every row that the table ever held, from day ``since`` to before day ``until`` (null: to this day).

    The rows of one day of a key last until the key's next day with a valid operation;
    rows with a null key last for good. One pass over the log, for any number of days
    asked about later.
    """
    spec = spec_for(log, spec, "the change log", log=True)
    taken = {c.lower() for c in log.columns if c not in (spec.op, spec.day)}
    if taken & {"since", "until"}:
        raise ValueError("the table's columns may not be named since or until")
    valid = log.where(col(spec.op).isin(*OPS))
    keyed = valid.where(none_null(cols(spec.keys)))
    # One row per key and day: a busy key has as many as there are days.
    days = keyed.select(*cols([*spec.keys, spec.day])).distinct()
    following = Window.partitionBy(*cols(spec.keys)).orderBy(col(spec.day))
    days = days.withColumn("until", F.lead(col(spec.day)).over(following))
    lasting = join_per_key(keyed.where(col(spec.op).isin(*UPSERTS)), days, [*spec.keys, spec.day], "inner")
    piled = valid.where(any_null(cols(spec.keys)) & col(spec.op).isin(*UPSERTS))
    rows = lasting.unionByName(piled.withColumn("until", F.lit(None).cast("date")))
    own = [c for c in log.columns if c not in (spec.op, spec.day)]
    return rows.select(*cols(own), col(spec.day).cast("date").alias("since"), "until")


def snapshots_as_of(log: DataFrame, days: list[str | date], spec: TableSpec) -> DataFrame:
    """The table as it stood at the end of each of ``days``, in one plan; ``as_of`` says which.

    The same rows as :func:`snapshot_as_of` gives day by day. The days that the log holds
    are placed among the days asked for, so that a row of the :func:`history` knows the
    first and the last of them that it lasts over without being held against each.
    """
    asked = sorted({parse_day(d) for d in days})
    if not asked:
        raise ValueError("no days are asked for")
    spec = spec_for(log, spec, "the change log", log=True)
    if find_column(log, "as_of") is not None:
        raise ValueError("the table's columns may not be named as_of")
    log = log.where(col(spec.day) <= F.lit(asked[-1]))
    spark = log.sparkSession
    held = log.select(col(spec.day).cast("date").alias("at")).distinct().withColumn("n", F.lit(0))
    marks = held.unionByName(spark.createDataFrame([(d, 1) for d in asked], "at date, n int"))
    # A row per calendar day; so is the one window over all of them, and what is broadcast.
    before = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    places = marks.groupBy("at").agg(F.sum("n").alias("n"))
    places = places.select("at", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("int").alias("place"))
    rows = history(log, spec)
    from_at, from_place, to_at, to_place = (spare_name(n, rows) for n in ("_from", "_first", "_to", "_last"))
    placed = rows.join(F.broadcast(places.toDF(from_at, from_place)), col("since") == col(from_at))
    placed = placed.join(F.broadcast(places.toDF(to_at, to_place)), col("until") == col(to_at), "left")
    end = F.coalesce(col(to_place), F.lit(len(asked)))
    lasting = placed.where(col(from_place) < end)
    of_days = F.slice(F.array(*[F.lit(d) for d in asked]), col(from_place) + 1, end - col(from_place))
    own = cols([c for c in rows.columns if c not in ("since", "until")])
    return lasting.select(*own, F.explode(of_days).alias("as_of"))


def log_days(log: DataFrame, spec: TableSpec, until: str | date | None = None) -> DataFrame:
    """The days the log holds, ascending."""
    (day,) = require_columns(log, [spec.day], "the change log")
    if until is not None:
        log = log.where(col(day) <= F.lit(parse_day(until)))
    return log.select(col(day)).distinct().orderBy(col(day))


def log_day(
    log: DataFrame, day: str | date, spec: TableSpec, ops: tuple[str, ...] = UPSERTS
) -> DataFrame:
    """One day's row images with one of the given operations, without op and day."""
    spec = spec_for(log, spec, "the change log", log=True)
    wanted = (col(spec.day) == F.lit(parse_day(day))) & col(spec.op).isin(*ops)
    return _images(log.where(wanted), spec)


def stamp_day(changes: DataFrame, day: str | date, spec: TableSpec) -> DataFrame:
    """A day's change set as change-log rows."""
    return changes.withColumn(spec.day, F.lit(parse_day(day)))
