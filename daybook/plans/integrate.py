"""The daily job: take in one day's dump."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.errors import DayOrderError, MalformedRowsError, MissingColumnError
from daybook.functions.days import parse_day
from daybook.functions.names import col, cols, find_column, fold, require_columns
from daybook.functions.predicates import any_null
from daybook.operators.diff import change_counts, change_set, change_set_by_digests, row_digests, touched_keys
from daybook.operators.quality import clean_dump, duplicate_keys, watched
from daybook.operators.report import group_changes
from daybook.plans.recompute import stored_snapshot_as_of
from daybook.sources.claims import Claim
from daybook.sources.csv_dump import read_csv_dump
from daybook.sources.store import COUNTS, DumpStore, log_columns_of, schema_of
from daybook.sources.tables import empty_frame, read_snapshot, write_snapshot
from daybook.spec import DELETE, INSERT, UPDATE

#: Changed keys of a day that are sent to every task, in bytes; of more, whole days are compared.
FEW_KEYS_BYTES = 64 << 20


@dataclass(frozen=True)
class Integration:
    """What a run did. ``skipped`` means the day had been integrated before."""

    day: date
    skipped: bool
    counts: dict[str, int | None]


def integrate_csv(
    spark: SparkSession,
    store: DumpStore,
    day: str | date,
    path: str | list[str],
    schema: T.StructType | str,
    *,
    strict: bool = False,
    csv_options: dict | None = None,
    **settings,
) -> Integration:
    """Integrate a day's dump from CSV files; see :func:`integrate_day`.

    The files are parsed once, into a Parquet copy that goes when the day is done. A
    line that does not fit the columns (too few or too many fields, a value of another
    type) is taken as far as it fits and counted in ``malformed_rows``; ``strict=True``
    refuses a dump with such lines. With ``check_quality=False`` nothing is counted.
    """
    day = parse_day(day)
    options = dict(csv_options or {})
    if strict and not settings.get("check_quality", True):
        raise ValueError("a strict run has to check the dump")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    odd = options.pop("malformed_column", None)
    if odd is None:
        odd = "_malformed"
        while odd in {n.lower() for n in schema.names}:
            odd += "_"
    dump = read_csv_dump(spark, path, schema, malformed_column=odd, **options)
    return _integrate(spark, store, day, dump, odd=odd, strict=strict, **settings)


def integrate_day(
    spark: SparkSession,
    store: DumpStore,
    day: str | date,
    dump: DataFrame,
    *,
    check_quality: bool = True,
    num_files: int | None = None,
    max_rows_per_file: int | None = None,
    keep_snapshots: int = 2,
    late: bool = False,
) -> Integration:
    """Clean a full dump, log what changed since the last one, make it the latest.

    The cleaned dump is stored first, and the change set is computed from what was
    stored, so log and snapshot cannot disagree and the dump is parsed and cleaned
    once. The commit record comes last: a run that dies before it leaves nothing a
    reader can see, and running the day again gives the same result as one clean
    run. One run per store at a time: a second one raises ``ClaimError`` while the
    first is at work.

    ``check_quality=False`` saves the extra pass over the dump's key columns that
    counts null and duplicate keys; the figures are then None.

    ``late=True`` also takes a day that was missed, before days already integrated: its
    changes are logged since the day before it, and the day after it gets a new log of
    its changes since the late day. Both become visible with the late day's record, the
    last thing written; until then readers see the log as it was. The neighbours' dumps
    are read if they are kept, else rebuilt from the log. The log then says what it would
    say had all days come in order. A late dump may lack columns but not bring one that
    the day after it does not know (``ValueError``).
    """
    return _integrate(
        spark,
        store,
        parse_day(day),
        dump,
        check_quality=check_quality,
        num_files=num_files,
        max_rows_per_file=max_rows_per_file,
        keep_snapshots=keep_snapshots,
        late=late,
    )


def _integrate(
    spark: SparkSession,
    store: DumpStore,
    day: date,
    parsed: DataFrame,
    *,
    odd: str | None = None,
    strict: bool = False,
    check_quality: bool = True,
    num_files: int | None = None,
    max_rows_per_file: int | None = None,
    keep_snapshots: int = 2,
    late: bool = False,
) -> Integration:
    """``odd`` names the column of ``parsed`` that holds what did not fit; it is not the table's."""
    spec = store.spec
    dump = parsed.select(*cols([c for c in parsed.columns if c != odd]))
    require_columns(dump, spec.keys, "the dump")
    taken = [c for c in (find_column(dump, spec.op), find_column(dump, spec.day)) if c]
    if taken:
        raise ValueError(f"the dump may not hold the log's own columns {taken}")
    files = {"num_files": num_files, "max_rows_per_file": max_rows_per_file}
    with store.claimed(spark) as claim:
        return _integrate_claimed(
            spark, store, claim, day, dump, parsed, odd, strict, check_quality, files, keep_snapshots, late
        )


def _integrate_claimed(
    spark: SparkSession,
    store: DumpStore,
    claim: Claim,
    day: date,
    dump: DataFrame,
    parsed: DataFrame,
    odd: str | None,
    strict: bool,
    check_quality: bool,
    files: dict[str, int | None],
    keep_snapshots: int,
    late: bool,
) -> Integration:
    spec = store.spec
    last = store.newest_commit(spark)
    following = None
    if last is not None and last["day"] >= day:
        done = store.newest_commit(spark, among=[day])
        if done is not None:
            return Integration(day, True, _counts_of(done))
        if not late:
            raise DayOrderError(f"{day} comes before {last['day']}, which is already integrated")
        last, following = store.newest_commit(spark, day), store.next_commit(spark, day)

    # A type that does not fit is refused before anything is written.
    before = None if last is None else log_columns_of(last)
    ever = {fold(spark, n) for n in _log_columns(spark, before, dump.schema).names}
    if following is not None:
        known = {fold(spark, n) for n in _log_columns(spark, log_columns_of(following), dump.schema).names}
        new = sorted(known - {fold(spark, n) for n in log_columns_of(following).names})
        if new:
            raise ValueError(f"{following['day']} does not know the columns {new} of {day}, which comes late")
    unknown = [c for c in store.report_by if fold(spark, c) not in ever]
    if unknown:
        raise MissingColumnError(f"the table never had {unknown}, which its rows are to be counted by")
    seen = None
    if odd is not None and check_quality:
        dump, seen = _staged(spark, store, day, parsed, odd)
        if strict and seen["malformed_rows"]:
            store.drop_staged(spark)
            raise MalformedRowsError(f"{seen['malformed_rows']} lines of the dump of {day} do not fit its columns")
    # Repeated keys are counted where their rows meet to be cleaned.
    cleaning = Observation() if check_quality and store.writes_as_is(spark, files["num_files"]) else None
    cleaned = clean_dump(dump, spec if cleaning is None else watched(spec, cleaning))
    store.write_snapshot(cleaned, day, **files)
    current = store.snapshot_by_key(spark, day, _nullable(dump.schema), store.buckets)

    # A late day is never compared with a day to come.
    digests = store.digests_of(spark, day, current.schema) if following is None else None
    if last is None:
        older, newer = empty_frame(spark, current.schema), current
    elif following is not None:
        older, newer = _table_of(spark, store, last), current
    else:
        older, newer = store.pair_of_snapshots(spark, last, day, current.schema, digests)
    if following is None:
        changes = _changes(spark, store, last, day, older, newer)
    else:
        store.write_row_digests(day, None, spark)
        changes = change_set(older, newer, spec, keys_unique=True, null_keys=False)
    log_columns = _log_columns(spark, before, changes.drop(spec.op).schema)
    # The comparison runs on partitions sized for two dumps. Many changes are written from
    # there without moving again; few ones are gathered into full files.
    store.write_log(changes, day, gathered=last is not None, **files)

    counts = _count(spark, store, day, dump, current, changes.schema, last)
    counts |= _quality(store, dump, counts["snapshot_rows"], seen, cleaning) if check_quality else {}
    chain = last if following is None else None
    groups, whole = _count_groups(spark, store, chain, day, current, changes.schema, log_columns)
    spliced = None
    if following is not None:
        own = {fold(spark, n) for n in log_columns.names}
        log_columns = T.StructType([f for f in log_columns_of(following).fields if fold(spark, f.name) in own])
        spliced = _splice(spark, store, day, current, following, files)
    claim.check()
    if following is not None:
        store.drop_folds(spark, [day, following["day"]])
    store.write_commit(spark, day, current.schema, log_columns, counts, digests, groups, whole, spliced)
    store.expire_snapshots(spark, keep_snapshots)
    store.drop_staged(spark)
    return Integration(day, False, counts)


def _splice(
    spark: SparkSession,
    store: DumpStore,
    late: date,
    current: DataFrame,
    following: Row,
    files: dict[str, int | None],
) -> dict[str, object]:
    """Log the changes from a late day to the one after it; what the late day's record says of that."""
    day = following["day"]
    after = _table_of(spark, store, following)
    changes = change_set(current, after, store.spec, keys_unique=True, null_keys=False)
    store.write_log(changes, day, late=late, gathered=True, **files)
    written = read_snapshot(spark, store.log_path(day, late), changes.schema)
    ops = {r[store.spec.op]: r["count"] for r in change_counts(written, store.spec).collect()}
    if following["groups"] is not None:
        groups = T.StructType.fromJson(json.loads(following["groups"]))
        store.write_groups(day, _whole_groups(after, groups), late)
    return {
        "next_day": day,
        "next_inserted": ops.get(INSERT, 0),
        "next_updated": ops.get(UPDATE, 0),
        "next_deleted": ops.get(DELETE, 0),
        "next_groups": following["groups"] is not None,
    }


def _table_of(spark: SparkSession, store: DumpStore, commit: Row) -> DataFrame:
    """An integrated day's table: its snapshot, or what the log makes of it."""
    if commit["day"] in store.kept_snapshots(spark):
        return store.snapshot_by_key(spark, commit["day"], schema_of(commit), commit["buckets"])
    return stored_snapshot_as_of(spark, store, commit["day"])


def _changes(
    spark: SparkSession, store: DumpStore, last: Row | None, day: date, older: DataFrame, newer: DataFrame
) -> DataFrame:
    """What changed since the last day. A cleaned dump has one row per key and no null keys."""
    own = row_digests(newer, store.spec) if store.row_digests else None
    own = store.write_row_digests(day, own, spark)
    if own is not None and last is not None and schema_of(last) == newer.schema:
        before = store.read_row_digests(spark, last["day"], own.schema)
        if before is not None:
            touched = store.write_touched(day, touched_keys(before, own, store.spec), spark)
            # Counted, so that what is sent to every task has a bound.
            if touched.count() * touched._jdf.schema().defaultSize() <= FEW_KEYS_BYTES:
                return change_set_by_digests(older, newer, store.spec, touched, few=True)
    return change_set(older, newer, store.spec, keys_unique=True, null_keys=False)


def _staged(
    spark: SparkSession, store: DumpStore, day: date, parsed: DataFrame, odd: str
) -> tuple[DataFrame, dict[str, int]]:
    """The dump as parsed, in Parquet, and its rows, those that did not fit, those without a key.

    Counted while the copy is written. Parsing moves no rows, so the tasks that write the copy
    do all of it, and Spark counts each of them once.
    """
    seen = Observation()
    figures = [*_figures(store, parsed), F.count_if(col(odd).isNotNull()).alias("malformed_rows")]
    rows = parsed.observe(seen, *figures).select(*cols([c for c in parsed.columns if c != odd]))
    write_snapshot(rows, store.staged_path(day))
    return read_snapshot(spark, store.staged_path(day), rows.schema), seen.get


def _figures(store: DumpStore, rows: DataFrame) -> list[Column]:
    """What is counted of a dump as given: its rows, and those without a key."""
    keys = require_columns(rows, store.spec.keys, "the dump")
    return [F.count(F.lit(1)).alias("dump_rows"), F.count_if(any_null(cols(keys))).alias("null_keys")]


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def _log_columns(spark: SparkSession, before: T.StructType | None, now: T.StructType) -> T.StructType:
    """The log's columns so far and this day's; a column keeps its type and first spelling for good."""
    fields = {fold(spark, f.name): f for f in (before.fields if before else [])}
    for f in now.fields:
        first = fields.setdefault(fold(spark, f.name), f)
        # As texts, which do not say whether a nested value may be null.
        if first.dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(
                f"column {f.name!r} was {first.dataType.simpleString()} in the log "
                f"and is {f.dataType.simpleString()} now"
            )
    return T.StructType(list(fields.values()))


def _count_groups(
    spark: SparkSession,
    store: DumpStore,
    last: Row | None,
    day: date,
    current: DataFrame,
    change_schema: T.StructType,
    log_columns: T.StructType,
) -> tuple[T.StructType | None, bool | None]:
    """Store the day's groups: how they changed since the last day if that follows from the log, else whole counts."""
    by = list(store.report_by)
    if not by:
        return None, None
    types = {fold(spark, f.name): f.dataType for f in log_columns.fields}
    groups = T.StructType([T.StructField(c, types[fold(spark, c)]) for c in by])
    older = None if last is None else store.snapshot_by_key(spark, last["day"], schema_of(last), last["buckets"])
    compared = store.spec.compared
    seen = None if compared is None else {fold(spark, c) for c in (*store.spec.keys, *compared)}
    if (
        older is not None
        and last["groups"] is not None
        and T.StructType.fromJson(json.loads(last["groups"])) == groups
        and (last["day"].year, last["day"].month) == (day.year, day.month)
        and all(find_column(df, c) for df in (older, current) for c in by)
        and (seen is None or all(fold(spark, c) in seen for c in by))
    ):
        written = read_snapshot(spark, store.log_path(day), change_schema)
        store.write_groups(day, group_changes(written, older, by, store.spec))
        return groups, False
    store.write_groups(day, _whole_groups(current, groups))
    return groups, True


def _whole_groups(rows: DataFrame, groups: T.StructType) -> DataFrame:
    """Rows per group; a column that the day's dump lacks is null."""
    found = [find_column(rows, f.name) for f in groups.fields]
    parts = [F.lit(None).cast(f.dataType) if n is None else col(n) for n, f in zip(found, groups.fields)]
    of = F.struct(*[p.alias(f.name) for p, f in zip(parts, groups.fields)]).alias("of")
    return rows.groupBy(of).agg(F.count(F.lit(1)).alias("change"))


def _count(spark, store, day, dump, current, change_schema, last) -> dict[str, int | None]:
    # Read back from what was written: one narrow column, and exact even if tasks were
    # run twice, which counters kept during the write are not.
    written = read_snapshot(spark, store.log_path(day), change_schema)
    ops = {r[store.spec.op]: r["count"] for r in change_counts(written, store.spec).collect()}
    # A snapshot has one row per key, so what came and went tells how many there are now.
    before = 0 if last is None else last["snapshot_rows"]
    came = ops.get(INSERT, 0) - ops.get(DELETE, 0)
    return {
        "dump_rows": None,
        "malformed_rows": None,
        "null_keys": None,
        "duplicate_keys": None,
        "snapshot_rows": current.count() if before is None else before + came,
        "inserted": ops.get(INSERT, 0),
        "updated": ops.get(UPDATE, 0),
        "deleted": ops.get(DELETE, 0),
    }


def _quality(
    store: DumpStore, dump: DataFrame, kept: int, seen: dict[str, int] | None, cleaning: Observation | None
) -> dict[str, int]:
    """Figures of the dump as given. Its keys are counted only if some were dropped as repeated, unseen by the cleaning."""
    if seen is None:
        # A pass over the key columns that moves no rows.
        seen = dump.agg(*_figures(store, dump)).first().asDict()
    if seen["dump_rows"] - seen["null_keys"] <= kept:
        return seen | {"duplicate_keys": 0}
    found = {} if cleaning is None else cleaning.get
    if found.get("keys") == kept:
        return seen | {"duplicate_keys": found["duplicate_keys"]}
    return seen | {"duplicate_keys": duplicate_keys(dump, store.spec).count()}


def _counts_of(commit) -> dict[str, int | None]:
    given = commit.asDict()
    return {k: v for k, v in given.items() if k in COUNTS}
