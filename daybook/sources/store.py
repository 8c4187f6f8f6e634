"""Where the daily job keeps a table: change log, snapshots, and which days count.

    <root>/log/day=YYYY-MM-DD/         that day's I, U and D rows
    <root>/snapshots/day=YYYY-MM-DD/   the cleaned dump of that day
    <root>/commits/day=YYYY-MM-DD/     one row, written last
    <root>/digests/day=YYYY-MM-DD/     each row's key and digest, if the store keeps them
    <root>/groups/day=YYYY-MM-DD/      rows per group, or by how many they changed, if the store keeps them
    <root>/touched/day=YYYY-MM-DD/     keys that changed, while their day is integrated
    <root>/gathered/                   a log's small files, while they are put together
    <root>/staged/day=YYYY-MM-DD/      a CSV dump as parsed, while its day is integrated
    <root>/months/month=YYYY-MM-01/    a closed month's newest log row of each key, if folded
    <root>/folds/month=YYYY-MM-01/     one row, written when that is complete
    <root>/relog/day=YYYY-MM-DD/<late>/     that day's log since the day ``<late>``, which was put in late
    <root>/regroups/day=YYYY-MM-DD/<late>/  and its groups, whole
    <root>/claims/                     a file of the run at work

Readers only see days that have a commit. Whatever a run left behind before it
failed is invisible and replaced when the day is run again.
"""

from __future__ import annotations

import json
import uuid
from contextlib import AbstractContextManager
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.errors import NoSnapshotError
from daybook.functions.days import parse_day
from daybook.functions.names import col, cols, fold, require_columns
from daybook.sources.buckets import bucket_of, digests_by_bucket, keeps_buckets, read_bucketed, write_bucketed
from daybook.sources.claims import Claim, claimed
from daybook.sources.tables import (
    empty_frame,
    log_schema,
    read_parquet_if_any,
    read_snapshot,
    write_snapshot,
)
from daybook.spec import TableSpec

COUNTS = (
    "dump_rows",
    "malformed_rows",
    "null_keys",
    "duplicate_keys",
    "snapshot_rows",
    "inserted",
    "updated",
    "deleted",
)
#: A day's log in files smaller than this, on average, is put together into files of about the second size.
SMALL_FILE_BYTES = 2 << 20
FULL_FILE_BYTES = 32 << 20
_COMMIT_FIELDS = T.StructType(
    [T.StructField("snapshot_schema", T.StringType()), T.StructField("log_columns", T.StringType())]
    + [T.StructField("buckets", T.IntegerType()), T.StructField("bucket_digests", T.StringType())]
    + [T.StructField("groups", T.StringType()), T.StructField("groups_whole", T.BooleanType())]
    + [T.StructField(c, T.LongType()) for c in COUNTS]
)
#: What the record of a day that was put in late says of the day after it.
_NEXT_FIELDS = [
    T.StructField("next_day", T.DateType()),
    *[T.StructField(f"next_{c}", T.LongType()) for c in ("inserted", "updated", "deleted")],
    T.StructField("next_groups", T.BooleanType()),
]
_FOLD_SCHEMA = T.StructType([T.StructField("rows", T.LongType()), T.StructField("month", T.DateType())])
COMMIT_SCHEMA = T.StructType([*_COMMIT_FIELDS.fields, T.StructField("day", T.DateType())])
_RECORD_FIELDS = T.StructType([*_COMMIT_FIELDS.fields, *_NEXT_FIELDS])
_RECORD_SCHEMA = T.StructType([*_RECORD_FIELDS.fields, T.StructField("day", T.DateType())])


@dataclass(frozen=True)
class DumpStore:
    """A root directory on any file system Spark can reach, and the table's spec.

    ``buckets`` lays snapshots out by key in that many buckets, which saves the
    daily comparison its shuffles. Choose it so that a bucket is a task's worth of
    data, and ``spark.sql.shuffle.partitions`` as a multiple of it. It may change
    from one day to the next; that day's comparison shuffles one side.

    ``bucket_digests`` keeps each bucket's row count and a digest of its rows with the
    day's record; buckets that are the same on both days are not read to compare them.
    The digests take a pass over each new snapshot, so they are for tables of which most
    buckets stay as they are from day to day.

    ``row_digests`` keeps a digest of each row beside the snapshots of a store without
    buckets: the daily comparison then moves keys and digests, and whole rows only of keys
    that changed. It is for tables of which few rows change from day to day.

    ``report_by`` names columns by which rows are counted each day, so that a report reads
    counts and no snapshot. A day keeps by how much groups changed, the first day of a
    month whole counts.

    ``clustered`` lays snapshots and each day of the log out in ranges of the key, sorted, so
    that a look at some keys (``stored_snapshot_as_of(keys=...)``) reads the files and row
    groups that may hold them. It costs one more shuffle of each snapshot.

    Runs claim the store, one at a time; a claim that was not renewed for
    ``stale_claim_seconds`` is a dead run's.

    ``anchors`` keeps the first snapshot of each ``"month"`` or ``"year"`` for good, so
    that rebuilding an old day replays no more of the log than that; by default only
    the newest snapshots are kept, and an older day replays the log from its start.
    """

    root: str
    spec: TableSpec
    buckets: int | None = None
    anchors: str | None = None
    bucket_digests: bool = False
    row_digests: bool = False
    report_by: tuple[str, ...] = ()
    clustered: bool = False
    stale_claim_seconds: float = 600

    def __post_init__(self) -> None:
        names = (self.report_by,) if isinstance(self.report_by, str) else tuple(self.report_by)
        object.__setattr__(self, "report_by", names)
        if self.bucket_digests and self.buckets is None:
            raise ValueError("only a bucketed store has bucket digests")
        if self.row_digests and self.buckets is not None:
            raise ValueError("a bucketed store moves no rows to compare them and needs no row digests")
        if self.clustered and self.buckets is not None:
            raise ValueError("a store is laid out in buckets or in ranges of the key, not both")
        if self.anchors not in (None, "month", "year"):
            raise ValueError(f"anchors are kept by 'month' or 'year', not {self.anchors!r}")

    def _path(self, kind: str, day: date | None = None) -> str:
        base = f"{self.root.rstrip('/')}/{kind}"
        # The log's directories bear the name of the log's own day column.
        name = self.spec.day if kind == "log" else "day"
        return base if day is None else f"{base}/{name}={day.isoformat()}"

    def log_path(self, day: date, late: date | None = None) -> str:
        """A day's log, or the one it has since the day before it, ``late``, was put in."""
        return self._path("log", day) if late is None else self._relog_path(day, late)

    def _relog_path(self, day: date, late: date) -> str:
        # The late day is no partition: its name could be one of the table's columns.
        return f"{self._path('relog')}/{self.spec.day}={day.isoformat()}/{late.isoformat()}"

    def _regroups_path(self, day: date, late: date) -> str:
        return f"{self._path('regroups')}/day={day.isoformat()}/{late.isoformat()}"

    def snapshot_path(self, day: date) -> str:
        return self._path("snapshots", day)

    def digests_path(self, day: date) -> str:
        return self._path("digests", day)

    def staged_path(self, day: date) -> str:
        return self._path("staged", day)

    def claimed(self, spark: SparkSession) -> AbstractContextManager[Claim]:
        """The claim that a run holds while it integrates a day."""
        return claimed(spark, self._path("claims"), self.stale_claim_seconds)

    # -- commits ---------------------------------------------------------

    def _records(self, spark: SparkSession) -> DataFrame:
        found = read_parquet_if_any(spark, self._path("commits"), _RECORD_SCHEMA)
        return empty_frame(spark, _RECORD_SCHEMA) if found is None else found

    def commits(self, spark: SparkSession) -> DataFrame:
        """One row per integrated day with its figures."""
        records = self._records(spark)
        if not self._any_late(spark):
            return records.select(*COMMIT_SCHEMA.names)
        # A late day's record is the only one written for it, so it speaks for the next day, too.
        again = F.max_by(F.struct(*[f.name for f in _NEXT_FIELDS]), "day").alias("again")
        late = records.where("next_day IS NOT NULL").groupBy(F.col("next_day").alias("day")).agg(again)
        own = {c: F.col(c) for c in COMMIT_SCHEMA.names}
        for c in ("inserted", "updated", "deleted"):
            own[c] = F.when(F.col("again").isNotNull(), F.col(f"again.next_{c}")).otherwise(F.col(c))
        own["groups_whole"] = F.when(F.col("again.next_groups"), True).otherwise(F.col("groups_whole"))
        return records.join(late, "day", "left").select(*[own[c].alias(c) for c in own])

    def _any_late(self, spark: SparkSession) -> bool:
        fs, root = self._file_system(spark, self._path("relog"))
        return fs.exists(root)

    def late_before(self, spark: SparkSession) -> dict[date, Row]:
        """Of days whose log was written again: the record of the day last put in before each."""
        if not self._any_late(spark):
            return {}
        rows = self._records(spark).where("next_day IS NOT NULL").select("day", "next_day", "next_groups").collect()
        return {r["next_day"]: r for r in sorted(rows, key=lambda r: r["day"])}

    def next_commit(self, spark: SparkSession, day: date) -> Row | None:
        """The record of the first integrated day after ``day``."""
        return self.commits(spark).where(F.col("day") > F.lit(day)).orderBy("day").limit(1).first()

    def newest_commit(
        self, spark: SparkSession, until: date | None = None, among: list[date] | None = None
    ) -> Row | None:
        """The newest integrated day's record, if asked up to a day or among given days only."""
        if until is None and among is None and not self._any_late(spark):
            return self._last_commit(spark)
        commits = self.commits(spark)
        if until is not None:
            commits = commits.where(F.col("day") <= F.lit(until))
        if among is not None:
            commits = commits.where(F.col("day").isin(among))
        return commits.orderBy(F.col("day").desc()).limit(1).first()

    def _last_commit(self, spark: SparkSession) -> Row | None:
        """The newest record by the names of their directories; opens as few of them as it can."""
        fs, root = self._file_system(spark, self._path("commits"))
        if not fs.exists(root):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        for day in sorted((parse_day(n.removeprefix("day=")) for n in names if n.startswith("day=")), reverse=True):
            # A run that died while it wrote its record leaves a directory without one.
            found = self.commit_of(spark, day)
            if found is not None:
                return found
        return None

    def commit_of(self, spark: SparkSession, day: date) -> Row | None:
        found = read_parquet_if_any(spark, self._path("commits", day), _RECORD_FIELDS)
        return None if found is None else found.withColumn("day", F.lit(day)).limit(1).first()

    def columns_last_absent(self, spark: SparkSession, commit: Row) -> dict[str, date]:
        """Of a commit's columns those that had gone and come back by then, with the last day without them."""
        past = self.commits(spark).where(F.col("day") <= F.lit(commit["day"]))
        # One row per set of columns that dumps ever had.
        spans = past.groupBy("snapshot_schema").agg(F.min("day").alias("first"), F.max("day").alias("last"))
        seen = [({fold(spark, n) for n in schema_of(r).names}, r["first"], r["last"]) for r in spans.collect()]
        absent = {}
        for name in schema_of(commit).names:
            key = fold(spark, name)
            without = max((last for names, _, last in seen if key not in names), default=None)
            since = min(first for names, first, _ in seen if key in names)
            if without is not None and without > since:
                absent[name] = without
        return absent

    def write_commit(
        self,
        spark: SparkSession,
        day: date,
        snapshot_schema: T.StructType,
        log_columns: T.StructType,
        counts: dict[str, int | None],
        digests: dict[int, str] | None = None,
        groups: T.StructType | None = None,
        groups_whole: bool | None = None,
        following: dict[str, object] | None = None,
    ) -> None:
        """The record that makes a day visible. ``following`` is what changes of the day after a late one."""
        values = dict.fromkeys(f.name for f in _NEXT_FIELDS) | {
            "snapshot_schema": snapshot_schema.json(),
            "log_columns": log_columns.json(),
            "buckets": self.buckets,
            "bucket_digests": None if digests is None else json.dumps(digests),
            "groups": None if groups is None else groups.json(),
            "groups_whole": groups_whole,
            **counts,
            **(following or {}),
        }
        one = spark.range(0, 1, 1, 1).select(
            *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in _RECORD_FIELDS.fields]
        )
        one.write.mode("overwrite").parquet(self._path("commits", day))

    # -- data ------------------------------------------------------------

    def write_snapshot(
        self, df: DataFrame, day: date, *, num_files: int | None, max_rows_per_file: int | None
    ) -> None:
        """Store a day's cleaned dump. Only ever called for a day without a commit."""
        path = self.snapshot_path(day)
        if self.buckets is None:
            df, num_files = self._laid_out(df, num_files)
            write_snapshot(df, path, num_files=num_files, max_rows_per_file=max_rows_per_file)
            return
        if num_files is not None:
            raise ValueError("a bucketed store sets the number of files itself")
        keys = require_columns(df, self.spec.keys, "the dump")
        self._delete(df.sparkSession, path)
        write_bucketed(df, path, keys, self.buckets, max_rows_per_file=max_rows_per_file)

    def writes_as_is(self, spark: SparkSession, num_files: int | None) -> bool:
        """Whether a cleaned dump's tasks write its snapshot themselves, nothing moving in between."""
        if self.buckets is not None:
            return keeps_buckets(spark, self.buckets)
        return num_files is None and not self.clustered

    def write_log(
        self,
        changes: DataFrame,
        day: date,
        *,
        num_files: int | None,
        max_rows_per_file: int | None,
        late: date | None = None,
        gathered: bool = False,
    ) -> None:
        """Store a day's changes. Only ever called for a day without a commit, or since a ``late`` one without.

        Written as the day's directory, so that a day without changes replaces, too,
        whatever a failed run may have left there. ``gathered=True`` is for changes that
        may be few in many partitions: small files are then put together.
        """
        path = self.log_path(day, late)
        laid_out, num_files = self._laid_out(changes, num_files)
        if gathered and num_files is None and not self.clustered:
            self._write_gathered(laid_out, path, max_rows_per_file)
            return
        write_snapshot(laid_out, path, num_files=num_files, max_rows_per_file=max_rows_per_file)

    def _write_gathered(self, rows: DataFrame, path: str, max_rows_per_file: int | None) -> None:
        """Write rows beside their place; bring them there as few full files if they are in small ones, else as they are.

        Nothing is shuffled, and only small files are written twice.
        """
        spark, aside = rows.sparkSession, f"{self._path('gathered')}/{uuid.uuid4().hex}"
        write_snapshot(rows, aside, max_rows_per_file=max_rows_per_file)
        fs, written = self._file_system(spark, aside)
        sizes = [s.getLen() for s in fs.listStatus(written) if s.getPath().getName().endswith(".parquet")]
        if len(sizes) >= 2 and sum(sizes) < SMALL_FILE_BYTES * len(sizes):
            few = -(-sum(sizes) // FULL_FILE_BYTES)
            again = read_snapshot(spark, aside, rows.schema).coalesce(few)
            write_snapshot(again, path, max_rows_per_file=max_rows_per_file)
            return
        self._delete(spark, path)
        _, place = self._file_system(spark, path)
        fs.mkdirs(place.getParent())
        if not fs.rename(written, place):
            raise OSError(f"{aside} could not be renamed to {path}")

    def _laid_out(self, df: DataFrame, num_files: int | None) -> tuple[DataFrame, int | None]:
        """In ranges of the key if the store is clustered, and the number of files still to be seen to."""
        if not self.clustered:
            return df, num_files
        keys = cols(require_columns(df, self.spec.keys, "the rows"))
        ranges = df.repartitionByRange(*keys) if num_files is None else df.repartitionByRange(num_files, *keys)
        return ranges.sortWithinPartitions(*keys), None

    def snapshot_by_key(
        self, spark: SparkSession, day: date, schema: T.StructType, buckets: int | None
    ) -> DataFrame:
        """A stored snapshot for joining on its key, in its buckets if it has any."""
        plain = read_snapshot(spark, self.snapshot_path(day), schema)
        if buckets is None:
            return plain
        keys = require_columns(plain, self.spec.keys, "the snapshot")
        return read_bucketed(spark, self.snapshot_path(day), schema, keys, buckets)

    def digests_of(self, spark: SparkSession, day: date, schema: T.StructType) -> dict[int, str] | None:
        """Each bucket's rows and order-free digest; None if the store keeps none or the types allow none."""
        if not self.bucket_digests:
            return None
        return digests_by_bucket(read_snapshot(spark, self.snapshot_path(day), schema))

    def pair_of_snapshots(
        self, spark: SparkSession, last: Row, day: date, schema: T.StructType, digests: dict[int, str] | None
    ) -> tuple[DataFrame, DataFrame]:
        """The last committed snapshot and the one of ``day``, without buckets that are surely the same.

        Few buckets are read by their files and shuffled; if most differ, both snapshots
        are read whole, in their buckets.
        """
        known = last["bucket_digests"]
        if digests is not None and known is not None and last["buckets"] == self.buckets and schema_of(last) == schema:
            before = {int(b): d for b, d in json.loads(known).items()}
            differ = {b for b in before.keys() | digests.keys() if before.get(b) != digests.get(b)}
            if 2 * len(differ) <= self.buckets:
                return tuple(self._some_buckets(spark, d, schema, differ) for d in (last["day"], day))
        return (
            self.snapshot_by_key(spark, last["day"], schema_of(last), last["buckets"]),
            self.snapshot_by_key(spark, day, schema, self.buckets),
        )

    def write_row_digests(self, day: date, digests: DataFrame | None, spark: SparkSession) -> DataFrame | None:
        """Store a day's row digests, or make sure that a run before has left none."""
        if digests is None:
            self._delete(spark, self.digests_path(day))
            return None
        write_snapshot(digests, self.digests_path(day))
        return read_snapshot(spark, self.digests_path(day), digests.schema)

    def write_touched(self, day: date, keys: DataFrame, spark: SparkSession) -> DataFrame:
        """Set down a day's changed keys until the day is done."""
        path = self._path("touched", day)
        write_snapshot(keys, path)
        return read_snapshot(spark, path, keys.schema)

    def read_row_digests(self, spark: SparkSession, day: date, schema: T.StructType) -> DataFrame | None:
        """A committed day's row digests, if it has any."""
        return read_parquet_if_any(spark, self.digests_path(day), schema)

    def write_groups(self, day: date, counts: DataFrame, late: date | None = None) -> None:
        """Store a day's groups (``of``) and their count or by how much it changed (``change``)."""
        write_snapshot(counts, self._path("groups", day) if late is None else self._regroups_path(day, late))

    def group_counts(self, spark: SparkSession, commit: Row) -> DataFrame:
        """Groups (``of``) and by how much they changed up to a committed day (``change``), to be added up."""
        if commit["groups"] is None:
            raise ValueError(f"no groups were counted on {commit['day']}; name them in report_by")
        groups = T.StructType.fromJson(json.loads(commit["groups"]))
        # Each month starts from whole counts, so no more than its days are looked through.
        day = F.col("day")
        month = self.commits(spark).where(day.between(F.lit(commit["day"].replace(day=1)), F.lit(commit["day"])))
        days = {r["day"]: r["groups_whole"] for r in month.select("day", "groups_whole").collect()}
        since = max(d for d, whole in days.items() if whole)
        again = {d: r["day"] for d, r in self.late_before(spark).items() if r["next_groups"]}
        paths = [
            self._regroups_path(d, again[d]) if d in again else self._path("groups", d)
            for d in sorted(days)
            if d >= since
        ]
        schema = T.StructType([T.StructField("of", groups), T.StructField("change", T.LongType())])
        return spark.read.schema(schema).parquet(*paths)

    def _some_buckets(self, spark: SparkSession, day: date, schema: T.StructType, buckets: set[int]) -> DataFrame:
        fs, root = self._file_system(spark, self.snapshot_path(day))
        paths = [s.getPath().toString() for s in fs.listStatus(root)]
        wanted = [p for p in paths if bucket_of(p) in buckets]
        return spark.read.schema(schema).parquet(*wanted) if wanted else empty_frame(spark, schema)

    def read_committed_snapshot(self, spark: SparkSession, commit: Row) -> DataFrame:
        return read_snapshot(spark, self.snapshot_path(commit["day"]), schema_of(commit))

    def latest_snapshot(self, spark: SparkSession) -> DataFrame:
        """The dump of the newest integrated day."""
        commit = self.newest_commit(spark)
        if commit is None:
            raise NoSnapshotError(f"no day has been integrated under {self.root}")
        return self.read_committed_snapshot(spark, commit)

    def change_log(self, spark: SparkSession, until: str | date | None = None) -> DataFrame:
        """Log rows of the integrated days up to ``until``, under the newest such day's columns."""
        until = None if until is None else parse_day(until)
        commit = self.newest_commit(spark, until)
        if commit is None:
            raise NoSnapshotError(f"no day has been integrated under {self.root} up to {until}")
        full = log_schema(log_columns_of(commit), self.spec)
        log = spark.read.schema(full).parquet(self._path("log"))
        day = self.spec.day
        again = {d: r["day"] for d, r in self.late_before(spark).items() if d <= commit["day"]}
        if again:
            # One day per day that was ever put in late.
            paths = [self._relog_path(d, late) for d, late in sorted(again.items())]
            since_late = spark.read.schema(full).option("basePath", self._path("relog")).parquet(*paths)
            log = log.where(~col(day).isin(list(again))).unionByName(since_late)
        log = log.where(col(day) <= F.lit(commit["day"]))
        # One DATE per calendar day ever integrated: some hundred rows a year.
        days = self._records(spark).select(F.col("day").alias(day))
        return log.join(F.broadcast(days), day, "left_semi").select(*[col(c) for c in full.names])

    def folds(self, spark: SparkSession) -> list[date]:
        """First days of the months whose log is folded, ascending."""
        found = read_parquet_if_any(spark, self._path("folds"), _FOLD_SCHEMA)
        return [] if found is None else sorted(r["month"] for r in found.select("month").collect())

    def drop_folds(self, spark: SparkSession, days: list[date]) -> None:
        """Folded months of these days are no more; the daily log is read until they are folded again."""
        for month in sorted({d.replace(day=1) for d in days}):
            self._delete(spark, f"{self._path('folds')}/month={month.isoformat()}")

    def write_fold(self, spark: SparkSession, month: date, rows: DataFrame) -> None:
        path = f"{self._path('months')}/month={month.isoformat()}"
        laid_out, _ = self._laid_out(rows, None)
        write_snapshot(laid_out, path)
        n = read_snapshot(spark, path, rows.schema).count()
        one = spark.range(0, 1, 1, 1).select(F.lit(n).cast("long").alias("rows"))
        one.write.mode("overwrite").parquet(f"{self._path('folds')}/month={month.isoformat()}")

    def log_to_replay(self, spark: SparkSession, until: date, since: date | None = None) -> DataFrame:
        """The log after ``since`` up to ``until``, whole months in their folded form where there is one.

        Good for a replay to ``until`` only: what happened within such a month is gone.
        """
        log = self.change_log(spark, until)
        day = col(self.spec.day)
        if since is not None:
            log = log.where(day > F.lit(since))
        months = [m for m in self.folds(spark) if month_end(m) <= until and (since is None or m > since)]
        if not months:
            return log
        for m in months:
            log = log.where(~day.between(F.lit(m), F.lit(month_end(m))))
        paths = [f"{self._path('months')}/month={m.isoformat()}" for m in months]
        return log.unionByName(spark.read.schema(log.schema).parquet(*paths))

    # -- housekeeping ----------------------------------------------------

    def kept_snapshots(self, spark: SparkSession) -> list[date]:
        """Days whose snapshot directory is still there, committed or not, ascending."""
        fs, root = self._file_system(spark, self._path("snapshots"))
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(parse_day(n.removeprefix("day=")) for n in names if n.startswith("day="))

    def expire_snapshots(self, spark: SparkSession, keep: int) -> list[date]:
        """Delete all but the ``keep`` newest committed snapshots; returns the days deleted.

        The log still rebuilds every day. What a run left that died before its commit
        goes too, snapshot and log, once a later day is committed. Anchors stay.
        """
        if keep < 1:
            raise ValueError("at least the newest snapshot must be kept")
        stored = self.kept_snapshots(spark)
        committed = self.commits(spark).where(F.col("day").isin(stored)).select("day")
        days = sorted(r["day"] for r in committed.collect())
        dead = [d for d in stored if d not in days and days and d < days[-1]]
        anchors: dict[tuple[int, ...], date] = {}
        if self.anchors is not None:
            for day in days:
                anchors.setdefault((day.year, day.month) if self.anchors == "month" else (day.year,), day)
        old = [d for d in days[:-keep] if d not in anchors.values()]
        for day in dead:
            self._delete(spark, self.log_path(day))
            self._delete(spark, self._path("groups", day))
            for kind in ("relog", "regroups"):
                self._delete_each(spark, f"{self._path(kind)}/*/{day.isoformat()}")
        for day in old + dead:
            self._delete(spark, self.snapshot_path(day))
            self._delete(spark, self.digests_path(day))
        return sorted(old + dead)

    def drop_staged(self, spark: SparkSession) -> None:
        """Remove dumps, keys and copies that were set down on the way, a dead run's as well."""
        for kind in ("staged", "touched", "gathered"):
            self._delete(spark, self._path(kind))

    def _delete(self, spark: SparkSession, path: str) -> None:
        fs, target = self._file_system(spark, path)
        fs.delete(target, True)

    def _delete_each(self, spark: SparkSession, pattern: str) -> None:
        fs, target = self._file_system(spark, pattern)
        for found in fs.globStatus(target) or []:
            fs.delete(found.getPath(), True)

    @staticmethod
    def _file_system(spark: SparkSession, path: str):
        # The same resolver Spark's readers use, so any scheme works alike.
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def month_end(day: date) -> date:
    return (day.replace(day=1) + timedelta(31)).replace(day=1) - timedelta(1)


def schema_of(commit: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit["snapshot_schema"]))


def log_columns_of(commit: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit["log_columns"]))
