"""

Every query reads its tables whole. Two dumps of one table are derived from it
by re-keying and editing rows according to their own attributes; the day limits
are the operators' own parameters (the day to rebuild, the day to slice).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import TableSpec
from daybook import operators as ops
from daybook import plans, sources
from daybook.sources.scratch import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

# The subpackage for training data and its pipeline may have been left out.
_LLM_QUERIES: dict[str, Query] = {}
_LLM_SQL: dict[str, str] = {}
try:
    import corpus_pipeline
    from daybook.llm import queries as llm_queries
except ImportError:  # theirs, or a package that only they need
    pass
else:
    _LLM_QUERIES = llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    _LLM_SQL = dict(llm_queries.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        _LLM_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


# -- inputs ----------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ORDER = TableSpec("o_orderkey")
LINE = TableSpec(("l_orderkey", "l_linenumber"))
CUSTOMER_LOG = TableSpec("o_custkey")
ITEM = TableSpec("k")


def _is(name: str, value: str) -> Column:
    return F.col(name) == value


def _order_dumps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders, then all orders with finished ones re-keyed and pending ones edited."""
    orders = _table(spark, sf_dir, "orders")
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
    old = orders.withColumn("o_orderpriority", priority).select(*columns)
    new = (
        orders.withColumn(
            "o_orderkey",
            F.when(_is("o_orderstatus", "F"), -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey")),
        )
        .withColumn("o_orderpriority", F.when(~_is("o_orderstatus", "P"), priority))
        .select(*columns)
    )
    return old, new


ORDER_DUMPS = """
old AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus,
               NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority
        FROM orders),
new AS (SELECT CASE WHEN o_orderstatus = 'F' THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey,
               o_custkey, o_totalprice, o_orderstatus,
               CASE WHEN o_orderstatus <> 'P' THEN NULLIF(o_orderpriority, '5-LOW') END AS o_orderpriority
        FROM orders)"""

ORDER_INSERTED = """SELECT new.*, 'I' AS op FROM new
WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.o_orderkey = new.o_orderkey)"""
ORDER_DELETED = """SELECT old.*, 'D' AS op FROM old
WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.o_orderkey = old.o_orderkey)"""
ORDER_UPDATED = """SELECT new.*, 'U' AS op FROM old JOIN new ON old.o_orderkey = new.o_orderkey
WHERE old.o_custkey IS DISTINCT FROM new.o_custkey
   OR old.o_totalprice IS DISTINCT FROM new.o_totalprice
   OR old.o_orderstatus IS DISTINCT FROM new.o_orderstatus
   OR old.o_orderpriority IS DISTINCT FROM new.o_orderpriority"""
ORDER_CHANGES = f"""{ORDER_INSERTED}
UNION ALL {ORDER_UPDATED}
UNION ALL {ORDER_DELETED}"""


def _line_dumps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All lines twice, with repeated keys as they are and null keys on both sides."""
    lines = _table(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"]
    keyless = _is("l_returnflag", "A") & _is("l_linestatus", "O")
    old = lines.withColumn("l_linenumber", F.when(~keyless, F.col("l_linenumber"))).select(*columns)
    moved = _is("l_returnflag", "N") & _is("l_linestatus", "O")
    new = (
        lines.withColumn("l_linenumber", F.when(~keyless, F.col("l_linenumber")))
        .withColumn("l_orderkey", F.when(moved, -1 - F.col("l_orderkey")).otherwise(F.col("l_orderkey")))
        .withColumn("l_quantity", F.when(~_is("l_returnflag", "R"), F.col("l_quantity")))
        .select(*columns)
    )
    return old, new


_LINE_NUMBER = "CASE WHEN NOT (l_returnflag = 'A' AND l_linestatus = 'O') THEN l_linenumber END AS l_linenumber"
LINE_DUMPS = f"""
old AS (SELECT l_orderkey, {_LINE_NUMBER}, l_partkey, l_quantity, l_returnflag FROM lineitem),
new AS (SELECT CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN -1 - l_orderkey
                    ELSE l_orderkey END AS l_orderkey,
               {_LINE_NUMBER}, l_partkey,
               CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS l_quantity, l_returnflag
        FROM lineitem)"""


def _line_changes(old: str, new: str) -> str:
    same_key = f"{old}.l_orderkey = {new}.l_orderkey AND {old}.l_linenumber = {new}.l_linenumber"
    return f"""SELECT {new}.*, 'I' AS op FROM {new} WHERE NOT EXISTS (SELECT 1 FROM {old} WHERE {same_key})
UNION ALL SELECT {new}.*, 'U' AS op FROM {old} JOIN {new} ON {same_key}
WHERE {old}.l_partkey IS DISTINCT FROM {new}.l_partkey
   OR {old}.l_quantity IS DISTINCT FROM {new}.l_quantity
   OR {old}.l_returnflag IS DISTINCT FROM {new}.l_returnflag
UNION ALL SELECT {old}.*, 'D' AS op FROM {old} WHERE NOT EXISTS (SELECT 1 FROM {new} WHERE {same_key})"""


def _cleaned(source: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_partkey NULLS FIRST, l_quantity NULLS FIRST, l_returnflag NULLS FIRST) AS nth
      FROM {source} WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) AS numbered
WHERE nth = 1"""


def _order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a change log of their customers; a customer may repeat within a day."""
    op = F.when(_is("o_orderstatus", "O"), "I").when(_is("o_orderstatus", "P"), "U").otherwise("D")
    return _table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", op.alias("op"), F.to_date("o_orderdate").alias("day")
    )


def _order_log_with_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    op = F.when(_is("o_orderstatus", "O"), "I").when(_is("o_orderstatus", "P"), "U").otherwise("D")
    return orders.select(
        F.when(~_is("o_orderpriority", "1-URGENT"), F.col("o_custkey")).alias("o_custkey"),
        "o_orderkey",
        "o_totalprice",
        op.alias("op"),
        F.to_date("o_orderdate").alias("day"),
    )


_LOG_OP = "CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'P' THEN 'U' ELSE 'D' END AS op"
ORDER_LOG = f"""
log AS (SELECT o_custkey, o_orderkey, o_totalprice, {_LOG_OP}, CAST(o_orderdate AS DATE) AS day FROM orders)"""
NULL_KEY_LOG = f"""
log AS (SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS o_custkey,
               o_orderkey, o_totalprice, {_LOG_OP}, CAST(o_orderdate AS DATE) AS day FROM orders)"""
AS_OF = "1998-06-30"
BASE_DAY = "1997-06-30"
QUARTERS = [f"{y}-{d}" for y in (1996, 1997) for d in ("03-31", "06-30", "09-30", "12-31")]
SNAPSHOT_AS_OF = f"""SELECT o_custkey, o_orderkey, o_totalprice
FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY day DESC) AS rk
      FROM log WHERE day <= DATE '{AS_OF}') AS ranked
WHERE rk = 1 AND op IN ('I', 'U')"""


def _monthly_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_log(spark, sf_dir).withColumn("day", F.last_day("day"))


# -- snapshot comparison -----------------------------------------------------


def change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.change_set(*_order_dumps(spark, sf_dir), ORDER, keys_unique=True)


def change_set_by_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.change_set(*_order_dumps(spark, sf_dir), ORDER)


def change_set_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.change_set(*_line_dumps(spark, sf_dir), LINE)


def change_set_repeated_keys_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _line_dumps(spark, sf_dir)
    repeated = [ops.duplicate_keys(side, LINE).select(*LINE.keys) for side in (old, new)]
    return ops.change_set(old, new, LINE, repeated_keys=ops.align_union(*repeated).distinct())


def change_set_column_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _order_dumps(spark, sf_dir)
    return ops.change_set(old.drop("o_orderpriority"), new.drop("o_totalprice"), ORDER)


def change_set_compared_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec(LINE.keys, compared=("l_quantity",))
    return ops.change_set(*_line_dumps(spark, sf_dir), spec)


def change_set_first_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, new = _order_dumps(spark, sf_dir)
    return ops.change_set(sources.empty_frame(spark, new.schema), new, ORDER, keys_unique=True)


def inserted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.inserted(*_order_dumps(spark, sf_dir), ORDER)


def deleted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.deleted(*_order_dumps(spark, sf_dir), ORDER)


def updated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.updated(*_order_dumps(spark, sf_dir), ORDER)


def change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.change_counts(_order_log(spark, sf_dir), CUSTOMER_LOG, per_day=True)


def change_counts_of_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.change_counts(change_set(spark, sf_dir), ORDER)


def preview_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.preview(change_set(spark, sf_dir), 50, by=["o_orderkey"])


def diff_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark)
    old, new = _line_dumps(spark, sf_dir)
    sources.write_snapshot(old, f"{root}/old")
    sources.write_snapshot(new, f"{root}/new")
    return plans.diff_snapshots(spark, f"{root}/old", f"{root}/new", LINE, output=f"{root}/changes")


# -- replay --------------------------------------------------------------------


def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.snapshot_as_of(_order_log(spark, sf_dir), AS_OF, CUSTOMER_LOG)


def snapshot_as_of_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.snapshot_as_of(_order_log(spark, sf_dir), AS_OF, CUSTOMER_LOG, unique_per_day=True)


def snapshot_as_of_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.snapshot_as_of(_order_log_with_null_keys(spark, sf_dir), AS_OF, CUSTOMER_LOG)


def snapshots_as_of_many_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day of every quarter of two years, in one plan."""
    return ops.snapshots_as_of(_order_log_with_null_keys(spark, sf_dir), QUARTERS, CUSTOMER_LOG)


def log_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.history(_order_log_with_null_keys(spark, sf_dir), CUSTOMER_LOG)


def snapshot_as_of_from_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _order_log_with_null_keys(spark, sf_dir)
    base = ops.snapshot_as_of(log, BASE_DAY, CUSTOMER_LOG)
    return ops.snapshot_as_of(log, AS_OF, CUSTOMER_LOG, base=base, base_day=BASE_DAY)


def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v")
    )
    # Returned lines delete, accepted ones update, and N stands for an unknown operation.
    op = F.when(_is("l_returnflag", "R"), "D").when(_is("l_returnflag", "A"), "U").otherwise("N")
    changes = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("v"), op.alias("op")
    )
    return ops.apply_changes(snapshot, changes, ITEM)


def log_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.log_days(_order_log(spark, sf_dir), CUSTOMER_LOG, until=AS_OF)


def log_day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.log_day(_order_log(spark, sf_dir), AS_OF, CUSTOMER_LOG)


def log_day_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.log_day(_order_log(spark, sf_dir), AS_OF, CUSTOMER_LOG, ops=("D",))


# -- dump quality ----------------------------------------------------------------


def null_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        F.when(~_is("lang", "en"), F.col("doc_id")).alias("k"), "source"
    )
    return ops.drop_null_keys(docs, ITEM)


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.duplicate_keys(_table(spark, sf_dir, "lineitem"), LINE)


def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dedupe_by_key(_table(spark, sf_dir, "lineitem"), LINE)


def clean_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, _ = _line_dumps(spark, sf_dir)
    return ops.clean_dump(old, LINE)


def key_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, _ = _line_dumps(spark, sf_dir)
    return ops.key_quality(old, LINE)


# -- reports and unions -------------------------------------------------------------


def group_count_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.group_count(_table(spark, sf_dir, "customer"), "c_mktsegment", 50)


def group_count_top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.group_count(_table(spark, sf_dir, "lineitem"), "l_suppkey", 50)


def group_count_by_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_word = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("first_word")
    brand = F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("brand")
    return ops.group_count(_table(spark, sf_dir, "part"), [first_word, brand], None)


def align_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    return ops.align_union(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality"))


# -- storage and jobs -----------------------------------------------------------------


def csv_dump_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer")
    path = f"{scratch_folder(spark)}/dump"
    customers.write.option("header", True).csv(path)
    return sources.read_csv_dump(spark, path, customers.schema)


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/snapshot"
    sources.write_snapshot(_table(spark, sf_dir, "part"), path, num_files=2)
    return sources.read_snapshot(spark, path)


def change_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/log"
    log = _monthly_log(spark, sf_dir)
    sources.write_change_log(log, path, CUSTOMER_LOG)
    return sources.read_change_log(spark, path, CUSTOMER_LOG, schema=log.schema)


DAYS = (date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 3))


def _integrated(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> sources.DumpStore:
    """Three days of dumps through the daily job: the old, the new, the old again."""
    root = scratch_folder(spark)
    store = sources.DumpStore(f"{root}/store", LINE, buckets)
    old, new = _line_dumps(spark, sf_dir)
    for name, dump in (("old", old), ("new", new)):
        dump.write.option("header", True).csv(f"{root}/{name}")
    for day, name in zip(DAYS, ("old", "new", "old")):
        plans.integrate_csv(spark, store, day, f"{root}/{name}", old.schema)
    return store


def integrate_then_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _integrated(spark, sf_dir)
    return plans.stored_snapshot_as_of(spark, store, DAYS[1], from_log_only=True)


def integrate_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _integrated(spark, sf_dir).latest_snapshot(spark)


def integrate_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _integrated(spark, sf_dir).change_log(spark)


def integrate_bucketed_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _integrated(spark, sf_dir, buckets=width).change_log(spark)


def integrate_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits = _integrated(spark, sf_dir).commits(spark)
    return commits.drop("snapshot_schema", "log_columns", "buckets", "bucket_digests", "groups", "groups_whole")


def change_set_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only keys and digests of all orders are moved, and the rows of those that changed."""
    old, new = _order_dumps(spark, sf_dir)
    touched = ops.touched_keys(ops.row_digests(old, ORDER), ops.row_digests(new, ORDER), ORDER)
    return ops.change_set_by_digests(old, new, ORDER, touched)


def integrate_row_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days of which the last two are compared by kept digests."""
    store = sources.DumpStore(f"{scratch_folder(spark)}/store", LINE, row_digests=True)
    old, new = _line_dumps(spark, sf_dir)
    for day, dump in zip(DAYS, (old, new, old)):
        plans.integrate_day(spark, store, day, dump)
    return store.change_log(spark)


def integrate_quiet_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dumps that differ in the lines of one order: the other buckets are not read to compare them."""
    store = sources.DumpStore(f"{scratch_folder(spark)}/store", LINE, buckets=32, bucket_digests=True)
    old, _ = _line_dumps(spark, sf_dir)
    edited = F.col("l_orderkey") == _table(spark, sf_dir, "lineitem").agg(F.min("l_orderkey")).scalar()
    new = old.withColumn("l_quantity", F.when(~edited, F.col("l_quantity")))
    for day, dump in zip(DAYS, (old, new)):
        plans.integrate_day(spark, store, day, dump)
    return store.change_log(spark)


def recompute_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _integrated(spark, sf_dir)
    output = f"{scratch_folder(spark)}/rebuilt"
    plans.recompute_snapshot(spark, store, DAYS[1], output)
    return sources.read_snapshot(spark, output)


def report_latest_all_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.report_latest(spark, _integrated(spark, sf_dir), "l_partkey")


def integrate_same_day_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day integrated before is skipped: the log stays as it was."""
    store = _integrated(spark, sf_dir)
    _, new = _line_dumps(spark, sf_dir)
    plans.integrate_day(spark, store, DAYS[2], new)
    return store.change_log(spark)


def integrate_other_day_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark)
    store = sources.DumpStore(f"{root}/store", TableSpec(LINE.keys, day="dt"))
    for day, dump in zip(DAYS, _line_dumps(spark, sf_dir)):
        plans.integrate_day(spark, store, day, dump)
    return store.change_log(spark)


def integrate_late_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of days one and three, and then day two, which was missed."""
    store = sources.DumpStore(f"{scratch_folder(spark)}/store", LINE)
    old, new = _line_dumps(spark, sf_dir)
    for day, dump in ((DAYS[0], old), (DAYS[2], old), (DAYS[1], new)):
        plans.integrate_day(spark, store, day, dump, late=True)
    return store.change_log(spark)


def integrate_columns_come_and_go(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quantity is missing on day two and back, in part null, on day three; the log alone rebuilds it."""
    store = sources.DumpStore(f"{scratch_folder(spark)}/store", LINE)
    old, new = _line_dumps(spark, sf_dir)
    for day, dump in zip(DAYS, (old, old.drop("l_quantity"), new)):
        plans.integrate_day(spark, store, day, dump)
    return plans.stored_snapshot_as_of(spark, store, DAYS[2], from_log_only=True)


def integrate_from_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day whose snapshot has expired, rebuilt from its month's first one."""
    store = sources.DumpStore(f"{scratch_folder(spark)}/store", LINE, anchors="month")
    old, new = _line_dumps(spark, sf_dir)
    for day, dump in ((DAYS[0], old), (DAYS[1], new), (date(2025, 2, 1), old)):
        plans.integrate_day(spark, store, day, dump, keep_snapshots=1)
    return plans.stored_snapshot_as_of(spark, store, DAYS[1])


def stamp_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.stamp_day(change_set(spark, sf_dir), AS_OF, ORDER)


def change_set_helper_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dumps whose columns are named like what operators add inside."""
    names = ["o_orderkey", "_here", "_n_old", "_key_hash", "_times"]
    old, new = (d.toDF(*names) for d in _order_dumps(spark, sf_dir))
    return ops.change_set(old, new, ORDER)


def report_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.report_latest(spark, _integrated(spark, sf_dir), "l_returnflag")


def recompute_some_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred largest lines as they were on day two, found by their keys in a clustered store."""
    store = sources.DumpStore(f"{scratch_folder(spark)}/store", LINE, clustered=True)
    old, new = _line_dumps(spark, sf_dir)
    for day, dump in zip(DAYS, (old, new, old)):
        plans.integrate_day(spark, store, day, dump)
    lines = _table(spark, sf_dir, "lineitem")
    keys = lines.orderBy(F.desc("l_quantity"), "l_orderkey", "l_linenumber").select(*LINE.keys).limit(100)
    wanted = [tuple(r) for r in keys.collect()]
    return plans.stored_snapshot_as_of(spark, store, DAYS[1], keys=wanted)


def recompute_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second month's day, rebuilt from the first month's folded log and its own day."""
    store = sources.DumpStore(f"{scratch_folder(spark)}/store", LINE)
    old, new = _line_dumps(spark, sf_dir)
    for day, dump in zip((DAYS[0], DAYS[1], date(2025, 2, 1)), (old, new, old)):
        plans.integrate_day(spark, store, day, dump)
    plans.fold_log(spark, store)
    return plans.stored_snapshot_as_of(spark, store, date(2025, 2, 1), from_log_only=True)


REPORT_DAYS = (*DAYS, date(2025, 2, 1))


def report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after each of four days, from kept counts; the fourth day starts a month."""
    store = sources.DumpStore(f"{scratch_folder(spark)}/store", LINE, report_by=("l_returnflag", "l_quantity"))
    old, new = _line_dumps(spark, sf_dir)
    for day, dump in zip(REPORT_DAYS, (old, new, old, new)):
        plans.integrate_day(spark, store, day, dump)
    reports = [
        plans.report_incremental(spark, store, day=day).withColumn("day", F.lit(day)) for day in REPORT_DAYS
    ]
    return reduce(DataFrame.unionByName, reports)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: what changed between two dumps of the orders table."""
    return change_set(spark, "/root/testdata/sf0.001")


_QUERIES: tuple[Query, ...] = (
    change_set,
    change_set_by_counts,
    change_set_repeated_keys,
    change_set_repeated_keys_apart,
    change_set_column_drift,
    change_set_compared_columns,
    change_set_first_day,
    inserted_rows,
    deleted_rows,
    updated_rows,
    change_counts,
    change_counts_of_pair,
    preview_changes,
    diff_snapshots,
    snapshot_as_of,
    snapshot_as_of_by_window,
    snapshot_as_of_null_keys,
    snapshot_as_of_from_base,
    snapshots_as_of_many_days,
    log_history,
    apply_changes,
    log_days,
    log_day_slice,
    log_day_deletes,
    null_key_filter,
    duplicate_keys,
    dedupe_by_key,
    clean_dump,
    key_quality,
    group_count_report,
    group_count_top_groups,
    group_count_by_expression,
    align_union,
    csv_dump_roundtrip,
    snapshot_roundtrip,
    change_log_roundtrip,
    integrate_then_as_of,
    integrate_latest_snapshot,
    integrate_change_log,
    integrate_bucketed_change_log,
    integrate_figures,
    integrate_quiet_buckets,
    integrate_row_digests,
    change_set_by_digests,
    recompute_snapshot,
    report_latest_all_groups,
    integrate_same_day_again,
    integrate_other_day_name,
    integrate_late_day,
    integrate_columns_come_and_go,
    integrate_from_anchor,
    stamp_day,
    change_set_helper_names,
    report_latest,
    report_incremental,
    recompute_some_keys,
    recompute_folded,
)


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    return {q.__name__: q for q in _QUERIES} | _LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB SQL over the same tables."""
    return _own_sql() | _LLM_SQL


def _own_sql() -> dict[str, str]:
    null_key_as_of = f"""WITH {NULL_KEY_LOG}
{SNAPSHOT_AS_OF} AND o_custkey IS NOT NULL
UNION ALL SELECT o_custkey, o_orderkey, o_totalprice FROM log
WHERE day <= DATE '{AS_OF}' AND o_custkey IS NULL AND op IN ('I', 'U')"""
    clean_days = f"""WITH {LINE_DUMPS},
first AS ({_cleaned("old")}),
second AS ({_cleaned("new")})"""
    three_days = f"""SELECT *, DATE '2025-01-01' AS day FROM (SELECT *, 'I' AS op FROM first) AS a
UNION ALL SELECT *, DATE '2025-01-02' AS day FROM ({_line_changes("first", "second")}) AS b
UNION ALL SELECT *, DATE '2025-01-03' AS day FROM ({_line_changes("second", "first")}) AS c"""
    return {
        "change_set": f"WITH {ORDER_DUMPS} {ORDER_CHANGES}",
        "change_set_by_counts": f"WITH {ORDER_DUMPS} {ORDER_CHANGES}",
        "change_set_repeated_keys": f"WITH {LINE_DUMPS} {_line_changes('old', 'new')}",
        "change_set_repeated_keys_apart": f"WITH {LINE_DUMPS} {_line_changes('old', 'new')}",
        "change_set_column_drift": f"""WITH {ORDER_DUMPS}
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(NULL AS DOUBLE) AS o_totalprice, 'I' AS op
FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.o_orderkey = new.o_orderkey)
UNION ALL
SELECT new.o_orderkey, new.o_custkey, new.o_orderstatus, new.o_orderpriority, NULL, 'U'
FROM old JOIN new ON old.o_orderkey = new.o_orderkey
WHERE old.o_custkey IS DISTINCT FROM new.o_custkey
   OR old.o_orderstatus IS DISTINCT FROM new.o_orderstatus
   OR new.o_orderpriority IS NOT NULL
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, NULL, o_totalprice, 'D'
FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.o_orderkey = old.o_orderkey)""",
        "change_set_compared_columns": f"""WITH {LINE_DUMPS}
SELECT new.*, 'I' AS op FROM new WHERE NOT EXISTS (SELECT 1 FROM old
    WHERE old.l_orderkey = new.l_orderkey AND old.l_linenumber = new.l_linenumber)
UNION ALL SELECT new.*, 'U' AS op FROM old JOIN new
    ON old.l_orderkey = new.l_orderkey AND old.l_linenumber = new.l_linenumber
    WHERE old.l_quantity IS DISTINCT FROM new.l_quantity
UNION ALL SELECT old.*, 'D' AS op FROM old WHERE NOT EXISTS (SELECT 1 FROM new
    WHERE old.l_orderkey = new.l_orderkey AND old.l_linenumber = new.l_linenumber)""",
        "change_set_first_day": f"WITH {ORDER_DUMPS} SELECT new.*, 'I' AS op FROM new",
        "inserted_rows": f"WITH {ORDER_DUMPS} {ORDER_INSERTED}",
        "deleted_rows": f"WITH {ORDER_DUMPS} {ORDER_DELETED}",
        "updated_rows": f"WITH {ORDER_DUMPS} {ORDER_UPDATED}",
        "change_counts": f"WITH {ORDER_LOG} SELECT day, op, count(*) AS count FROM log GROUP BY day, op",
        "change_counts_of_pair": f"""WITH {ORDER_DUMPS}
SELECT op, count(*) AS count FROM ({ORDER_CHANGES}) AS changes GROUP BY op""",
        "preview_changes": f"""WITH {ORDER_DUMPS}
SELECT * FROM ({ORDER_CHANGES}) AS changes ORDER BY o_orderkey LIMIT 50""",
        "diff_snapshots": f"WITH {LINE_DUMPS} {_line_changes('old', 'new')}",
        "snapshot_as_of": f"WITH {ORDER_LOG} {SNAPSHOT_AS_OF}",
        "snapshot_as_of_by_window": f"WITH {ORDER_LOG} {SNAPSHOT_AS_OF}",
        "snapshot_as_of_null_keys": null_key_as_of,
        "snapshot_as_of_from_base": null_key_as_of,
        "snapshots_as_of_many_days": f"""WITH {NULL_KEY_LOG},
asked AS (SELECT CAST(unnest({QUARTERS}) AS DATE) AS as_of),
newest AS (SELECT as_of, o_custkey, max(day) AS day FROM log JOIN asked ON day <= as_of
           WHERE o_custkey IS NOT NULL GROUP BY as_of, o_custkey)
SELECT log.o_custkey, o_orderkey, o_totalprice, as_of FROM log
JOIN newest ON log.o_custkey = newest.o_custkey AND log.day = newest.day WHERE op IN ('I', 'U')
UNION ALL SELECT o_custkey, o_orderkey, o_totalprice, as_of FROM log JOIN asked ON day <= as_of
WHERE o_custkey IS NULL AND op IN ('I', 'U')""",
        "log_history": f"""WITH {NULL_KEY_LOG},
days AS (SELECT o_custkey, day, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS until
         FROM (SELECT DISTINCT o_custkey, day FROM log WHERE o_custkey IS NOT NULL) AS d)
SELECT log.o_custkey, o_orderkey, o_totalprice, log.day AS since, until
FROM log LEFT JOIN days ON log.o_custkey = days.o_custkey AND log.day = days.day WHERE op IN ('I', 'U')""",
        "apply_changes": """
SELECT o_orderkey AS k, o_totalprice AS v FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag IN ('R', 'A'))
UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_returnflag = 'A'""",
        "log_days": f"WITH {ORDER_LOG} SELECT DISTINCT day FROM log WHERE day <= DATE '{AS_OF}'",
        "log_day_slice": f"""WITH {ORDER_LOG}
SELECT o_custkey, o_orderkey, o_totalprice FROM log WHERE day = DATE '{AS_OF}' AND op IN ('I', 'U')""",
        "log_day_deletes": f"""WITH {ORDER_LOG}
SELECT o_custkey, o_orderkey, o_totalprice FROM log WHERE day = DATE '{AS_OF}' AND op = 'D'""",
        "null_key_filter": """
SELECT k, source FROM (SELECT CASE WHEN lang <> 'en' THEN doc_id END AS k, source FROM documents) AS docs
WHERE k IS NOT NULL""",
        "duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "dedupe_by_key": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
                      l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
                      l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS nth
      FROM lineitem) AS numbered
WHERE nth = 1""",
        "clean_dump": f"WITH {LINE_DUMPS} {_cleaned('old')}",
        "key_quality": f"""WITH {LINE_DUMPS}
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS null_keys,
       (SELECT count(*) FROM (SELECT 1 FROM old WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
                              GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) AS d) AS duplicate_keys
FROM old""",
        "group_count_report": """
SELECT c_mktsegment, count(*) AS count FROM customer
GROUP BY c_mktsegment ORDER BY count DESC, c_mktsegment LIMIT 50""",
        "group_count_top_groups": """
SELECT l_suppkey, count(*) AS count FROM lineitem
GROUP BY l_suppkey ORDER BY count DESC, l_suppkey LIMIT 50""",
        "group_count_by_expression": """
SELECT split_part(p_name, ' ', 1) AS first_word, NULLIF(p_brand, 'Brand#1') AS brand, count(*) AS count
FROM part GROUP BY 1, 2""",
        "align_union": """
SELECT doc_id, lang, CAST(NULL AS INTEGER) AS quality FROM documents
UNION ALL SELECT doc_id, CAST(NULL AS VARCHAR), quality FROM labels""",
        "csv_dump_roundtrip": "SELECT * FROM customer",
        "snapshot_roundtrip": "SELECT * FROM part",
        "change_log_roundtrip": f"WITH {ORDER_LOG} SELECT * REPLACE (last_day(day) AS day) FROM log",
        "integrate_then_as_of": f"{clean_days} SELECT * FROM second",
        "integrate_latest_snapshot": f"{clean_days} SELECT * FROM first",
        "integrate_change_log": f"{clean_days} {three_days}",
        "integrate_bucketed_change_log": f"{clean_days} {three_days}",
        "integrate_figures": f"""{clean_days},
log AS ({three_days}),
dumps AS (SELECT *, DATE '2025-01-01' AS day FROM old UNION ALL SELECT *, DATE '2025-01-02' FROM new
          UNION ALL SELECT *, DATE '2025-01-03' FROM old),
per_key AS (SELECT day, l_orderkey, l_linenumber, count(*) AS n FROM dumps GROUP BY 1, 2, 3),
quality AS (SELECT day, CAST(sum(n) AS BIGINT) AS dump_rows,
                   CAST(sum(CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN n ELSE 0 END) AS BIGINT)
                       AS null_keys,
                   count(*) FILTER (WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND n > 1)
                       AS duplicate_keys,
                   count(*) FILTER (WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) AS snapshot_rows
            FROM per_key GROUP BY day),
changes AS (SELECT day, count(*) FILTER (WHERE op = 'I') AS inserted,
                   count(*) FILTER (WHERE op = 'U') AS updated,
                   count(*) FILTER (WHERE op = 'D') AS deleted
            FROM log GROUP BY day)
SELECT quality.*, CAST(0 AS BIGINT) AS malformed_rows, inserted, updated, deleted FROM quality JOIN changes ON quality.day = changes.day""",
        "integrate_row_digests": f"{clean_days} {three_days}",
        "change_set_by_digests": f"WITH {ORDER_DUMPS} {ORDER_CHANGES}",
        "integrate_quiet_buckets": f"""WITH {LINE_DUMPS},
edited AS (SELECT * REPLACE (CASE WHEN l_orderkey <> (SELECT min(l_orderkey) FROM lineitem) THEN l_quantity END
                             AS l_quantity) FROM old),
first AS ({_cleaned("old")}),
second AS ({_cleaned("edited")})
SELECT *, DATE '2025-01-01' AS day FROM (SELECT *, 'I' AS op FROM first) AS a
UNION ALL SELECT *, DATE '2025-01-02' AS day FROM ({_line_changes("first", "second")}) AS b""",
        "report_latest_all_groups": f"""{clean_days}
SELECT l_partkey, count(*) AS count FROM first GROUP BY l_partkey""",
        "integrate_same_day_again": f"{clean_days} {three_days}",
        "integrate_other_day_name": f"""{clean_days}
SELECT *, DATE '2025-01-01' AS dt FROM (SELECT *, 'I' AS op FROM first) AS a
UNION ALL SELECT *, DATE '2025-01-02' FROM ({_line_changes("first", "second")}) AS b""",
        "integrate_late_day": f"{clean_days} {three_days}",
        "integrate_columns_come_and_go": f"{clean_days} SELECT * FROM second",
        "integrate_from_anchor": f"{clean_days} SELECT * FROM second",
        "stamp_day": f"WITH {ORDER_DUMPS} SELECT *, DATE '{AS_OF}' AS day FROM ({ORDER_CHANGES}) AS changes",
        "change_set_helper_names": f"""WITH {ORDER_DUMPS}
SELECT o_orderkey, o_custkey AS _here, o_totalprice AS _n_old, o_orderstatus AS _key_hash,
       o_orderpriority AS _times, op
FROM ({ORDER_CHANGES}) AS changes""",
        "recompute_snapshot": f"{clean_days} SELECT * FROM second",
        "recompute_folded": f"{clean_days} SELECT * FROM first",
        "recompute_some_keys": f"""{clean_days}
SELECT * FROM second WHERE (l_orderkey, l_linenumber) IN (
    SELECT (l_orderkey, l_linenumber) FROM lineitem ORDER BY l_quantity DESC, l_orderkey, l_linenumber LIMIT 100)""",
        "report_incremental": f"""{clean_days}
SELECT l_returnflag, l_quantity, count(*) AS count, day
FROM (SELECT *, unnest([DATE '2025-01-01', DATE '2025-01-03']) AS day FROM first
      UNION ALL SELECT *, unnest([DATE '2025-01-02', DATE '2025-02-01']) AS day FROM second) AS dumps
GROUP BY l_returnflag, l_quantity, day""",
        "report_latest": f"""{clean_days}
SELECT l_returnflag, count(*) AS count FROM first GROUP BY l_returnflag""",
    }
