"""What the daily job moves: a dump's rows once to clean it, and changes only where they are few."""

from datetime import date
from pathlib import Path

from helpers import bag, plan_of

from daybook import TableSpec, plans, sources
from daybook import operators as ops
from daybook.plans import integrate as integrate_module
from daybook.sources import store as store_module

ID = TableSpec("id")
SCHEMA = "id int, v int"
DAYS = [date(2025, 1, 1), date(2025, 1, 2)]
TWICE = [(n, 0) for n in range(50)] + [(n, 1) for n in range(0, 50, 5)] + [(7, 2), (7, 3), (None, 1), (None, 2)]
FIGURES = ["dump_rows", "null_keys", "duplicate_keys", "snapshot_rows"]


def _figures(done):
    return [done.counts[k] for k in FIGURES]


def test_repeated_keys_are_counted_by_the_cleaning(spark, tmp_path, monkeypatch):
    """No other pass groups the rows by key, neither for CSV files nor for a frame."""

    def unwanted(*_):
        raise AssertionError("keys are grouped again")

    monkeypatch.setattr(integrate_module, "duplicate_keys", unwanted)
    monkeypatch.setattr(integrate_module, "key_quality", unwanted, raising=False)
    dump = spark.createDataFrame(TWICE, SCHEMA)
    dump.write.option("header", True).csv(str(tmp_path / "csv"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for n, buckets in enumerate((None, width)):
        store = sources.DumpStore(str(tmp_path / f"store-{n}"), ID, buckets)
        assert _figures(plans.integrate_day(spark, store, DAYS[0], dump)) == [64, 2, 11, 50]
        assert _figures(plans.integrate_csv(spark, store, DAYS[1], str(tmp_path / "csv"), SCHEMA)) == [64, 2, 11, 50]
        assert bag(store.latest_snapshot(spark)) == bag(ops.clean_dump(dump, ID))


def test_figures_where_a_shuffle_follows_the_cleaning(spark, tmp_path):
    dump = spark.createDataFrame(TWICE, SCHEMA)
    stores = [
        (sources.DumpStore(str(tmp_path / "clustered"), ID, clustered=True), {}),
        (sources.DumpStore(str(tmp_path / "buckets"), ID, buckets=7), {}),
        (sources.DumpStore(str(tmp_path / "files"), ID), {"num_files": 3}),
    ]
    for store, settings in stores:
        assert _figures(plans.integrate_day(spark, store, DAYS[0], dump, **settings)) == [64, 2, 11, 50]


def test_figures_of_dumps_without_rows_or_keys(spark, tmp_path):
    store = sources.DumpStore(str(tmp_path), ID)
    for day, rows, found in ((DAYS[0], [], [0, 0, 0, 0]), (DAYS[1], [(None, 1), (None, 1)], [2, 2, 0, 0])):
        assert _figures(plans.integrate_day(spark, store, day, spark.createDataFrame(rows, SCHEMA))) == found


def _second_day(spark, root, store_calls, monkeypatch):
    store = sources.DumpStore(str(root), ID)
    old = spark.range(3000).selectExpr("cast(id as int) id", "0 v")
    plans.integrate_day(spark, store, DAYS[0], old)
    real = sources.DumpStore.write_log

    def noted(self, changes, *args, **settings):
        store_calls.append(plan_of(changes))
        real(self, changes, *args, **settings)

    monkeypatch.setattr(sources.DumpStore, "write_log", noted)
    plans.integrate_day(spark, store, DAYS[1], old.selectExpr("id", "id % 2 v"))
    log = store.change_log(spark).where(f"day = '{DAYS[1]}'")
    assert log.selectExpr("count(*)", "count(distinct id)", "min(v)", "max(op)").first() == (1500, 1500, 1, "U")
    return [f for f in Path(store.log_path(DAYS[1])).glob("*.parquet")]


def test_changes_are_written_from_where_they_were_found(spark, tmp_path, monkeypatch):
    """Two shuffles compare two days; a third one of the changes is not needed."""
    monkeypatch.setattr(store_module, "SMALL_FILE_BYTES", 1, raising=False)
    seen = []
    _second_day(spark, tmp_path, seen, monkeypatch)
    assert "REBALANCE" not in seen[0] and seen[0].count("Exchange hashpartitioning") == 2


def test_small_files_of_a_log_are_put_together(spark, tmp_path, monkeypatch):
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        assert len(_second_day(spark, tmp_path, [], monkeypatch)) == 1
    finally:
        spark.conf.set(coalesce, before)
    assert not (tmp_path / "gathered").exists()
