"""How often the daily job goes over a dump and its changes."""

from datetime import date

from helpers import bag, plan_of

from daybook import TableSpec, plans, sources
from daybook import operators as ops
from daybook.sources import store as store_module

ID = TableSpec("id")
SCHEMA = "id int, v int"
DAYS = [date(2025, 1, 1), date(2025, 1, 2)]
TWICE = [(n, 0) for n in range(50)] + [(n, 1) for n in range(0, 50, 5)] + [(7, 2), (7, 3), (None, 1), (None, 2)]


def test_rows_are_numbered_once_to_be_cleaned_and_counted(spark, tmp_path, monkeypatch):
    seen, real = [], sources.DumpStore.write_snapshot

    def noted(self, df, *args, **settings):
        seen.append(plan_of(df))
        real(self, df, *args, **settings)

    monkeypatch.setattr(sources.DumpStore, "write_snapshot", noted)
    store = sources.DumpStore(str(tmp_path), ID)
    dump = spark.createDataFrame(TWICE, SCHEMA)
    done = plans.integrate_day(spark, store, DAYS[0], dump)
    assert seen[0].count(" Window [row_number()") == 1 and "CollectMetrics" in seen[0]
    figures = ["dump_rows", "null_keys", "duplicate_keys", "snapshot_rows"]
    assert [done.counts[k] for k in figures] == [64, 2, 11, 50]
    assert bag(store.latest_snapshot(spark)) == bag(ops.clean_dump(dump, ID))


def test_a_parsed_dump_is_counted_while_it_is_copied(spark, tmp_path, monkeypatch):
    """No job reads the copy but the one that cleans it."""
    path = tmp_path / "dump.csv"
    path.write_text("id,v\n1,5\n2,abc\n,7\n1,6,surplus\n,x\n")
    readings, real = [], type(spark.range(0)).agg

    def noted(self, *figures):
        readings.extend(self.inputFiles())
        return real(self, *figures)

    monkeypatch.setattr(type(spark.range(0)), "agg", noted)
    store = sources.DumpStore(str(tmp_path / "store"), ID)
    done = plans.integrate_csv(spark, store, DAYS[0], str(path), SCHEMA)
    figures = ["dump_rows", "malformed_rows", "null_keys", "duplicate_keys", "snapshot_rows"]
    assert [done.counts[k] for k in figures] == [5, 3, 2, 1, 2]
    assert not [file for file in readings if "staged" in file]


def _log_writes(spark, root, monkeypatch):
    store = sources.DumpStore(str(root), ID)
    old = spark.range(3000).selectExpr("cast(id as int) id", "0 v")
    plans.integrate_day(spark, store, DAYS[0], old)
    left = root / "log" / f"day={DAYS[1]}"
    left.mkdir()
    (left / "part-of-a-dead-run.parquet").write_text("not read")
    written, real = [], store_module.write_snapshot

    def noted(df, path, **settings):
        written.append(path.removeprefix(str(root)).split("/")[1])
        real(df, path, **settings)

    monkeypatch.setattr(store_module, "write_snapshot", noted)
    plans.integrate_day(spark, store, DAYS[1], old.selectExpr("id", "id % 2 v"))
    log = store.change_log(spark).where(f"day = '{DAYS[1]}'")
    assert log.selectExpr("count(*)", "count(distinct id)", "min(v)", "max(op)").first() == (1500, 1500, 1, "U")
    assert not (root / "gathered").exists()
    return [kind for kind in written if kind != "snapshots"]


def test_small_files_of_a_log_are_written_twice(spark, tmp_path, monkeypatch, conf):
    conf({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    assert _log_writes(spark, tmp_path, monkeypatch) == ["gathered", "log"]


def test_a_log_that_is_not_small_is_written_once(spark, tmp_path, monkeypatch, conf):
    conf({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    monkeypatch.setattr(store_module, "SMALL_FILE_BYTES", 1)
    assert _log_writes(spark, tmp_path, monkeypatch) == ["gathered"]
