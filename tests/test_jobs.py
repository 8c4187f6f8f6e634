from collections import Counter
from datetime import date

import pytest
from helpers import bag, brute_change_set, plan_of

from daybook import DayOrderError, KeyQualityError, MissingColumnError, NoSnapshotError, TableSpec
from daybook import operators as ops
from daybook import plans, sources
from daybook.plans import integrate as integrate_module
from daybook.sources.store import schema_of

ID = TableSpec("id")
SCHEMA = "id string, name string, city string"
DUMPS = {
    date(2025, 1, 1): [("1", "a", "x"), ("2", "b", "x"), ("3", "c", None)],
    date(2025, 1, 2): [("1", "a", "x"), ("2", "b", "y"), ("4", "d", "x")],
    date(2025, 1, 3): [("1", "a", "x"), ("2", "b", "y"), ("4", "d", "x")],
    date(2025, 1, 4): [("1", "a", "x"), ("2", "b", None), ("3", "c", "z")],
}
CHANGES = {
    date(2025, 1, 1): [("1", "a", "x", "I"), ("2", "b", "x", "I"), ("3", "c", None, "I")],
    date(2025, 1, 2): [("4", "d", "x", "I"), ("2", "b", "y", "U"), ("3", "c", None, "D")],
    date(2025, 1, 3): [],
    date(2025, 1, 4): [("3", "c", "z", "I"), ("2", "b", None, "U"), ("4", "d", "x", "D")],
}
LOG = Counter((*row, day) for day, rows in CHANGES.items() for row in rows)


@pytest.fixture
def store(tmp_path):
    return sources.DumpStore(str(tmp_path / "store"), ID)


def _csv(tmp_path, day, rows):
    path = tmp_path / f"{day}.csv"
    lines = [",".join("" if v is None else v for v in row) for row in rows]
    path.write_text("\n".join(["id,name,city", *lines]) + "\n")
    return str(path)


def _frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def _all_days(spark, store, **settings):
    for day, rows in DUMPS.items():
        plans.integrate_day(spark, store, day, _frame(spark, rows), **settings)


def test_four_days_of_csv(spark, store, tmp_path):
    for day, rows in DUMPS.items():
        done = plans.integrate_csv(spark, store, day.isoformat(), _csv(tmp_path, day, rows), SCHEMA)
        assert not done.skipped
        kinds = Counter(r[-1] for r in CHANGES[day])
        assert [done.counts[k] for k in ("inserted", "updated", "deleted")] == [kinds["I"], kinds["U"], kinds["D"]]
        assert done.counts["dump_rows"] == done.counts["snapshot_rows"] == 3
    assert bag(store.change_log(spark)) == LOG
    assert bag(store.latest_snapshot(spark)) == Counter(DUMPS[date(2025, 1, 4)])
    for day, rows in DUMPS.items():
        for log_only in (False, True):
            got = plans.stored_snapshot_as_of(spark, store, day, from_log_only=log_only)
            assert bag(got) == Counter(rows)
    report = plans.report_latest(spark, store, "city")
    assert [tuple(r) for r in report.collect()] == [(None, 1), ("x", 1), ("z", 1)]


def test_quiet_day_counts_as_integrated_and_repeat_is_skipped(spark, store):
    _all_days(spark, store)
    again = plans.integrate_day(spark, store, date(2025, 1, 3), _frame(spark, [("9", "other", "dump")]))
    assert again.skipped and again.counts["snapshot_rows"] == 3
    assert bag(store.change_log(spark)) == LOG
    assert store.commits(spark).count() == 4


def test_bad_keys_are_cleaned_and_counted(spark, store):
    rows = [(None, "n", "x"), ("1", "dup", "x"), ("1", "a", "x"), ("2", "b", "x"), ("3", "c", None)]
    done = plans.integrate_day(spark, store, "2025-01-01", _frame(spark, rows))
    assert (done.counts["dump_rows"], done.counts["null_keys"], done.counts["duplicate_keys"]) == (5, 1, 1)
    assert bag(store.latest_snapshot(spark)) == Counter(DUMPS[date(2025, 1, 1)])
    unchecked = plans.integrate_day(spark, store, "2025-01-02", _frame(spark, rows), check_quality=False)
    assert unchecked.counts["null_keys"] is None and unchecked.counts["updated"] == 0


def test_days_must_not_go_back(spark, store):
    plans.integrate_day(spark, store, "2025-01-04", _frame(spark, DUMPS[date(2025, 1, 4)]))
    with pytest.raises(DayOrderError):
        plans.integrate_day(spark, store, "2025-01-02", _frame(spark, []))


def test_bad_input_is_refused_before_anything_is_written(spark, store, tmp_path):
    with pytest.raises(ValueError):
        plans.integrate_csv(spark, store, "garbage", str(tmp_path / "no-such-file"), SCHEMA)
    with pytest.raises(MissingColumnError):
        plans.integrate_day(spark, store, "2025-01-01", spark.range(1).toDF("other"))
    with pytest.raises(ValueError, match="op"):
        plans.integrate_day(spark, store, "2025-01-01", _frame(spark, [("1", "I")], "id string, op string"))
    assert not (tmp_path / "store").exists()


@pytest.mark.parametrize("step", ["change_set", "_count", "write_commit", "expire_snapshots"])
def test_a_run_that_dies_can_be_repeated(spark, store, monkeypatch, step):
    days = list(DUMPS)
    for day in days[:2]:
        plans.integrate_day(spark, store, day, _frame(spark, DUMPS[day]))

    def fail(*_a, **_k):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        on_store = step in ("write_commit", "expire_snapshots")
        m.setattr(sources.DumpStore if on_store else integrate_module, step, fail)
        # What dies is a dump full of changes; the quiet one comes on the repeat.
        wrong = [("7", "wrong", "dump")] if step != "expire_snapshots" else DUMPS[days[2]]
        with pytest.raises(RuntimeError):
            plans.integrate_day(spark, store, days[2], _frame(spark, wrong))
    if step != "expire_snapshots":
        assert bag(store.latest_snapshot(spark)) == Counter(DUMPS[days[1]])
        assert max(r["day"] for r in store.change_log(spark).select("day").collect()) == days[1]
    for day in days[2:]:
        plans.integrate_day(spark, store, day, _frame(spark, DUMPS[day]))
    assert bag(store.change_log(spark)) == LOG
    assert bag(store.latest_snapshot(spark)) == Counter(DUMPS[days[3]])


def test_a_dead_day_that_is_never_repeated_stays_invisible(spark, store, monkeypatch):
    days = list(DUMPS)
    plans.integrate_day(spark, store, days[0], _frame(spark, DUMPS[days[0]]))
    with monkeypatch.context() as m:
        m.setattr(sources.DumpStore, "write_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError()))
        with pytest.raises(RuntimeError):
            plans.integrate_day(spark, store, days[1], _frame(spark, [("7", "wrong", "dump")]))
    plans.integrate_day(spark, store, days[2], _frame(spark, DUMPS[days[2]]))
    assert {r["day"] for r in store.change_log(spark).collect()} == {days[0], days[2]}
    for day, expected in ((days[0], 0), (days[1], 0), (days[2], 2)):
        for log_only in (False, True):
            got = plans.stored_snapshot_as_of(spark, store, day, from_log_only=log_only)
            assert bag(got) == Counter(DUMPS[days[expected]])


def test_columns_come_and_go(spark, store):
    plans.integrate_day(spark, store, "2025-01-01", _frame(spark, [("1", "a"), ("2", "b")], "id string, name string"))
    grown = [("1", "a", None), ("2", "b", 5)]
    plans.integrate_day(spark, store, "2025-01-02", _frame(spark, grown, "id string, name string, size int"))
    shrunk = [("1", 1), ("2", 5)]
    plans.integrate_day(spark, store, "2025-01-03", _frame(spark, shrunk, "id string, size int"))
    log = store.change_log(spark)
    assert log.columns == ["id", "name", "size", "op", "day"]
    assert bag(log.where("day = '2025-01-02'"), "id", "size", "op") == Counter([("2", 5, "U")])
    for log_only in (False, True):
        past = plans.stored_snapshot_as_of(spark, store, "2025-01-02", from_log_only=log_only)
        assert past.columns == ["id", "name", "size"] and bag(past) == Counter(grown)
        # Row 2 did not change on day three, so only its old columns are compared.
        now = plans.stored_snapshot_as_of(spark, store, "2025-01-03", from_log_only=log_only)
        assert now.columns == ["id", "size"] and bag(now) == Counter(shrunk)
    with pytest.raises(ValueError, match="size"):
        plans.integrate_day(spark, store, "2025-01-04", _frame(spark, [("1", "x")], "id string, size string"))


def test_recompute_writes_or_does_not(spark, store, tmp_path):
    out = str(tmp_path / "rebuilt")
    assert not plans.recompute_snapshot(spark, store, "2025-01-01", out)
    _all_days(spark, store)
    assert not plans.recompute_snapshot(spark, store, "2024-12-31", out)
    assert not (tmp_path / "rebuilt").exists()
    for day in (date(2025, 1, 4), date(2025, 1, 2)):
        assert plans.recompute_snapshot(spark, store, day, out, num_files=1)
        assert bag(sources.read_snapshot(spark, out)) == Counter(DUMPS[day])
    with pytest.raises(ValueError):
        plans.recompute_snapshot(spark, store, "soon", out)


def test_an_empty_first_dump(spark, store, tmp_path):
    plans.integrate_day(spark, store, "2025-01-01", _frame(spark, []))
    assert store.latest_snapshot(spark).isEmpty() and store.change_log(spark).isEmpty()
    assert not plans.recompute_snapshot(spark, store, "2025-01-01", str(tmp_path / "out"))
    plans.integrate_day(spark, store, "2025-01-02", _frame(spark, [("1", "a", "x")]))
    plans.integrate_day(spark, store, "2025-01-03", _frame(spark, []))
    assert plans.recompute_snapshot(spark, store, "2025-01-03", str(tmp_path / "out"))
    assert sources.read_snapshot(spark, str(tmp_path / "out")).isEmpty()


def test_snapshots_expire_but_every_day_can_be_rebuilt(spark, store):
    _all_days(spark, store, keep_snapshots=1)
    assert store.kept_snapshots(spark) == [date(2025, 1, 4)]
    for day, rows in DUMPS.items():
        assert bag(plans.stored_snapshot_as_of(spark, store, day)) == Counter(rows)
    with pytest.raises(ValueError):
        store.expire_snapshots(spark, 0)


def test_nothing_integrated_yet(spark, store):
    for ask in (
        lambda: store.latest_snapshot(spark),
        lambda: store.change_log(spark),
        lambda: plans.report_latest(spark, store, "city"),
        lambda: plans.stored_snapshot_as_of(spark, store, "2025-01-01"),
    ):
        with pytest.raises(NoSnapshotError):
            ask()


def test_diff_of_stored_snapshots(spark, tmp_path):
    days = list(DUMPS)
    paths = [str(tmp_path / n) for n in ("a", "b", "flawed")]
    for path, rows in zip(paths, (DUMPS[days[0]], DUMPS[days[1]], [*DUMPS[days[1]], (None, "n", "n")])):
        sources.write_snapshot(_frame(spark, rows), path)
    expected = Counter(CHANGES[days[1]])
    assert bag(plans.diff_snapshots(spark, *paths[:2], ID, strict=True)) == expected
    out = str(tmp_path / "changes")
    assert bag(plans.diff_snapshots(spark, paths[0], paths[2], ID, output=out)) == expected + Counter([(None, "n", "n", "I")])
    assert bag(sources.read_snapshot(spark, out)).total() == 4
    with pytest.raises(KeyQualityError, match="newer"):
        plans.diff_snapshots(spark, paths[0], paths[2], ID, strict=True)
    assert bag(ops.change_counts(plans.diff_snapshots(spark, *paths[:2], ID), ID)) == Counter([("I", 1), ("U", 1), ("D", 1)])


def test_diff_of_snapshots_with_repeated_keys(spark, tmp_path):
    old = [("k", "v1", "x"), ("k", "v2", "x"), ("1", "a", "x"), ("2", "b", "x"), (None, "n", "x")]
    new = [("k", "v1", "x"), ("k", "v3", "x"), ("1", "a", "y"), ("3", "c", "x"), (None, "n", "x")]
    for name, rows in (("old", old), ("new", new)):
        sources.write_snapshot(_frame(spark, rows), str(tmp_path / name))
    got = plans.diff_snapshots(spark, str(tmp_path / "old"), str(tmp_path / "new"), ID)
    assert bag(got) == brute_change_set(old, new, 1)
    assert "FullOuter" not in plan_of(got)


@pytest.fixture
def bucketed(tmp_path):
    return sources.DumpStore(str(tmp_path / "bucketed"), ID, buckets=4)


def test_bucketed_store_gives_the_same_days(spark, bucketed):
    _all_days(spark, bucketed)
    assert bag(bucketed.change_log(spark)) == LOG
    for day, rows in DUMPS.items():
        for log_only in (False, True):
            assert bag(plans.stored_snapshot_as_of(spark, bucketed, day, from_log_only=log_only)) == Counter(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("daybook_")]
    with pytest.raises(ValueError):
        plans.integrate_day(spark, bucketed, "2025-02-01", _frame(spark, []), num_files=1)


def test_bucketed_snapshots_are_compared_without_a_shuffle(spark, bucketed, conf, tmp_path):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    for day, shift in ((date(2025, 1, 1), 0), (date(2025, 1, 2), 500)):
        dump = spark.range(shift, 5000 + shift).selectExpr("cast(id as string) as id", "id % 7 as v")
        done = plans.integrate_day(spark, bucketed, day, dump)
        assert len(list((tmp_path / "bucketed/snapshots" / f"day={day}").glob("*.parquet"))) == 4
    assert (done.counts["inserted"], done.counts["updated"], done.counts["deleted"]) == (500, 0, 500)
    old, new = (
        bucketed.snapshot_by_key(spark, c["day"], schema_of(c), c["buckets"])
        for c in bucketed.commits(spark).orderBy("day").collect()
    )
    plan = plan_of(ops.change_set(old, new, ID, keys_unique=True))
    assert "FullOuter" in plan and "Exchange" not in plan


def test_bucket_count_may_change_and_need_not_divide_the_shuffle_width(spark, tmp_path):
    days = list(DUMPS)
    for day, buckets in zip(days, (4, 3, None, 2)):
        store = sources.DumpStore(str(tmp_path / "s"), ID, buckets=buckets)
        plans.integrate_day(spark, store, day, _frame(spark, DUMPS[day]))
    assert bag(store.change_log(spark)) == LOG


def test_a_bucketed_run_that_dies_can_be_repeated(spark, bucketed, monkeypatch):
    days = list(DUMPS)
    plans.integrate_day(spark, bucketed, days[0], _frame(spark, DUMPS[days[0]]))
    with monkeypatch.context() as m:
        m.setattr(sources.DumpStore, "write_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError()))
        with pytest.raises(RuntimeError):
            plans.integrate_day(spark, bucketed, days[1], _frame(spark, [(str(i), "wrong", "dump") for i in range(50)]))
    for day in days[1:]:
        plans.integrate_day(spark, bucketed, day, _frame(spark, DUMPS[day]))
    assert bag(bucketed.change_log(spark)) == LOG
