"""Days put in late against the same days in order."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from helpers import bag, brute_change_set

from daybook import DayOrderError, TableSpec, plans, sources
from daybook.sources.store import DumpStore

ID = TableSpec("id")
FIRST = date(2025, 1, 29)
SCHEMA = "id int, city string, amount double"
FIGURES = ("day", "snapshot_rows", "inserted", "updated", "deleted")


def day_of(n):
    return FIRST + timedelta(n)


def some_dumps(seed, n):
    rng = random.Random(seed)
    ids = [rng.sample(range(30), rng.randint(0, 30)) for _ in range(n)]
    return [[(i, rng.choice(["x", "y", None]), rng.choice([None, 0.5, float("nan")])) for i in day] for day in ids]


def integrate(spark, root, dumps, order, keep=1, **settings):
    store = sources.DumpStore(str(root), ID, **settings)
    for n in order:
        plans.integrate_day(
            spark, store, day_of(n), spark.createDataFrame(dumps[n], SCHEMA), keep_snapshots=keep, late=True
        )
    return store


def rows_of(dump):
    return Counter((i, c, "NaN" if v != v else v) for i, c, v in dump)


def same_as_in_order(spark, store, dumps, days):
    """Log, figures and every rebuilt day are those of the dumps taken in order."""
    log, figures, before = Counter(), Counter(), []
    for n in sorted(days):
        changes = brute_change_set(before, dumps[n], 1)
        log += Counter({(*row, day_of(n)): k for row, k in changes.items()})
        ops = Counter(row[-1] for row in changes)
        figures[day_of(n), len(dumps[n]), ops["I"], ops["U"], ops["D"]] += 1
        before = dumps[n]
    assert bag(store.change_log(spark)) == log
    assert bag(store.commits(spark), *FIGURES) == figures
    assert bag(store.latest_snapshot(spark)) == rows_of(before)
    for n in days:
        got = plans.stored_snapshot_as_of(spark, store, day_of(n), from_log_only=True)
        assert bag(got) == rows_of(dumps[n]), n


@pytest.mark.parametrize(
    ("order", "settings"),
    [
        ((0, 2, 1), {}),
        ((1, 2, 0), {"buckets": 2, "bucket_digests": True}),
        # Two before one day, from either side, and a day after that; over the end of a month.
        ((0, 4, 2, 3, 1, 5), {"row_digests": True}),
        ((2, 1, 0, 3), {"clustered": True, "anchors": "month"}),
    ],
)
def test_late_days_as_if_in_order(spark, tmp_path, order, settings):
    dumps = some_dumps(len(order), len(order))
    store = integrate(spark, tmp_path, dumps, order, **settings)
    same_as_in_order(spark, store, dumps, order)
    again = plans.integrate_day(spark, store, day_of(max(order)), spark.createDataFrame([], SCHEMA))
    now = store.newest_commit(spark)
    assert again.skipped and again.counts["inserted"] == now["inserted"]


def test_kept_reports(spark, tmp_path):
    order = (0, 4, 2, 5, 3)
    dumps = some_dumps(3, 6)
    store = integrate(spark, tmp_path, dumps, order, report_by=("city",))
    for n in order:
        wanted = Counter((c, k) for c, k in Counter(r[1] for r in dumps[n]).items())
        assert bag(plans.report_incremental(spark, store, day=day_of(n))) == wanted, n


def test_folded_months(spark, tmp_path):
    # 29 January, 2 and 5 February, 1 March; 31 January is late, the last of its month.
    dumps = some_dumps(4, 32)
    store = integrate(spark, tmp_path, dumps, (0, 4, 7, 31))
    assert len(plans.fold_log(spark, store)) == 2
    integrate(spark, tmp_path, dumps, (2,))
    assert store.folds(spark) == []
    same_as_in_order(spark, store, dumps, (0, 2, 4, 7, 31))
    assert len(plans.fold_log(spark, store)) == 2
    same_as_in_order(spark, store, dumps, (0, 2, 4, 7, 31))


@pytest.mark.parametrize("dies_in", ["log", "relog", "commit"])
def test_a_late_run_that_dies_changes_nothing(spark, tmp_path, monkeypatch, dies_in):
    dumps = some_dumps(5, 4)
    store = integrate(spark, tmp_path, dumps, (0, 2), report_by="city")

    def dies(method, when=lambda kw: True):
        real = getattr(DumpStore, method)

        def step(self, *args, **kw):
            if when(kw):
                raise RuntimeError("lost")
            return real(self, *args, **kw)

        monkeypatch.setattr(DumpStore, method, step)

    if dies_in == "commit":
        dies("write_commit")
    else:
        dies("write_log", lambda kw: (kw.get("late") is None) == (dies_in == "log"))
    with pytest.raises(RuntimeError):
        # Another dump than the one that comes again.
        integrate(spark, tmp_path, [None, dumps[3]], (1,), report_by="city")
    same_as_in_order(spark, store, dumps, (0, 2))
    monkeypatch.undo()
    integrate(spark, tmp_path, dumps, (1,), report_by="city")
    same_as_in_order(spark, store, dumps, (0, 1, 2))


def test_leavings_of_a_late_run_go_with_the_next_day(spark, tmp_path, monkeypatch):
    dumps = some_dumps(6, 4)
    store = integrate(spark, tmp_path, dumps, (0, 2))

    def dies(*args, **kw):
        raise RuntimeError("lost")

    monkeypatch.setattr(DumpStore, "write_commit", dies)
    with pytest.raises(RuntimeError):
        integrate(spark, tmp_path, dumps, (1,))
    monkeypatch.undo()
    left = tmp_path / "relog" / f"day={day_of(2)}" / f"{day_of(1)}"
    assert left.exists()
    integrate(spark, tmp_path, dumps, (3,))
    assert not left.exists()
    assert bag(plans.stored_snapshot_as_of(spark, store, day_of(2), from_log_only=True)) == bag(
        spark.createDataFrame(dumps[2], SCHEMA)
    )


def test_columns_of_a_late_day(spark, tmp_path):
    store = integrate(spark, tmp_path / "late", [[(1, "x", 0.5)], None, [(1, "x", 0.5)]], (0, 2))
    one = spark.createDataFrame([(1, "x")], "id int, city string")
    with pytest.raises(ValueError, match="town"):
        plans.integrate_day(spark, store, day_of(1), one.withColumnRenamed("city", "town"), late=True)
    with pytest.raises(ValueError, match="city"):
        plans.integrate_day(spark, store, day_of(1), one.selectExpr("id", "1 AS city"), late=True)
    assert store.kept_snapshots(spark) == [day_of(2)]
    plans.integrate_day(spark, store, day_of(1), one, late=True)
    log = bag(store.change_log(spark), "id", "amount", "op", "day")
    assert log == Counter([(1, 0.5, "I", day_of(0)), (1, 0.5, "U", day_of(2))])
    assert plans.stored_snapshot_as_of(spark, store, day_of(1)).columns == ["id", "city"]
    assert bag(plans.stored_snapshot_as_of(spark, store, day_of(2), from_log_only=True)) == Counter([(1, "x", 0.5)])


def test_only_when_asked(spark, tmp_path):
    store = integrate(spark, tmp_path, some_dumps(7, 3), (0, 2))
    with pytest.raises(DayOrderError):
        plans.integrate_day(spark, store, day_of(1), spark.createDataFrame([], SCHEMA))


def test_another_name_of_the_day(spark, tmp_path):
    store = sources.DumpStore(str(tmp_path), TableSpec("id", day="late"))
    dumps = some_dumps(8, 3)
    for n in (0, 2, 1):
        plans.integrate_day(spark, store, day_of(n), spark.createDataFrame(dumps[n], SCHEMA), late=True)
    same_as_in_order(spark, store, dumps, (0, 1, 2))
