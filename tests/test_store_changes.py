"""Stores whose columns come and go, CSV dumps with bad lines, and old snapshots kept as anchors."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from helpers import bag, plan_of

from daybook import MalformedRowsError, TableSpec, plans, sources
from daybook.plans import integrate as integrate_module

ID = TableSpec("id")
FIRST = date(2025, 1, 1)


def _same_as_dumps(spark, store, dumps):
    for day, (columns, rows) in dumps.items():
        for log_only in (False, True):
            got = plans.stored_snapshot_as_of(spark, store, day, from_log_only=log_only)
            assert got.columns == columns and bag(got) == Counter(rows), (day, log_only)


def _integrate(spark, store, dumps, **settings):
    for day, (columns, rows) in dumps.items():
        schema = ", ".join(f"{c} int" if c == "id" else f"{c} string" for c in columns)
        plans.integrate_day(spark, store, day, spark.createDataFrame(rows, schema), **settings)


@pytest.mark.parametrize("buckets", [None, 2])
def test_a_column_that_leaves_and_returns_starts_from_null(spark, tmp_path, buckets):
    dumps = {
        FIRST: (["id", "name"], [(1, "a"), (2, "b")]),
        FIRST + timedelta(1): (["id"], [(1,), (2,)]),
        FIRST + timedelta(2): (["id", "name"], [(1, None), (2, "b")]),
        FIRST + timedelta(3): (["id", "name"], [(1, None), (2, "c")]),
    }
    for keep in (1, 9):
        store = sources.DumpStore(str(tmp_path / f"s{keep}"), ID, buckets)
        _integrate(spark, store, dumps, keep_snapshots=keep)
        _same_as_dumps(spark, store, dumps)


def test_a_returning_column_may_be_spelled_anew(spark, tmp_path):
    dumps = {
        FIRST: (["id", "name"], [(1, "a")]),
        FIRST + timedelta(1): (["id"], [(1,)]),
        FIRST + timedelta(2): (["id", "Name"], [(1, None)]),
    }
    store = sources.DumpStore(str(tmp_path), ID)
    _integrate(spark, store, dumps, keep_snapshots=1)
    got = plans.stored_snapshot_as_of(spark, store, FIRST + timedelta(2), from_log_only=True)
    assert bag(got) == Counter([(1, None)])


@pytest.mark.parametrize("seed", [1, 2])
def test_any_columns_on_any_day(spark, tmp_path, seed):
    rng = random.Random(seed)
    dumps = {}
    for n in range(5):
        columns = ["id"] + [c for c in ("a", "b") if rng.random() < 0.6]
        ids = [i for i in range(6) if rng.random() < 0.8]
        rows = [(i, *(rng.choice([None, "x", "y"]) for _ in columns[1:])) for i in ids]
        dumps[FIRST + timedelta(n)] = columns, rows
    store = sources.DumpStore(str(tmp_path), ID)
    _integrate(spark, store, dumps, keep_snapshots=3)
    _same_as_dumps(spark, store, dumps)


def _csv(tmp_path, *lines):
    path = tmp_path / "dump.csv"
    path.write_text("\n".join(["id,v,w", *lines]) + "\n")
    return str(path)


SCHEMA = "id int, v int, w string"


@pytest.mark.parametrize("options", [None, {"malformed_column": "bad"}])
def test_lines_that_do_not_fit_are_counted_and_kept_as_far_as_they_fit(spark, tmp_path, options):
    store = sources.DumpStore(str(tmp_path / "store"), ID)
    path = _csv(tmp_path, "1,5,x", "2,abc,y", "3", "4,6,z,surplus", ",7,n")
    done = plans.integrate_csv(spark, store, FIRST, path, SCHEMA, csv_options=options)
    assert (done.counts["malformed_rows"], done.counts["dump_rows"], done.counts["null_keys"]) == (3, 5, 1)
    assert store.commits(spark).first()["malformed_rows"] == 3
    latest = store.latest_snapshot(spark)
    assert latest.columns == ["id", "v", "w"]
    assert bag(latest) == Counter([(1, 5, "x"), (2, None, "y"), (3, None, None), (4, 6, "z")])
    assert store.change_log(spark).columns == ["id", "v", "w", "op", "day"]
    assert not (tmp_path / "store" / "staged").exists()


def test_a_strict_run_refuses_lines_that_do_not_fit(spark, tmp_path):
    store = sources.DumpStore(str(tmp_path / "store"), ID)
    with pytest.raises(MalformedRowsError, match="1 lines"):
        plans.integrate_csv(spark, store, FIRST, _csv(tmp_path, "1,5,x", "2,abc,y"), SCHEMA, strict=True)
    assert store.commits(spark).isEmpty() and not (tmp_path / "store" / "staged").exists()
    done = plans.integrate_csv(spark, store, FIRST, _csv(tmp_path, "1,5,x"), SCHEMA, strict=True)
    assert done.counts["malformed_rows"] == 0
    with pytest.raises(ValueError, match="check"):
        plans.integrate_csv(spark, store, FIRST, "x", SCHEMA, strict=True, check_quality=False)


def test_what_is_cleaned_is_the_parsed_copy(spark, tmp_path, monkeypatch):
    """The CSV is scanned once: cleaning and key figures read the copy."""
    store = sources.DumpStore(str(tmp_path / "store"), ID)
    seen = []
    real = integrate_module.clean_dump
    monkeypatch.setattr(integrate_module, "clean_dump", lambda df, spec: seen.append(plan_of(df)) or real(df, spec))
    plans.integrate_csv(spark, store, FIRST, _csv(tmp_path, "1,5,x"), SCHEMA)
    assert "FileScan parquet" in seen[0] and "FileScan csv" not in seen[0]


def test_anchors_stay_and_bound_what_is_replayed(spark, tmp_path):
    store = sources.DumpStore(str(tmp_path), ID, anchors="month")
    days = [date(2025, 1, 30), date(2025, 1, 31), date(2025, 2, 1), date(2025, 2, 2), date(2025, 3, 1), date(2025, 3, 2)]
    dumps = {day: (["id", "a"], [(1, str(n)), (2, "x"), (10 + n, "y")]) for n, day in enumerate(days)}
    _integrate(spark, store, dumps, keep_snapshots=1)
    assert store.kept_snapshots(spark) == [days[0], days[2], days[4], days[5]]
    _same_as_dumps(spark, store, dumps)
    plan = plan_of(plans.stored_snapshot_as_of(spark, store, days[3]))
    assert "day#" in plan and "> 2025-02-01" in plan and "<= 2025-02-02" in plan
    with pytest.raises(ValueError, match="month"):
        sources.DumpStore(str(tmp_path), ID, anchors="week")
