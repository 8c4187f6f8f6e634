"""Columns named like those that operators add inside come through untouched."""

from collections import Counter

import pytest

from daybook import TableSpec, plans, sources
from daybook import operators as ops

NAMES = ["_nth", "_n", "_key_hash", "_times", "_block", "_size", "_here", "_rank", "_n_old", "_n_same", "_HERE"]
ID = TableSpec("id")


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", NAMES)
def test_no_helper_name_touches_a_column(spark, name):
    old = spark.createDataFrame([(1, 6), (2, 7), (3, None), (4, 8)], f"id int, `{name}` int")
    new = spark.createDataFrame([(1, 6), (2, 70), (3, 5), (5, 9)], f"id int, `{name}` int")
    changes = Counter([(2, 70, "U"), (3, 5, "U"), (5, 9, "I"), (4, 8, "D")])
    assert bag(ops.change_set(old, new, ID)) == changes
    assert bag(ops.change_set(old, new, ID, keys_unique=True)) == changes
    assert bag(ops.updated(old, new, ID)) == Counter([(2, 70, "U"), (3, 5, "U")])
    assert bag(ops.inserted(old, new, ID)) == Counter([(5, 9, "I")])
    assert bag(ops.deleted(old, new, ID)) == Counter([(4, 8, "D")])
    assert bag(ops.dedupe_by_key(old.union(old), ID)) == bag(old)
    log = ops.stamp_day(ops.change_set(old, new, ID), "2025-01-02", ID)
    for unique in (False, True):
        back = ops.snapshot_as_of(log, "2025-01-02", ID, base=old, base_day="2025-01-01", unique_per_day=unique)
        assert bag(back) == bag(new)
    keyed = spark.createDataFrame([(1,), (1,), (None,)], f"{name} int")
    assert ops.key_quality(keyed, TableSpec(name)).first() == (3, 1, 1)


def test_log_keeps_a_columns_first_spelling(spark, tmp_path):
    store = sources.DumpStore(str(tmp_path), ID)
    plans.integrate_day(spark, store, "2025-01-01", spark.createDataFrame([(1, "a")], "id int, name string"))
    plans.integrate_day(spark, store, "2025-01-02", spark.createDataFrame([(1, "b")], "id int, Name string"))
    log = store.change_log(spark)
    assert log.columns == ["id", "name", "op", "day"]
    assert Counter(r["name"] for r in log.collect()) == Counter(["a", "b"])


def test_changed_type_is_refused_before_writing(spark, tmp_path):
    store = sources.DumpStore(str(tmp_path), ID)
    plans.integrate_day(spark, store, "2025-01-01", spark.createDataFrame([(1, "a")], "id int, name string"))
    with pytest.raises(ValueError, match="was string"):
        plans.integrate_day(spark, store, "2025-01-02", spark.createDataFrame([(1, 2)], "id int, name int"))
    assert [str(d) for d in store.kept_snapshots(spark)] == ["2025-01-01"]


def test_what_a_dead_run_left_goes(spark, tmp_path):
    store = sources.DumpStore(str(tmp_path), ID)
    dump = spark.createDataFrame([(1, "a")], "id int, name string")
    plans.integrate_day(spark, store, "2025-01-01", dump)
    sources.write_snapshot(dump, f"{tmp_path}/snapshots/day=2025-01-02")
    sources.write_snapshot(dump, f"{tmp_path}/log/day=2025-01-02")
    for day in ("2025-01-03", "2025-01-04"):
        plans.integrate_day(spark, store, day, dump)
    assert [str(d) for d in store.kept_snapshots(spark)] == ["2025-01-03", "2025-01-04"]
    assert not (tmp_path / "log" / "day=2025-01-02").exists()
