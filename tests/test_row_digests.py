"""Comparing by keys and digests, alone and in the daily job."""

import random

import pytest
from helpers import bag, brute_change_set, plan_of
from pyspark.sql import functions as F

from daybook import TableSpec, plans, sources
from daybook import operators as ops

ID = TableSpec("id")
SCHEMA = "id int, v string, w double"


def some_rows(rng, n):
    values = [None, 0.0, -0.0, 1.5, float("nan")]
    return [(i, rng.choice(["a", "b", None]), rng.choice(values)) for i in rng.sample(range(40), n)]


def by_digests(old, new, spec, **settings):
    touched = ops.touched_keys(ops.row_digests(old, spec), ops.row_digests(new, spec), spec)
    return ops.change_set_by_digests(old, new, spec, touched, **settings)


@pytest.mark.parametrize("compared", [None, ("v",)])
def test_equals_the_comparison_by_value(spark, compared):
    spec, rng = TableSpec("id", compared), random.Random(3)
    for n_old, n_new in ((30, 30), (0, 20), (20, 0), (25, 10)):
        old, new = (spark.createDataFrame(some_rows(rng, n), SCHEMA) for n in (n_old, n_new))
        found = by_digests(old, new, spec, few=n_new == 30)
        assert bag(found) == bag(ops.change_set(old, new, spec, keys_unique=True))


def test_values_that_change_places_are_told_apart(spark):
    old = spark.createDataFrame([(1, "x", None), (2, None, None), (3, "x", "y")], "id int, v string, w string")
    new = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "y", "x")], "id int, v string, w string")
    found = by_digests(old, new, ID)
    expected = brute_change_set([tuple(r) for r in old.collect()], [tuple(r) for r in new.collect()], 1)
    assert bag(found) == expected and sum(expected.values()) == 2


def test_equal_values_of_other_digests_are_no_change(spark):
    """A digest that differs only asks for a look at the values."""
    rows = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], SCHEMA)
    off = ops.row_digests(rows, ID).withColumn("digest_low", F.lit(0).cast("long"))
    touched = ops.touched_keys(ops.row_digests(rows, ID), off, ID)
    assert bag(touched) == {(1, "U"): 1, (2, "U"): 1}
    assert ops.change_set_by_digests(rows, rows, ID, touched).isEmpty()


def test_nested_columns_have_no_digests(spark, tmp_path):
    rows = spark.range(3).select("id", F.array("id").alias("a"))
    assert ops.row_digests(rows, ID) is None
    store = sources.DumpStore(str(tmp_path), ID, row_digests=True)
    for day in ("2025-01-01", "2025-01-02"):
        plans.integrate_day(spark, store, day, rows)
    assert bag(ops.change_counts(store.change_log(spark), ID)) == {("I", 3): 1}


def test_daily_job(spark, tmp_path, monkeypatch):
    from daybook.plans import integrate

    used = []
    real = integrate.change_set_by_digests

    def change_set_by_digests(*args, **settings):
        used.append(plan_of(real(*args, **settings)))
        return real(*args, **settings)

    monkeypatch.setattr(integrate, "change_set_by_digests", change_set_by_digests)
    rng = random.Random(8)
    stores = [sources.DumpStore(str(tmp_path / str(k)), ID, row_digests=k) for k in (True, False)]
    for n, day in enumerate(("2025-01-01", "2025-01-02", "2025-01-03", "2025-01-04", "2025-01-05")):
        dump = spark.createDataFrame(some_rows(rng, 25), SCHEMA)
        if n == 3:  # another column: no digests of the day before fit
            dump = dump.withColumn("u", F.lit(1))
        for store in stores:
            plans.integrate_day(spark, store, day, dump)
        assert bag(stores[0].change_log(spark)) == bag(stores[1].change_log(spark))
        assert len(used) == (0, 1, 2, 2, 2)[n]
    # Rows are looked up where they are; only those of changed keys go on to be compared.
    assert all(p.count("BroadcastHashJoin") >= 2 and "LeftSemi" in p for p in used)
    kept = {p.name for p in (tmp_path / "True" / "digests").iterdir()}
    assert kept == {"day=2025-01-04", "day=2025-01-05"}


def test_digests_of_a_dead_run_are_not_taken_for_the_day_s_own(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    keeps, keeps_none = (sources.DumpStore(str(tmp_path), ID, row_digests=k) for k in (True, False))
    day = plans.integrate.parse_day("2025-01-01")
    dead = ops.row_digests(rows.withColumn("v", F.lit("z")), ID)
    keeps.write_row_digests(day, dead, spark)
    plans.integrate_day(spark, keeps_none, day.isoformat(), rows)
    plans.integrate_day(spark, keeps, "2025-01-02", rows.withColumn("v", F.lit("z")))
    assert bag(keeps.change_log(spark).where("day = '2025-01-02'").select("id", "v", "op")) == {(1, "z", "U"): 1}
    with pytest.raises(ValueError):
        sources.DumpStore(str(tmp_path), ID, buckets=2, row_digests=True)


def test_many_changed_keys_compare_whole_days(spark, tmp_path, monkeypatch):
    from daybook.plans import integrate

    monkeypatch.setattr(integrate, "FEW_KEYS_BYTES", 10)
    monkeypatch.setattr(integrate, "change_set_by_digests", None)
    store = sources.DumpStore(str(tmp_path), ID, row_digests=True)
    for day, v in (("2025-01-01", "a"), ("2025-01-02", "b")):
        plans.integrate_day(spark, store, day, spark.range(9).select("id", F.lit(v).alias("v")))
    assert bag(ops.change_counts(store.change_log(spark), ID)) == {("I", 9): 1, ("U", 9): 1}
