"""Reports from counts kept day by day against counting each day's dump."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from helpers import bag, plan_of

from daybook import MissingColumnError, TableSpec, plans, sources

ID = TableSpec("id")
FIRST = date(2025, 1, 28)
SCHEMA = "id int, city string, change double"


def some_dump(rng):
    ids = rng.sample(range(40), rng.randint(0, 40))
    return [(i, rng.choice(["x", "y", "z", None]), rng.choice([None, 0.0, -0.0, 1.5, float("nan")])) for i in ids]


def counted(rows, *places):
    return bag_of(tuple(r[p] for p in places) for r in rows)


def bag_of(groups):
    plain = (tuple("NaN" if v != v else v + 0.0 if isinstance(v, float) else v for v in g) for g in groups)
    return Counter((*g, n) for g, n in Counter(plain).items())


@pytest.mark.parametrize("settings", [{}, {"buckets": 2}, {"row_digests": True}])
def test_each_day_as_counted(spark, tmp_path, settings):
    rng = random.Random(len(settings))
    dumps = {FIRST + timedelta(k): some_dump(rng) for k in (0, 1, 2, 4, 5, 9)}
    store = sources.DumpStore(str(tmp_path), ID, report_by=("City", "change"), **settings)
    for day, rows in dumps.items():
        plans.integrate_day(spark, store, day, spark.createDataFrame(rows, SCHEMA), keep_snapshots=1)
        assert bag(plans.report_incremental(spark, store, "city")) == counted(rows, 1)
        assert bag(plans.report_latest(spark, store, "city")) == counted(rows, 1)
    for day, rows in dumps.items():
        assert bag(plans.report_incremental(spark, store, day=day)) == counted(rows, 1, 2)
    whole = {r["day"]: r["groups_whole"] for r in store.commits(spark).collect()}
    assert [whole[d] for d in dumps] == [True, False, False, True, False, False]


def test_order_and_limit(spark, tmp_path):
    store = sources.DumpStore(str(tmp_path), ID, report_by="city")
    for n, cities in enumerate((["y", "x", "y", None], ["x", "x", "z", None])):
        rows = [(i, c, None) for i, c in enumerate(cities)]
        plans.integrate_day(spark, store, FIRST + timedelta(n), spark.createDataFrame(rows, SCHEMA))
    assert [tuple(r) for r in plans.report_incremental(spark, store, n=2).collect()] == [("x", 2), (None, 1)]
    assert "snapshots" not in plan_of(plans.report_incremental(spark, store))


def test_columns_that_go_and_days_without_counts(spark, tmp_path):
    a, b, c, d, e = (FIRST.replace(day=1) + timedelta(k) for k in range(5))
    counting = sources.DumpStore(str(tmp_path), ID, report_by="city")
    plain = sources.DumpStore(str(tmp_path), ID)
    full = spark.createDataFrame([(1, "x", 1.0), (2, "y", 1.0)], SCHEMA)
    plans.integrate_day(spark, counting, a, full)
    plans.integrate_day(spark, counting, b, full.drop("city"))
    plans.integrate_day(spark, counting, c, full)
    assert bag(plans.report_incremental(spark, counting, day=b)) == Counter([(None, 2)])
    assert bag(plans.report_incremental(spark, counting, day=c)) == Counter([("x", 1), ("y", 1)])
    plans.integrate_day(spark, plain, d, full.where("id = 1"))
    with pytest.raises(ValueError):
        plans.report_incremental(spark, counting)
    plans.integrate_day(spark, counting, e, full)
    assert bag(plans.report_incremental(spark, counting)) == Counter([("x", 1), ("y", 1)])
    with pytest.raises(MissingColumnError):
        plans.report_incremental(spark, counting, "change")
    with pytest.raises(MissingColumnError):
        unknown = sources.DumpStore(str(tmp_path), ID, report_by="town")
        plans.integrate_day(spark, unknown, e + timedelta(1), full)


def test_groups_that_are_not_compared(spark, tmp_path):
    store = sources.DumpStore(str(tmp_path), TableSpec("id", compared=("change",)), report_by="city")
    for n, city in enumerate("xy"):
        plans.integrate_day(spark, store, FIRST + timedelta(n), spark.createDataFrame([(1, city, 1.0)], SCHEMA))
    assert bag(plans.report_incremental(spark, store)) == Counter([("y", 1)])
