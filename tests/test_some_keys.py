"""Some keys of a table as of a day, and how little of a clustered store that reads."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from helpers import bag, scan_metric
from pyspark.sql import functions as F

from daybook import TableSpec, plans, sources
from daybook import operators as ops

FIRST = date(2025, 1, 1)
TWO = TableSpec(("a", "b"))


@pytest.mark.parametrize("settings", [{"clustered": True}, {"clustered": True, "row_digests": True}, {"buckets": 2}])
def test_some_keys_equal_the_whole_filtered(spark, tmp_path, settings):
    rng = random.Random(3)
    store = sources.DumpStore(str(tmp_path), TWO, **settings)
    dumps = {}
    for n in range(3):
        rows = {(a, b): rng.choice("xyz") for a in range(6) for b in "pq" if rng.random() < 0.7}
        dumps[FIRST + timedelta(n)] = [(*k, v) for k, v in rows.items()]
    for day, rows in dumps.items():
        plans.integrate_day(spark, store, day, spark.createDataFrame(rows, "a int, b string, v string"), keep_snapshots=2)
    wanted = [(0, "p"), (1, "q"), (5, "p"), (99, "q"), (2, None)]
    for day, rows in dumps.items():
        for log_only in (False, True):
            found = plans.stored_snapshot_as_of(spark, store, day, from_log_only=log_only, keys=wanted)
            assert bag(found) == Counter(r for r in rows if r[:2] in wanted)
    assert plans.stored_snapshot_as_of(spark, store, FIRST, keys=[]).isEmpty()
    with pytest.raises(ValueError):
        plans.stored_snapshot_as_of(spark, store, FIRST, keys=[1])


def test_files_without_the_key_are_not_read(spark, tmp_path, conf):
    conf({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    n = 20_000
    # Keys come in no order.
    dump = spark.range(n).selectExpr("(id * 7919) % 20000 AS id", "'a' AS v")
    edited = dump.withColumn("v", F.lit("b"))
    read = {}
    for clustered in (False, True):
        store = sources.DumpStore(str(tmp_path / str(clustered)), TableSpec("id"), clustered=clustered)
        for day, rows in ((FIRST, dump), (FIRST + timedelta(1), edited)):
            plans.integrate_day(spark, store, day, rows, num_files=8)
        found = plans.stored_snapshot_as_of(spark, store, FIRST + timedelta(1), from_log_only=True, keys=[4321])
        read[clustered] = scan_metric(found, "numOutputRows")
        assert bag(found) == Counter([(4321, "b")])
    # Two days of 8 files each: one file of each may hold the key.
    assert read[True] <= 2 * n / 8 * 1.5
    assert read[False] > 4 * read[True]


def test_refused(tmp_path):
    with pytest.raises(ValueError):
        sources.DumpStore(str(tmp_path), TWO, clustered=True, buckets=2)


def test_null_keys_fit_nothing(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y")], "id int, v string")
    assert bag(df.where(ops.among_keys(df, [1, None], TableSpec("id")))) == Counter([(1, "x")])
