"""Many days at once against one rebuild a day."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from helpers import bag, brute_replay, plan_of

from daybook import TableSpec
from daybook import operators as ops

ID = TableSpec("id")
LOG = "id int, v string, op string, day date"
FIRST = date(2025, 1, 1)


def some_log(seed, n):
    rng = random.Random(seed)
    ids = [None, 1, 1, 1, *range(2, 12)]
    return [
        (rng.choice(ids), rng.choice("abc"), rng.choice("IIUUDX"), FIRST + timedelta(rng.randint(0, 20))) for _ in range(n)
    ]


@pytest.mark.parametrize("n", [0, 5, 150])
def test_many_days_equal_single_rebuilds(spark, n):
    rows = some_log(n, n)
    log = spark.createDataFrame(rows, LOG)
    asked = [FIRST + timedelta(k) for k in (9, -3, 0, 1, 9, 20, 40)]
    found = Counter()
    for *row, day in ops.snapshots_as_of(log, [asked[0].isoformat(), *asked[1:]], ID).collect():
        found[(*row, day)] += 1
    expected = Counter({(*r, d): k for d in set(asked) for r, k in brute_replay(rows, d, 1).items()})
    assert found == expected
    assert bag(ops.snapshot_as_of(log, asked[0], ID)) == Counter({r[:-1]: k for r, k in found.items() if r[-1] == asked[0]})


def test_history(spark):
    d1, d2, d3 = (FIRST + timedelta(k) for k in range(3))
    rows = [(1, "a", "I", d1), (1, "b", "U", d2), (1, None, "D", d3), (2, "x", "I", d1), (2, "y", "X", d2)]
    rows += [(None, "n", "I", d1), (None, "n", "D", d2), (3, "p", "U", d2), (3, "q", "U", d2)]
    found = bag(ops.history(spark.createDataFrame(rows, LOG), ID))
    assert found == Counter(
        [(1, "a", d1, d2), (1, "b", d2, d3), (2, "x", d1, None), (None, "n", d1, None), (3, "p", d2, None), (3, "q", d2, None)]
    )


def test_the_plan_does_not_grow_with_the_days(spark, tmp_path):
    spark.createDataFrame(some_log(1, 50), LOG).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    scans = [plan_of(ops.snapshots_as_of(log, [FIRST + timedelta(k) for k in range(n)], ID)).count("FileScan") for n in (1, 15)]
    assert scans[0] == scans[1]


def test_refused(spark):
    log = spark.createDataFrame(some_log(1, 5), LOG)
    with pytest.raises(ValueError):
        ops.snapshots_as_of(log, [], ID)
    with pytest.raises(ValueError):
        ops.snapshots_as_of(log.withColumnRenamed("v", "as_of"), [FIRST], ID)
    with pytest.raises(ValueError):
        ops.history(log.withColumnRenamed("v", "Since"), ID)
