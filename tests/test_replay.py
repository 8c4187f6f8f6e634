import random
from collections import Counter
from datetime import date, timedelta

import pytest
from helpers import bag, brute_replay

from daybook import MissingColumnError, TableSpec
from daybook import operators as ops

ID = TableSpec("id")
LOG = "id int, v string, op string, day date"
D1, D2, D3 = (date(2025, 1, d) for d in (1, 2, 3))
FORMS = pytest.mark.parametrize("unique", [False, True])


def as_of(spark, rows, day, **kw):
    return bag(ops.snapshot_as_of(spark.createDataFrame(rows, LOG), day, ID, **kw))


@FORMS
def test_delete_then_insert_again(spark, unique):
    log = [(1, "a", "I", D1), (1, "a", "D", D2), (1, "b", "I", D3), (2, "x", "I", D1)]
    assert as_of(spark, log, D1, unique_per_day=unique) == Counter([(1, "a"), (2, "x")])
    assert as_of(spark, log, D2, unique_per_day=unique) == Counter([(2, "x")])
    assert as_of(spark, log, "2025-01-03", unique_per_day=unique) == Counter([(1, "b"), (2, "x")])
    assert not as_of(spark, log, "2024-12-31", unique_per_day=unique)


@FORMS
def test_same_day_delete_and_insert_keeps_the_key(spark, unique):
    assert as_of(spark, [(5, "p", "D", D1), (5, "q", "I", D1)], D1, unique_per_day=unique) == Counter([(5, "q")])


@FORMS
def test_all_rows_of_the_newest_day_stay(spark, unique):
    log = [(5, "old", "I", D1), (5, "p", "I", D2), (5, "q", "U", D2), (5, "q", "U", D2)]
    assert as_of(spark, log, D2, unique_per_day=unique) == Counter({(5, "p"): 1, (5, "q"): 2})


@FORMS
def test_unknown_operations_are_ignored(spark, unique):
    log = [(1, "a", "I", D1), (1, "z", "X", D2), (1, "z", None, D3)]
    assert as_of(spark, log, D3, unique_per_day=unique) == Counter([(1, "a")])


@FORMS
def test_null_keys_pile_up(spark, unique):
    log = [(None, "a", "I", D1), (None, "a", "D", D2), (None, "b", "U", D3)]
    assert as_of(spark, log, D3, unique_per_day=unique) == Counter([(None, "a"), (None, "b")])


def _random_logs(seed, cases):
    rnd = random.Random(seed)
    return [
        (c, rnd.choice([None, 1, 2, 3]), rnd.choice(["a", "b", None]), rnd.choice(["I", "U", "D", "X"]),
         D1 + timedelta(days=rnd.randint(0, 5)))
        for c in range(cases)
        for _ in range(rnd.randint(0, 9))
    ]


@FORMS
@pytest.mark.parametrize("reach", [0, 2, 5])
def test_random_logs_against_day_by_day_replay(spark, unique, reach):
    log = _random_logs(reach, 150)
    spec, target = TableSpec(("c", "id")), D1 + timedelta(days=reach)
    frame = spark.createDataFrame(log, "c int, " + LOG)
    got = bag(ops.snapshot_as_of(frame, target, spec, unique_per_day=unique))
    expected = brute_replay(log, target, 2)
    assert got == expected
    base_day = D1 + timedelta(days=reach // 2)
    base = ops.snapshot_as_of(frame, base_day, spec, unique_per_day=unique)
    resumed = ops.snapshot_as_of(frame, target, spec, unique_per_day=unique, base=base, base_day=base_day)
    assert bag(resumed) == expected


def test_apply_changes_day_by_day_equals_as_of(spark):
    log = _random_logs(99, 80)
    spec = TableSpec(("c", "id"))
    frame = spark.createDataFrame(log, "c int, " + LOG)
    state = spark.createDataFrame([], "c int, id int, v string")
    for day in [r["day"] for r in ops.log_days(frame, spec, until="2025-01-03").collect()]:
        state = ops.apply_changes(state, frame.where(frame.day == day), spec)
    assert bag(state) == bag(ops.snapshot_as_of(frame, "2025-01-03", spec))


def test_apply_changes_null_fills_and_follows_spelling(spark):
    snapshot = spark.createDataFrame([(1, "a", 9), (2, "b", 9)], "ID long, v string, old_only int")
    changes = spark.createDataFrame([(2, "c", "U"), (3, "d", "I")], "id int, v string, op string")
    got = ops.apply_changes(snapshot, changes, ID)
    assert bag(got) == Counter([(1, "a", 9), (2, "c", None), (3, "d", None)])


def test_apply_changes_compares_keys_in_the_wider_type(spark):
    snapshot = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    changes = spark.createDataFrame([(2**32 + 1, "far", "I"), (2, "c", "U")], "id long, v string, op string")
    assert bag(ops.apply_changes(snapshot, changes, ID)) == Counter([(1, "a"), (2**32 + 1, "far"), (2, "c")])


def test_log_days_and_slices(spark):
    log = spark.createDataFrame([(1, "a", "I", D2), (2, "b", "D", D2), (3, "c", "U", D1)], LOG)
    assert [r["day"] for r in ops.log_days(log, ID).collect()] == [D1, D2]
    assert [r["day"] for r in ops.log_days(log, ID, until=D1).collect()] == [D1]
    assert bag(ops.log_day(log, D2, ID)) == Counter([(1, "a")])
    assert bag(ops.log_day(log, D2, ID, ops=("D",))) == Counter([(2, "b")])


def test_bad_requests(spark):
    log = spark.createDataFrame([(1, "a", "I", D1)], LOG)
    with pytest.raises(ValueError):
        ops.snapshot_as_of(log, "garbage", ID)
    with pytest.raises(MissingColumnError, match="op"):
        ops.snapshot_as_of(log.drop("op"), D1, ID)
    with pytest.raises(ValueError):
        ops.snapshot_as_of(log, D1, ID, base=log)
    with pytest.raises(ValueError):
        ops.snapshot_as_of(log, D1, ID, base=log, base_day=D2)


def test_stamp_day_gives_a_date(spark):
    changes = spark.createDataFrame([(1, "a", "I")], "id int, v string, op string")
    stamped = ops.stamp_day(changes, "2025-01-01", ID)
    assert dict(stamped.dtypes)["day"] == "date" and stamped.first()["day"] == D1
