import random
from collections import Counter

import pytest
from helpers import bag, brute_change_set

from daybook import MissingColumnError, TableSpec, UncomparableColumnError
from daybook import operators as ops
from daybook.operators import diff

ID = TableSpec("id")
TOY = "id string, name string, city string"
BOTH = pytest.mark.parametrize("unique", [False, True])


def change_set(spark, old, new, schema, spec=ID, **kw):
    return ops.change_set(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), spec, **kw)


@BOTH
def test_golden(spark, unique):
    old = [("1", "a", "x"), ("2", "b", "x"), ("3", "c", None)]
    new = [("1", "a", "x"), ("2", "b", "y"), ("4", "d", "x")]
    got = change_set(spark, old, new, TOY, keys_unique=unique)
    assert got.columns == ["id", "name", "city", "op"]
    assert bag(got) == Counter([("4", "d", "x", "I"), ("2", "b", "y", "U"), ("3", "c", None, "D")])


@BOTH
def test_value_to_null_is_an_update_and_null_to_null_is_not(spark, unique):
    old = [("1", "a", "x"), ("2", "b", None)]
    new = [("1", "a", None), ("2", "b", None)]
    assert bag(change_set(spark, old, new, TOY, keys_unique=unique)) == Counter([("1", "a", None, "U")])


@BOTH
def test_null_key_rows_come_out_as_insert_and_delete(spark, unique):
    row = [(None, "a", "x")]
    got = bag(change_set(spark, row, row, TOY, keys_unique=unique))
    assert got == Counter([(None, "a", "x", "I"), (None, "a", "x", "D")])


@BOTH
def test_repeated_keys_count_differing_pairs(spark, unique):
    old = [("k", "v1", None), ("k", "v2", None)]
    new = [("k", "v1", None), ("k", "v3", None)]
    got = bag(change_set(spark, old, new, TOY, keys_unique=unique))
    assert got == Counter({("k", "v1", None, "U"): 1, ("k", "v3", None, "U"): 2})


@BOTH
def test_floats_compare_as_spark_compares_them(spark, unique):
    old = [(1, float("nan")), (2, 0.0), (3, None), (4, float("nan"))]
    new = [(1, float("nan")), (2, -0.0), (3, float("nan")), (4, None)]
    got = bag(change_set(spark, old, new, "id int, v double", keys_unique=unique))
    assert got == Counter([(3, "NaN", "U"), (4, None, "U")])


@BOTH
def test_key_only_table_has_no_updates(spark, unique):
    got = bag(change_set(spark, [(1,), (2,), (2,)], [(2,), (3,)], "id int", keys_unique=unique))
    assert got == Counter([((3), "I"), ((1), "D")])


@BOTH
def test_empty_sides(spark, unique):
    rows = [("1", "a", "x"), ("1", "b", "x"), (None, "c", "x")]
    assert set(r[-1] for r in bag(change_set(spark, [], rows, TOY, keys_unique=unique)).elements()) == {"I"}
    assert bag(change_set(spark, rows, [], TOY, keys_unique=unique)) == Counter(r + ("D",) for r in rows)
    assert not bag(change_set(spark, [], [], TOY, keys_unique=unique))


def _random_bags(seed, cases):
    rnd = random.Random(seed)
    values = [None, 0.0, -0.0, 1.5, float("nan")]

    def rows(case, most):
        return [
            (case, rnd.choice([None, 1, 2, 3, 4]), rnd.choice(values), rnd.choice([None, "s", "t"]))
            for _ in range(rnd.randint(0, most))
        ]

    return [(rows(c, 7), rows(c, 7)) for c in range(cases)]


@BOTH
def test_random_bags_against_all_pairs(spark, unique):
    pairs = _random_bags(7, 150)
    schema, spec = "c int, id int, v double, s string", TableSpec(("c", "id"))
    got = change_set(spark, sum((o for o, _ in pairs), []), sum((n for _, n in pairs), []), schema, spec, keys_unique=unique)
    expected = sum((brute_change_set(o, n, 2) for o, n in pairs), Counter())
    assert bag(got) == expected


@pytest.mark.parametrize("extra", [0, 2])
def test_setting_repeated_keys_apart_changes_nothing(spark, extra):
    pairs = _random_bags(13, 150)
    schema, spec = "c int, id int, v double, s string", TableSpec(("c", "id"))
    old, new = (spark.createDataFrame(sum((p[i] for p in pairs), []), schema) for i in (0, 1))
    repeated = ops.align_union(*[ops.duplicate_keys(side, spec).drop("count") for side in (old, new)]).distinct()
    # Keys that do not repeat, or do not occur, may be among them.
    repeated = repeated.union(spark.createDataFrame([(c, 1) for c in range(extra * 100)], "c int, id int")).distinct()
    got = ops.change_set(old, new, spec, repeated_keys=repeated)
    assert bag(got) == sum((brute_change_set(o, n, 2) for o, n in pairs), Counter())


def test_parts_add_up_to_the_change_set(spark):
    pairs = _random_bags(11, 60)
    schema, spec = "c int, id int, v double, s string", TableSpec(("c", "id"))
    old = spark.createDataFrame(sum((o for o, _ in pairs), []), schema)
    new = spark.createDataFrame(sum((n for _, n in pairs), []), schema)
    parts = [f(old, new, spec) for f in (ops.inserted, ops.updated, ops.deleted)]
    assert sum((bag(p) for p in parts), Counter()) == bag(ops.change_set(old, new, spec))
    counts = {r["op"]: r["count"] for r in ops.change_counts(ops.change_set(old, new, spec), spec).collect()}
    assert counts == {op: p.count() for op, p in zip("IUD", parts)}


def test_many_copies_of_one_key_stay_cheap(spark):
    # All pairs would be 4e10 here; the same row on both sides leaves nothing to report.
    copies = spark.range(200_000).selectExpr("7 as id", "'same' as name")
    assert ops.change_set(copies, copies, ID).isEmpty()
    one_more = copies.unionByName(spark.createDataFrame([(7, "other")], "id int, name string"))
    got = ops.change_set(copies, one_more, ID).groupBy("name", "op").count()
    assert bag(got) == Counter([("other", "U", 200_000)])


@BOTH
def test_column_only_on_the_newer_side(spark, unique):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (5, "e")], "id int, name string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", "z"), (3, "c", "z")], "id int, name string, extra string")
    got = ops.change_set(old, new, ID, keys_unique=unique)
    assert bag(got) == Counter([(2, "b", "z", "U"), (3, "c", "z", "I"), (5, "e", None, "D")])
    assert ops.deleted(old, new, ID).columns == ["id", "name", "op"]


@BOTH
def test_column_only_on_the_older_side(spark, unique):
    old = spark.createDataFrame([(1, "a", "p"), (2, "b", "q"), (4, "d", "r")], "id int, gone string, name string")
    new = spark.createDataFrame([(1, "p"), (2, "qq"), (3, "s")], "id int, name string")
    got = ops.change_set(old, new, ID, keys_unique=unique)
    assert got.columns == ["id", "name", "gone", "op"]
    assert bag(got) == Counter([(2, "qq", None, "U"), (3, "s", None, "I"), (4, "r", "d", "D")])


@BOTH
def test_only_the_compared_columns_decide(spark, unique):
    spec = TableSpec("id", compared="name")
    got = change_set(spark, [(1, "a", 1), (2, "b", 1)], [(1, "a", 2), (2, "c", 2)], "id int, name string, n int", spec, keys_unique=unique)
    assert bag(got) == Counter([(2, "c", 2, "U")])


@BOTH
def test_types_and_spelling_may_differ(spark, unique):
    old = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "ID int, N int")
    new = spark.createDataFrame([(1, 10), (2, 21), (2**40, 1)], "id long, n long")
    got = ops.change_set(old, new, ID, keys_unique=unique)
    assert got.columns == ["id", "n", "op"]
    assert bag(got) == Counter([(2, 21, "U"), (2**40, 1, "I"), (3, 30, "D")])


@BOTH
def test_odd_column_names(spark, unique):
    schema = "`my id` int, `a.b` string, `tick``ed` string"
    spec = TableSpec("my id")
    got = change_set(spark, [(1, "a", "b"), (2, "c", "d")], [(1, "a", "x"), (3, "c", "d")], schema, spec, keys_unique=unique)
    assert bag(got, "my id", "op") == Counter([(1, "U"), (3, "I"), (2, "D")])


@BOTH
def test_nested_values_compare(spark, unique):
    schema = "id int, v struct<x: int, y: array<double>>"
    old = [(1, (1, [float("nan"), None])), (2, (1, [1.0])), (3, None)]
    new = [(1, (1, [float("nan"), None])), (2, (1, [2.0])), (3, (None, None))]
    got = change_set(spark, old, new, schema, keys_unique=unique)
    assert bag(got, "id", "op") == Counter([(2, "U"), (3, "U")])


def test_map_columns_are_refused_unless_left_out(spark):
    df = spark.sql("select 1 as id, 'a' as name, map('k', 1) as m")
    with pytest.raises(UncomparableColumnError, match="m"):
        ops.change_set(df, df, ID)
    spec = TableSpec("id", compared="name")
    changed = spark.sql("select 1 as id, 'b' as name, map('k', 2) as m")
    for unique in (False, True):
        assert bag(ops.change_set(df, changed, spec, keys_unique=unique), "name", "op") == Counter([("b", "U")])


def test_missing_key_and_reserved_column_raise(spark):
    df = spark.createDataFrame([(1, "I")], "id int, op string")
    with pytest.raises(MissingColumnError):
        ops.change_set(df.drop("op"), df.drop("op"), TableSpec("nope"))
    with pytest.raises(ValueError, match="op"):
        ops.change_set(df, df, ID)


def test_applying_a_change_set_gives_the_newer_snapshot(spark):
    rnd = random.Random(3)

    def rows():
        return [(k, rnd.choice([None, "a", "b"])) for k in range(60) if rnd.random() < 0.7]

    for _ in range(2):
        a, b = (spark.createDataFrame(rows(), "id int, v string") for _ in range(2))
        changes = ops.change_set(a, b, ID, keys_unique=True)
        assert bag(ops.apply_changes(a, changes, ID)) == bag(b)
        ops_of = Counter(r["op"] for r in changes.collect())
        assert b.count() == a.count() + ops_of["I"] - ops_of["D"]
        assert ops.change_set(a, a, ID, keys_unique=True).isEmpty()


@pytest.mark.parametrize(("skewed", "hot_keys"), [("1b", 1 << 16), ("300b", 1 << 16), ("300b", 1), ("1b", 2)])
def test_hot_keys_set_apart_change_no_row(spark, conf, monkeypatch, skewed, hot_keys):
    """All keys hot, some of them, and more of them than are set apart."""
    conf({"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": skewed})
    monkeypatch.setattr(diff, "HOT_KEYS", hot_keys)
    rng = random.Random(11)

    def rows(n):
        keys = [None, 1, 1, 1, 1, 2, 2, 3, *range(4, 20)]
        return [(rng.choice(keys), rng.choice("xy"), rng.choice([None, 0.0, -0.0, float("nan")])) for _ in range(n)]

    for n_old, n_new in ((60, 60), (0, 30), (30, 0), (90, 5)):
        old, new = rows(n_old), rows(n_new)
        frames = [spark.createDataFrame(r, "id int, v string, w double") for r in (old, new)]
        expected = brute_change_set(old, new, 1)
        assert bag(ops.change_set(*frames, ID)) == expected
        assert bag(ops.updated(*frames, ID)) == Counter({r: n for r, n in expected.items() if r[-1] == "U"})
