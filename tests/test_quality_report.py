from collections import Counter

import pytest
from helpers import bag
from pyspark.sql import functions as F

from daybook import MissingColumnError, TableSpec
from daybook import operators as ops

ID = TableSpec("id")
SCHEMA = "id string, name string, city string"


def test_clean_dump_keeps_the_smallest_row_of_a_key(spark):
    df = spark.createDataFrame(
        [(None, "b", "y"), ("1", "dup", "x"), ("1", "a", "x"), ("1", "a", None), ("2", None, "x"), ("2", "a", "a")], SCHEMA
    )
    assert bag(ops.clean_dump(df, ID)) == Counter([("1", "a", None), ("2", None, "x")])
    assert bag(ops.drop_null_keys(df, ID)).total() == 5
    assert bag(ops.duplicate_keys(df, ID)) == Counter([("1", 3), ("2", 2)])
    assert bag(ops.key_quality(df, ID)) == Counter([(6, 1, 2)])


def test_key_quality_of_nothing_and_of_key_pairs(spark):
    assert bag(ops.key_quality(spark.createDataFrame([], SCHEMA), ID)) == Counter([(0, 0, 0)])
    pairs = spark.createDataFrame([(1, None), (1, None), (None, 2), (1, 1), (1, 1), (2, 1)], "a int, b int")
    assert bag(ops.key_quality(pairs, TableSpec(("a", "b")))) == Counter([(6, 3, 1)])
    assert bag(ops.drop_null_keys(pairs, TableSpec(("a", "b")))).total() == 3


def test_dedupe_copes_with_maps_and_key_only_tables(spark):
    maps = spark.sql("select 1 as id, map('b', 2) as m union all select 1, map('a', 1)")
    assert ops.dedupe_by_key(maps, ID).collect()[0]["m"] == {"a": 1}
    assert bag(ops.dedupe_by_key(spark.createDataFrame([(1,), (1,)], "id int"), ID)) == Counter([(1,)])


def test_group_count(spark):
    df = spark.createDataFrame([("1", "a", "y"), ("2", "b", None), ("3", "c", "x"), ("4", "d", "x")], SCHEMA)
    assert [tuple(r) for r in ops.group_count(df, "city").collect()] == [("x", 2), (None, 1), ("y", 1)]
    assert [tuple(r) for r in ops.group_count(df, "CITY", 1).collect()] == [("x", 2)]
    by = (F.col("id") > "2").alias("late")
    assert [tuple(r) for r in ops.group_count(df, [by, "city"], None).collect()][0] == (True, "x", 2)
    with pytest.raises(MissingColumnError):
        ops.group_count(df, "nope")


def test_preview(spark):
    df = spark.range(100)
    assert ops.preview(df, 5).count() == 5
    assert [r[0] for r in ops.preview(df, 3, by=["id"]).collect()] == [0, 1, 2]


def test_align_union(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    assert bag(ops.align_union(a, b, a)) == Counter({(1, "x", None): 2, (2, None, "y"): 1})
