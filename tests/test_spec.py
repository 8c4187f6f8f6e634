from datetime import date, datetime

import pytest

from daybook import MissingColumnError, TableSpec, UncomparableColumnError
from daybook.functions.days import parse_day
from daybook.functions.names import find_column, require_columns, require_comparable


def test_spec_takes_one_name_or_many():
    assert TableSpec("id").keys == ("id",)
    assert TableSpec(["a", "b"], compared="c") == TableSpec(("a", "b"), ("c",))


@pytest.mark.parametrize(
    "args", [{"keys": ()}, {"keys": ("a", "a")}, {"keys": "op"}, {"keys": "a", "compared": "day"}, {"keys": "a", "op": "day"}]
)
def test_spec_refuses_nonsense(args):
    with pytest.raises(ValueError):
        TableSpec(**args)


def test_days():
    assert parse_day("2025-01-02") == parse_day(date(2025, 1, 2)) == date(2025, 1, 2)


@pytest.mark.parametrize("bad", ["garbage", "20250102", "2025-1-2", "2025-02-30", "2025-W01-1", datetime(2025, 1, 2), None, 5])
def test_malformed_days(bad):
    with pytest.raises(ValueError):
        parse_day(bad)


def test_columns_follow_sparks_case_rule(spark, conf):
    df = spark.createDataFrame([(1, 2)], "Id int, `a.b` int")
    assert find_column(df, "ID") == "Id" and find_column(df, "a.b") == "a.b"
    conf({"spark.sql.caseSensitive": "true"})
    assert find_column(df, "ID") is None
    with pytest.raises(MissingColumnError, match="ID"):
        require_columns(df, ["ID"], "the frame")


def test_uncomparable_columns_are_named(spark):
    df = spark.sql("select 1 as a, map('x', 1) as m, array(map(1, 2)) as deep")
    require_comparable(df, ["a"], "test")
    with pytest.raises(UncomparableColumnError, match="m.*deep"):
        require_comparable(df, ["a", "m", "deep"], "test")
