from collections import Counter
from datetime import date

import pytest
from helpers import bag
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from daybook import MissingColumnError, TableSpec
from daybook import operators as ops
from daybook import sources

ID = TableSpec("id")
SCHEMA = "id string, name string, city string"


def _csv(tmp_path, text, name="dump.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_csv_blank_and_quoted_empty_keys_read_as_null(spark, tmp_path):
    path = _csv(tmp_path, 'id,name,city\n1,a,x\n,b,y\n"",c,z\n 2,d,x\n2,"e,f",\n')
    df = sources.read_csv_dump(spark, path, SCHEMA)
    assert bag(df) == Counter(
        [("1", "a", "x"), (None, "b", "y"), (None, "c", "z"), (" 2", "d", "x"), ("2", "e,f", None)]
    )
    assert bag(ops.key_quality(df, ID)) == Counter([(5, 2, 0)])
    assert sorted(r["id"] for r in ops.clean_dump(df, ID).collect()) == [" 2", "1", "2"]


def test_csv_header_in_another_order_is_an_error(spark, tmp_path):
    path = _csv(tmp_path, "name,id,city\na,1,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_csv_dump(spark, path, SCHEMA).collect()
    by_position = sources.read_csv_dump(spark, path, SCHEMA, check_header=False)
    assert bag(by_position) == Counter([("a", "1", "x")])


def test_csv_header_is_checked_for_narrow_reads_too(spark, tmp_path):
    path = _csv(tmp_path, "name,id,city\na,1,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        ops.key_quality(sources.read_csv_dump(spark, path, SCHEMA), ID).collect()


def test_csv_short_and_long_lines(spark, tmp_path):
    path = _csv(tmp_path, "id,name,city\n1,a\n2,b,y,extra\n3,c,z\n")
    assert bag(sources.read_csv_dump(spark, path, SCHEMA)) == Counter(
        [("1", "a", None), ("2", "b", "y"), ("3", "c", "z")]
    )
    marked = sources.read_csv_dump(spark, path, SCHEMA, malformed_column="bad_line")
    assert bag(marked, "id", "bad_line") == Counter([("1", "1,a"), ("2", "2,b,y,extra"), ("3", None)])


def test_csv_options_pass_through(spark, tmp_path):
    path = _csv(tmp_path, "id;name;city\n1;a;NA\n")
    df = sources.read_csv_dump(spark, path, SCHEMA, sep=";", nullValue="NA")
    assert bag(df) == Counter([("1", "a", None)])


def _log(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, op string, day date")


def test_change_log_replaces_only_the_days_it_holds(spark, tmp_path):
    path, d1, d2 = str(tmp_path / "log"), date(2025, 1, 1), date(2025, 1, 2)
    sources.write_change_log(_log(spark, [(1, "a", "I", d1), (2, "b", "I", d2)]), path, ID)
    sources.write_change_log(_log(spark, [(3, "c", "I", d2)]), path, ID)
    log = sources.read_change_log(spark, path, ID)
    assert dict(log.dtypes)["day"] == "date"
    assert bag(log) == Counter([(1, "a", "I", d1), (3, "c", "I", d2)])
    assert bag(sources.read_change_log(spark, path, ID, until="2025-01-01"), "id") == Counter([(1,)])


def test_small_days_are_one_file_each(spark, tmp_path):
    rows = [(i, "v", "I", date(2025, 1, 1 + i % 3)) for i in range(300)]
    sources.write_change_log(_log(spark, rows).repartition(8), str(tmp_path / "log"), ID)
    assert [len(list(d.glob("*.parquet"))) for d in sorted((tmp_path / "log").glob("day=*"))] == [1, 1, 1]


def test_missing_log_is_empty_only_with_a_known_schema(spark, tmp_path):
    path = str(tmp_path / "nothing")
    schema = spark.createDataFrame([], SCHEMA).schema
    log = sources.read_change_log(spark, path, ID, schema=schema, until="2025-01-01")
    assert log.columns == ["id", "name", "city", "op", "day"] and log.isEmpty()
    with pytest.raises(AnalysisException):
        sources.read_change_log(spark, path, ID)
    with pytest.raises(ValueError):
        sources.read_change_log(spark, path, ID, schema=schema, until="garbage")


def test_log_columns_are_checked_on_writing(spark, tmp_path):
    with pytest.raises(MissingColumnError):
        sources.write_change_log(_log(spark, []).drop("op"), str(tmp_path / "log"), ID)


def test_snapshot_files_and_empty_snapshot(spark, tmp_path):
    path = str(tmp_path / "snap")
    sources.write_snapshot(spark.range(100).repartition(7), path, num_files=2)
    assert len(list((tmp_path / "snap").glob("*.parquet"))) == 2
    sources.write_snapshot(spark.range(100).coalesce(1), path, max_rows_per_file=10)
    assert len(list((tmp_path / "snap").glob("*.parquet"))) == 10
    sources.write_snapshot(spark.range(0).select(F.col("id"), F.lit("x").alias("v")), path)
    back = sources.read_snapshot(spark, path)
    assert back.columns == ["id", "v"] and back.isEmpty()
    with pytest.raises(AnalysisException):
        sources.read_snapshot(spark, str(tmp_path / "nothing"))
