"""Parquet snapshots and change logs: reading and writing."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.days import parse_day
from daybook.functions.names import col, require_columns
from daybook.spec import TableSpec


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a given schema, known to be empty when the query is planned."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*columns).where(F.lit(False))


def read_parquet_if_any(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The Parquet directory under a known schema, or None if there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_snapshot(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A snapshot directory; an unreadable one is the caller's error to see."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def log_schema(columns: T.StructType, spec: TableSpec) -> T.StructType:
    """Change-log schema for a table: its columns, ``op`` and a ``day`` of type DATE."""
    own = [f for f in columns.fields if f.name not in (spec.op, spec.day)]
    return T.StructType(
        [*own, T.StructField(spec.op, T.StringType()), T.StructField(spec.day, T.DateType())]
    )


def read_change_log(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    *,
    schema: T.StructType | None = None,
    until: str | date | None = None,
) -> DataFrame:
    """The log up to a day; only the partitions of those days are read.

    Give ``schema`` (the table's columns) for a log that may hold no rows yet or
    whose columns changed over time: days without a column then read as null.
    A log that is not there is empty if its schema is known, else an error.
    """
    if schema is None:
        log = spark.read.parquet(path)
    else:
        full = log_schema(schema, spec)
        log = read_parquet_if_any(spark, path, full)
        if log is None:
            log = empty_frame(spark, full)
    if until is None:
        return log
    return log.where(col(spec.day) <= F.lit(parse_day(until)))


def _writer(
    df: DataFrame, num_files: int | None, max_rows_per_file: int | None
) -> DataFrameWriter:
    # A fixed file count shuffles instead of coalescing: coalesce would pull the
    # work before it into as few tasks.
    writer = (df if num_files is None else df.repartition(num_files)).write.mode("overwrite")
    return writer.option("maxRecordsPerFile", max_rows_per_file) if max_rows_per_file else writer


def write_snapshot(
    df: DataFrame, path: str, *, num_files: int | None = None, max_rows_per_file: int | None = None
) -> None:
    """Replace a snapshot directory. It must not be one that ``df`` reads."""
    _writer(df, num_files, max_rows_per_file).parquet(path)


def write_change_log(
    changes: DataFrame, path: str, spec: TableSpec, *, max_rows_per_file: int | None = None
) -> None:
    """Write change-log rows, replacing exactly the days they hold.

    Rows are rebalanced by day: small days come out as one file each, and a day
    with very many rows is split over several tasks.
    """
    require_columns(changes, [*spec.keys, spec.op, spec.day], "the change log")
    # The hint takes the column as text, so a name with a dot needs its ticks.
    balanced = changes.hint("rebalance", col(spec.day))
    writer = _writer(balanced, None, max_rows_per_file)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(spec.day).parquet(path)
