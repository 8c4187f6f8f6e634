"""Key checks and key clean-up of a dump."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from daybook.functions.names import col, cols, is_comparable, require_columns, require_comparable, spare_name
from daybook.functions.predicates import any_null, none_null
from daybook.spec import TableSpec


@dataclass(frozen=True)
class WatchedSpec(TableSpec):
    """The spec of a table whose keys are counted while a dump of it is cleaned.

    ``seen`` takes down, when the cleaned dump is written, the different keys (``keys``) and
    those that occurred more than once (``duplicate_keys``). It holds where one job takes the
    rows straight to its output; a shuffle after the cleaning may count a task twice.
    """

    seen: Observation | None = None


def watched(spec: TableSpec, seen: Observation) -> WatchedSpec:
    return WatchedSpec(spec.keys, spec.compared, spec.op, spec.day, seen)


def _keys(df: DataFrame, spec: TableSpec) -> list[str]:
    keys = require_columns(df, spec.keys, "the dump")
    require_comparable(df, keys, "key")
    return keys


def drop_null_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows whose key columns are all present."""
    return df.where(none_null(cols(_keys(df, spec))))


def duplicate_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    keys = _keys(df, spec)
    counts = df.where(none_null(cols(keys))).groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("count"))
    return counts.where(col("count") > 1)


def dedupe_by_key(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key: the smallest by the remaining columns in order, nulls first.

    The order is total, so every run and every re-computation keeps the same row.
    Spark cuts each task's rows to one per key before the shuffle, so a key with
    very many copies costs no more than any other. Rows whose key is null count as
    rows of one key; ``clean_dump`` drops them before.
    """
    numbered, nth = _numbered(df, spec)
    if isinstance(spec, WatchedSpec):
        # A key that occurs more than once has one second row; no third one is needed.
        figures = [F.count_if(col(nth) == i).alias(n) for i, n in ((1, "keys"), (2, "duplicate_keys"))]
        numbered = numbered.where(col(nth) <= 2).observe(spec.seen, *figures)
    return numbered.where(col(nth) == 1).drop(nth)


def _numbered(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, str]:
    """The rows of each key numbered from the smallest on, and the number's column."""
    keys = _keys(df, spec)
    rest = [_sortable(df, c).asc_nulls_first() for c in df.columns if c not in keys]
    smallest_first = Window.partitionBy(*cols(keys)).orderBy(*(rest or cols(keys)))
    nth = spare_name("_nth", df)
    return df.withColumn(nth, F.row_number().over(smallest_first)), nth


def _sortable(df: DataFrame, name: str) -> Column:
    if is_comparable(df.schema[name].dataType):
        return col(name)
    return F.to_json(F.struct(col(name)))


def clean_dump(df: DataFrame, spec: TableSpec) -> DataFrame:
    """A dump fit for comparison: no null keys, one row per key."""
    return dedupe_by_key(drop_null_keys(df, spec), spec)


def key_quality(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: total rows, rows with a null key, keys that occur more than once.

    One pass over the key columns; rows are counted per key before the shuffle.
    """
    keys = _keys(df, spec)
    n = spare_name("_n", df)
    per_key = df.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias(n))
    null_key = any_null(cols(keys))
    zero = F.lit(0).cast("long")
    return per_key.agg(
        F.coalesce(F.sum(col(n)), zero).alias("total_rows"),
        F.coalesce(F.sum(F.when(null_key, col(n))), zero).alias("null_keys"),
        F.count_if(~null_key & (col(n) > 1)).alias("duplicate_keys"),
    )
