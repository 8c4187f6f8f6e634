"""Grouped row counts and short previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.names import col, cols, require_columns
from daybook.spec import DELETE, OPS, UPDATE, TableSpec


def group_count(
    df: DataFrame, by: str | Column | list[str | Column], n: int | None = None
) -> DataFrame:
    """Rows per group, largest first, ties by group; null is a group of its own.

    ``by`` takes column names and expressions. ``n`` asks for the largest groups only.
    """
    given = by if isinstance(by, list) else [by]
    parts = []
    for b in given:
        parts.append(col(require_columns(df, [b], "the report input")[0]) if isinstance(b, str) else b)
    return ranked_groups(df.groupBy(*parts).agg(F.count(F.lit(1)).alias("count")), n)


def ranked_groups(counts: DataFrame, n: int | None = None) -> DataFrame:
    """Groups and, last, their count in the order of a report."""
    groups = counts.columns[:-1]
    ranked = counts.orderBy(col("count").desc(), *[c.asc_nulls_first() for c in cols(groups)])
    return ranked if n is None else ranked.limit(n)


def group_changes(changes: DataFrame, older: DataFrame, by: list[str], spec: TableSpec) -> DataFrame:
    """By how many rows each group (``of``, its columns as given) grew or shrank (``change``).

    Groups that did neither are left out. For a change set between cleaned dumps, which have one row per key. Inserted and
    updated rows join their group, deleted ones leave theirs. The groups that updated rows
    were in before are not in the change set: the keys of these rows alone meet the key
    and group columns of ``older``.
    """
    (op,) = require_columns(changes, [spec.op], "the change set")
    now = group_of(require_columns(changes, by, "the change set"), by)
    was = group_of(require_columns(older, by, "the older snapshot"), by)
    keys = require_columns(older, spec.keys, "the older snapshot")
    steps = changes.where(col(op).isin(*OPS)).select(now, F.when(col(op) == DELETE, -1).otherwise(1).alias("step"))
    updated = changes.where(col(op) == UPDATE).select(*cols(require_columns(changes, spec.keys, "the change set")))
    left = older.join(updated.toDF(*keys), keys, "left_semi").select(was, F.lit(-1).alias("step"))
    net = steps.unionAll(left).groupBy("of").agg(F.sum("step").alias("change"))
    return net.where("change <> 0")


def group_of(names: list[str], by: list[str]) -> Column:
    """The columns of a group in one, ``of``, spelled as in ``by``."""
    return F.struct(*[col(n).alias(b) for n, b in zip(names, by)]).alias("of")


def preview(df: DataFrame, n: int, by: list[str] | None = None) -> DataFrame:
    """``n`` rows for a look: any rows, or the first ones in the order of ``by``."""
    if by:
        df = df.orderBy(*[c.asc_nulls_first() for c in cols(require_columns(df, by, "the preview input"))])
    return df.limit(n)
