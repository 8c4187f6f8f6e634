"""Bringing frames with drifting columns together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.names import col, same_name


def align_union(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def align_snapshots(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both snapshots with the newer side's spelling, types and columns.

    A column only the newer side has becomes null on the older side. A column
    only the older side has stays there alone. Shared columns whose types differ
    are cast to the type Spark would give their union.
    """
    spelling = {o: n for n in new.columns for o in old.columns if same_name(new, n, o)}
    old = old.select(*[col(c).alias(spelling.get(c, c)) for c in old.columns])
    fresh = [F.lit(None).cast(new.schema[c].dataType).alias(c) for c in new.columns if c not in old.columns]
    old = old.select("*", *fresh)

    # Analysis only: asks Spark for the common types, reads nothing.
    both = new.unionByName(old, allowMissingColumns=True).schema
    return cast_to(old, both), cast_to(new, both)


def cast_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """The frame with the columns ``target`` names cast to its types."""
    wrong = {c for c in target.names if c in df.columns and df.schema[c].dataType != target[c].dataType}
    if not wrong:
        return df
    return df.select(
        *[col(c).cast(target[c].dataType).alias(c) if c in wrong else col(c) for c in df.columns]
    )
