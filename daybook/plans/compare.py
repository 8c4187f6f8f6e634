"""Comparing two stored snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.errors import KeyQualityError
from daybook.operators.diff import change_set
from daybook.operators.quality import key_quality
from daybook.sources.tables import read_snapshot, write_snapshot
from daybook.spec import TableSpec


def diff_snapshots(
    spark: SparkSession,
    old_path: str,
    new_path: str,
    spec: TableSpec,
    *,
    strict: bool = False,
    output: str | None = None,
) -> DataFrame:
    """The change set between two Parquet snapshots, written to ``output`` if given.

    Looks at both sides' keys first (one narrow pass each). Clean keys take the
    single-join form; with null or repeated keys all rows take the form that counts.
    ``strict=True`` refuses both.
    """
    old, new = read_snapshot(spark, old_path), read_snapshot(spark, new_path)
    sides = {"older": old, "newer": new}
    figures = {name: key_quality(side, spec).first().asDict() for name, side in sides.items()}
    flawed = {n: f for n, f in figures.items() if f["null_keys"] or f["duplicate_keys"]}
    if flawed and strict:
        raise KeyQualityError(f"null or duplicate keys: {flawed}")
    changes = change_set(old, new, spec, keys_unique=not flawed, null_keys=bool(flawed))
    if output is None:
        return changes
    write_snapshot(changes.hint("rebalance"), output)
    return read_snapshot(spark, output, changes.schema)
