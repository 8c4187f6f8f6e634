"""What the operators of this package share.

Every operator first picks the columns it needs under names of its own, so further
columns, whatever they are called, neither disturb it nor get lost: with
``keep_rows=True`` the whole input row comes along in the struct column ``row``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.names import col, cols

#: ASCII white space, as a character class body: what separates words.
SPACE = r"\x20\x09-\x0D"
HELD_OUT_FOLDS = 5


def picked(docs: DataFrame, keep_rows: bool = False, **columns: str) -> DataFrame:
    """The named columns under the operator's names; with ``keep_rows`` also the row."""
    chosen = [col(name).alias(alias) for alias, name in columns.items()]
    if keep_rows:
        chosen.append(F.struct(*cols(docs.columns)).alias("row"))
    return docs.select(*chosen)


def rows_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """The input rows that came along, in their own columns."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def order_hash(*columns: Column, seed: int) -> Column:
    """A seeded number from 0 to 2^63 - 1 that orders rows alike on every run."""
    return F.xxhash64(*columns, F.lit(seed)).bitwiseAND(F.lit((1 << 63) - 1))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn labels from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == 0, F.lit(False))


def utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def schema_with(df: DataFrame, without: str, *new: tuple[str, T.DataType]) -> T.StructType:
    """The frame's schema less one column, plus new ones: what a batch function returns."""
    kept = [f for f in df.schema.fields if f.name != without]
    return T.StructType([*kept, *(T.StructField(n, t) for n, t in new)])


def batch_with(batch: pa.RecordBatch, without: str, **new: pa.Array) -> pa.RecordBatch:
    """The batch less one column, plus new ones."""
    kept = [n for n in batch.schema.names if n != without]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *new.values()], [*kept, *new])
