"""Snapshots laid out by key, so that comparing two of them shuffles neither.

Spark keeps bucket information in its catalog only. The files carry their bucket
number in their names, so a short-lived table entry over the directory is enough
to write or read them; it is dropped at once and the files stay.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.names import cols, is_comparable, quoted, spare_name

#: Spark ends the name of a bucket's file with the bucket's number.
_BUCKET = r"_(\d{5,})(?:\.c\d+)?\.[^/]*parquet$"


@contextmanager
def _table_name(spark: SparkSession) -> Iterator[str]:
    name = f"daybook_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _shuffle_width(spark: SparkSession) -> int:
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def keeps_buckets(spark: SparkSession, buckets: int) -> bool:
    """Whether each task of a shuffle by key holds whole buckets."""
    return _shuffle_width(spark) % buckets == 0


def write_bucketed(
    df: DataFrame,
    path: str,
    keys: list[str],
    buckets: int,
    *,
    max_rows_per_file: int | None = None,
) -> None:
    """Write to a directory that does not exist yet, in buckets by key.

    Expects ``df`` to come out of a shuffle by these keys, as a cleaned dump does.
    If the session's shuffle width is a multiple of the bucket count, each task
    already holds whole buckets and nothing moves again.
    """
    spark = df.sparkSession
    if not keeps_buckets(spark, buckets):
        df = df.repartition(buckets, *cols(keys))
    writer = df.write.bucketBy(buckets, *keys).option("path", path).mode("overwrite")
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    with _table_name(spark) as name:
        writer.saveAsTable(name, format="parquet")


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int
) -> DataFrame:
    """A directory written by :func:`write_bucketed`."""
    with _table_name(spark) as name:
        spark.sql(
            f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet "
            f"CLUSTERED BY ({', '.join(quoted(k) for k in keys)}) INTO {buckets} BUCKETS "
            f"LOCATION '{_literal(path)}'"
        )
        return spark.table(name)


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def bucket_of(path: str) -> int | None:
    """The bucket a file belongs to; None for files that are not of one."""
    found = re.search(_BUCKET, path)
    return found and int(found[1])


def digests_by_bucket(rows: DataFrame) -> dict[int, str] | None:
    """Per bucket its number of rows and two sums of 64-bit hashes over them, whatever their order.

    ``rows`` is read straight from a bucketed directory. Nulls enter by their place, as
    hashes alone pass over them. None if a column is nested, where they could not, or of
    a type without equality.
    """
    nested = (T.ArrayType, T.StructType)
    if any(isinstance(f.dataType, nested) or not is_comparable(f.dataType) for f in rows.schema.fields):
        return None
    image = cols(rows.columns)
    nulls = [c.isNull() for c in image]
    names = [spare_name(n, rows) for n in ("_bucket", "_first", "_second")]
    bucket = F.regexp_extract(F.input_file_name(), _BUCKET, 1).cast("int").alias(names[0])
    hashes = [F.xxhash64(F.lit(k), *image, *nulls).cast("decimal(20,0)").alias(n) for k, n in enumerate(names[1:])]
    sums = rows.select(bucket, *hashes).groupBy(names[0]).agg(
        F.count(F.lit(1)).alias("n"), F.sum(names[1]).alias("first"), F.sum(names[2]).alias("second")
    )
    # A row per bucket.
    return {r[names[0]]: f"{r['n']} {r['first']} {r['second']}" for r in sums.collect()}
