"""Join helpers that keep a hot key from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.names import col, cols, spare_name

_BLOCK = 1 << 16


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join ``rows`` with a frame that holds one row per key.

    ``per_key`` comes out of a ``groupBy`` on the same keys, so Spark would reuse
    that layout and sort it in place. AQE only splits a skewed partition when both
    join inputs come straight from a shuffle; joining on a hash of the key as well
    makes Spark exchange the (narrow, one row per key) right side again, and a key
    or a null group holding much of ``rows`` is then cut into several tasks.
    """
    kept = rows.columns
    if how not in ("left_semi", "left_anti"):
        kept = kept + [c for c in per_key.columns if c not in keys]
    key_hash = spare_name("_key_hash", rows, per_key)
    left = rows.withColumn(key_hash, F.xxhash64(*cols(keys)))
    right = per_key.withColumn(key_hash, F.xxhash64(*cols(keys)))
    return left.join(right, [*keys, key_hash], how).select(*cols(kept))


def repeat_rows(df: DataFrame, times: Column) -> DataFrame:
    """Each row ``times`` times.

    A row wanted very often becomes blocks first, and the blocks are dealt out
    over all tasks before they unfold, so no task and no array gets it whole.
    """
    kept = df.columns
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted, block, size, nth = (spare_name(n, df) for n in ("_times", "_block", "_size", "_nth"))
    first, step = F.lit(0).cast("long"), F.lit(_BLOCK).cast("long")
    last = F.floor((col(wanted) - 1) / step)
    blocks = (
        df.withColumn(wanted, times.cast("long"))
        .withColumn(block, F.explode(F.sequence(first, last)))
        .select(*cols(kept), F.least(step, col(wanted) - col(block) * step).alias(size))
    )
    numbers = F.sequence(F.lit(1).cast("long"), col(size))
    unfolded = blocks.repartition(width).withColumn(nth, F.explode(numbers))
    return unfolded.select(*cols(kept))
