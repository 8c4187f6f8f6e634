"""Session settings the plans are designed for. The caller owns the session.

Sizes stay with the caller: ``spark.sql.shuffle.partitions`` (or AQE's
``initialPartitionNum``) should leave a full dump at some hundred MB a partition;
AQE merges what turns out smaller.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Splitting of skewed join partitions and merging of small ones rest on it.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Where every partition of a join side turns out to fit this, Spark hashes
    # instead of sorting; beyond it the join sorts and spills as before.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
