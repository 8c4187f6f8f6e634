"""Folders for intermediate tables, in the place all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_given_out: ContextVar[list[str] | None] = ContextVar("_given_out", default=None)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop, so any file system Spark can write to will do."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session ended before, and with it the way to the folder
        remove_folder(spark, path)


@cache
def _own_folder(spark: SparkSession) -> str:
    path = tempfile.mkdtemp(prefix="daybook-")
    atexit.register(_remove_at_exit, spark, path)
    return path


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, removed when the program ends.

    Only a local session without that setting gets a folder of its own machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _own_folder(spark)
    path = f"{shared.rstrip('/')}/daybook-{uuid.uuid4().hex}"
    atexit.register(_remove_at_exit, spark, path)
    within = _given_out.get()
    if within is not None:
        within.append(path)
    return path


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch folders given out inside are removed at the end, not when the program ends.

    For a step whose result is a table written before the end, in a folder from outside.
    """
    paths: list[str] = []
    token = _given_out.set(paths)
    try:
        yield
    finally:
        _given_out.reset(token)
        for path in paths:
            remove_folder(spark, path)


def saved(df: DataFrame, path: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` and read it back: what follows neither repeats nor varies its work.

    Values that differ between runs of a task, such as running numbers, are fixed
    by the write. Its shuffle files go at once: nothing reads them again.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path, compression=compression)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
