"""Buckets that stay as they are from one day to the next are not read to compare the days."""

import pytest
from helpers import bag
from pyspark.sql import functions as F

from daybook import TableSpec, plans, sources
from daybook.plans import integrate
from daybook.sources.buckets import bucket_of, digests_by_bucket

ID = TableSpec("id")
DAYS = [f"2025-01-0{n}" for n in range(1, 7)]


@pytest.fixture
def compared(monkeypatch):
    """The files of both sides of every comparison."""
    seen = []
    real = integrate.change_set

    def change_set(old, new, *args, **kw):
        seen.append((old.inputFiles(), new.inputFiles()))
        return real(old, new, *args, **kw)

    monkeypatch.setattr(integrate, "change_set", change_set)
    return seen


def dumps(spark):
    rows = spark.range(600).select("id", F.col("id").cast("string").alias("v"), F.lit(None).cast("string").alias("w"))
    swapped = F.when(F.col("id") == 5, F.struct(F.col("w").alias("v"), F.col("v").alias("w"))).otherwise(F.struct("v", "w"))
    one = rows.select("id", swapped.alias("x")).select("id", "x.v", "x.w")
    less = one.where("id <> 9")
    return [rows, one, one, less, rows.withColumn("v", F.lit("z")), rows.withColumn("u", F.lit(1))]


def test_only_buckets_that_differ_are_read(spark, tmp_path, compared):
    store = sources.DumpStore(str(tmp_path / "with"), ID, 8, bucket_digests=True)
    plain = sources.DumpStore(str(tmp_path / "without"), ID)
    for day, dump in zip(DAYS, dumps(spark)):
        plans.integrate_day(spark, store, day, dump, keep_snapshots=6)
    files = compared[:]
    for day, dump in zip(DAYS, dumps(spark)):
        plans.integrate_day(spark, plain, day, dump, keep_snapshots=6)
    assert bag(store.change_log(spark)) == bag(plain.change_log(spark))
    figures = [c for c in plain.commits(spark).columns if c not in ("buckets", "bucket_digests")]
    assert bag(store.commits(spark), *figures) == bag(plain.commits(spark), *figures)
    # A value and a null that change places; a quiet day; a row gone; all rows; another column.
    buckets = [tuple({bucket_of(f) for f in side} for side in pair) for pair in files]
    assert [tuple(map(len, b)) for b in buckets[1:]] == [(1, 1), (0, 0), (1, 1), (8, 8), (8, 8)]
    assert buckets[1][0] == buckets[1][1]


def test_other_layouts_are_read_whole(spark, tmp_path, compared):
    rows = dumps(spark)[0]
    for n, day in ((4, DAYS[0]), (8, DAYS[1])):
        plans.integrate_day(spark, sources.DumpStore(str(tmp_path), ID, n, bucket_digests=True), day, rows)
    plans.integrate_day(spark, sources.DumpStore(str(tmp_path), ID, 8), DAYS[2], rows)
    plans.integrate_day(spark, sources.DumpStore(str(tmp_path), ID, 8, bucket_digests=True), DAYS[3], rows)
    assert [tuple(len({bucket_of(f) for f in side}) for side in pair) for pair in compared[1:]] == [(4, 8), (8, 8), (8, 8)]


def test_refused_and_unknown(spark, tmp_path):
    with pytest.raises(ValueError):
        sources.DumpStore(str(tmp_path), ID, bucket_digests=True)
    nested = spark.range(3).select("id", F.struct(F.lit(None).cast("int"), "id").alias("s"))
    assert digests_by_bucket(nested) is None
    assert bucket_of("file:/x/part-0-ab_00007.c000.snappy.parquet") == 7 and bucket_of("file:/x/_SUCCESS") is None
