"""Rebuilding from folded months against the dumps themselves."""

import random
from collections import Counter
from datetime import date

import pytest
from helpers import bag, scan_metric

from daybook import TableSpec, plans, sources
from daybook.sources.store import DumpStore, month_end

ID = TableSpec("id")
DAYS = [date(2024, 12, 30), date(2024, 12, 31), date(2025, 1, 1), date(2025, 1, 9), date(2025, 1, 31), date(2025, 3, 2)]


def integrate(spark, store, seed=1):
    rng = random.Random(seed)
    dumps = {}
    for day in DAYS:
        dumps[day] = [(i, rng.choice("abc")) for i in range(12) if rng.random() < 0.6]
        plans.integrate_day(spark, store, day, spark.createDataFrame(dumps[day], "id int, v string"), keep_snapshots=2)
    return dumps


def test_every_day_with_folded_months(spark, tmp_path):
    store = sources.DumpStore(str(tmp_path), ID)
    dumps = integrate(spark, store)
    plain = plans.stored_snapshot_as_of(spark, store, DAYS[-1], from_log_only=True)
    before = scan_metric(plain, "numOutputRows")
    assert plans.fold_log(spark, store) == [date(2024, 12, 1), date(2025, 1, 1)]
    assert plans.fold_log(spark, store) == []
    for day, rows in dumps.items():
        for log_only in (False, True):
            got = plans.stored_snapshot_as_of(spark, store, day, from_log_only=log_only)
            assert bag(got) == Counter(rows), (day, log_only)
    # A day between two: what held at the end of January.
    assert bag(plans.stored_snapshot_as_of(spark, store, date(2025, 2, 10), from_log_only=True)) == Counter(dumps[DAYS[4]])
    after = scan_metric(plans.stored_snapshot_as_of(spark, store, DAYS[-1], from_log_only=True), "numOutputRows")
    assert after < before


def test_a_fold_that_dies_is_not_read(spark, tmp_path, monkeypatch):
    store = sources.DumpStore(str(tmp_path), ID)
    dumps = integrate(spark, store, 2)
    write = DumpStore.write_fold

    def dies(self, spark, month, rows):
        rows.limit(0).write.parquet(f"{self.root}/months/month={month.isoformat()}")
        raise RuntimeError("lost")

    monkeypatch.setattr(DumpStore, "write_fold", dies)
    with pytest.raises(RuntimeError):
        plans.fold_log(spark, store)
    assert bag(plans.stored_snapshot_as_of(spark, store, DAYS[-1], from_log_only=True)) == Counter(dumps[DAYS[-1]])
    monkeypatch.setattr(DumpStore, "write_fold", write)
    assert plans.fold_log(spark, store) == [date(2024, 12, 1), date(2025, 1, 1)]
    assert bag(plans.stored_snapshot_as_of(spark, store, DAYS[-1], from_log_only=True)) == Counter(dumps[DAYS[-1]])


def test_month_end():
    assert [month_end(date(y, m, 5)).day for y, m in ((2024, 2), (2025, 2), (2025, 12), (2025, 4))] == [29, 28, 31, 30]
