"""The flow against enumeration and at size; resharding of rows without ids, and op1's own result."""

import random
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from daybook.llm import sharding
from daybook.llm.queries import N_SHARDS, QUERIES

SF = Path("/root/testdata/sf0.001")


def cheapest_by_trying(old, capacity, cost):
    """Byte by byte over all states; for very small cases."""
    states = {tuple(sorted(capacity.items())): 0}
    for i, n in old.items():
        for _ in range(n):
            following = {}
            for room, total in states.items():
                for j, free in room:
                    if free:
                        key = tuple(sorted((dict(room) | {j: free - 1}).items()))
                        following[key] = min(following.get(key, 1 << 60), total + cost(i, j))
            states = following
    return min(states.values())


def check(transfers, old, capacity):
    given, taken = Counter(), Counter()
    for t in transfers:
        assert t.size > 0
        given[t.old] += t.size
        taken[t.new] += t.size
    assert all(given[i] == n for i, n in old.items())
    assert all(taken[j] <= n for j, n in capacity.items())


def test_flow_is_the_cheapest():
    rng = random.Random(4)
    for n in range(120):
        old = {i: rng.randint(0, 4) for i in range(rng.randint(1, 3))}
        capacity = {j: rng.randint(0, 5) for j in range(rng.randint(1, 4))}
        capacity[0] += max(0, sum(old.values()) - sum(capacity.values()))
        prices = {(i, j): rng.randint(0, 5) for i in old for j in capacity}
        cost = None if n % 2 else lambda i, j: prices[i, j]
        found = sharding.cheapest_transfers(old, capacity, cost)
        check(found, old, capacity)
        price = cost or (lambda i, j: int(i != j))
        assert sum(t.size * price(t.old, t.new) for t in found) == cheapest_by_trying(old, capacity, price)


def test_thousands_of_shards_take_seconds():
    rng = random.Random(5)
    old = {i: rng.randint(1 << 30, 1 << 40) for i in range(2000)}
    total = sum(old.values())
    capacity = {j: total // 2600 + (j < total % 2600) for j in range(2600)}
    start = time.perf_counter()
    found = sharding.cheapest_transfers(old, capacity)
    assert time.perf_counter() - start < 60
    check(found, old, capacity)
    assert sum(t.size for t in found if t.old == t.new) == sum(min(n, capacity[i]) for i, n in old.items())


def test_no_room_and_negative_costs_are_refused():
    with pytest.raises(ValueError):
        sharding.cheapest_transfers({0: 5}, {0: 4})
    with pytest.raises(ValueError):
        sharding.cheapest_transfers({0: 5}, {0: 9}, lambda i, j: -1)


@pytest.mark.parametrize("text", ["same text", None, "own"])
def test_rows_without_ids_and_equal_rows_are_dealt_one_by_one(spark, text):
    rows = [(None if i % 2 else i, f"{text} {i}" if text == "own" else text, i % 3) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, old_shard int").repartition(4)
    placed, _ = sharding.reshard(docs, "old_shard", 8)
    held, slots = Counter(), defaultdict(list)
    found = placed.collect()
    for r in found:
        held[r.shard] += len((r.text or "").encode()) + 8
        slots[r.shard].append(r.slot)
    assert Counter((r.doc_id, r.text, r.old_shard) for r in found) == Counter(rows)
    assert max(held.values()) - min(held.values()) <= 20 and len(held) == 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_query_holds_its_contract(spark):
    found = QUERIES["op1_reshard"](spark, str(SF)).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert Counter(r.doc_id for r in found) == Counter(texts.keys())
    held, slots = Counter(), defaultdict(list)
    for r in found:
        assert r.size == len(texts[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < N_SHARDS
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in found)
    assert max(held.values()) - min(held.values()) <= largest
