"""Buckets of anchor hashes are even, though an anchor is the least of many hashes."""

import numpy as np

from daybook.llm import substrings


def test_buckets_of_least_hashes_are_even():
    drawn = np.random.default_rng(4).integers(0, 1 << 64, (40000, 68), dtype=np.uint64)
    found = np.bincount(substrings._buckets(drawn.min(axis=1), 29).astype(np.int64), minlength=29)
    assert found.max() < 1.3 * found.mean()
