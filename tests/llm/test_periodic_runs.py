"""Runs by maximal pairs against trying every period at every place."""

import hashlib
import random

import numpy as np
import pytest

from daybook.llm import periodic_runs
from daybook.llm.periodic_runs import collapse_runs, collapsed, strongest, suffix_order, word_runs


def plain_runs(words, min_length=6, exponent=4):
    """Each stretch with a period, by the shortest period of its span."""
    spans = {}
    for period in range(1, len(words) // exponent + 1):
        i = 0
        while i + period < len(words):
            end = i
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - i + period
            if end > i and length >= max(min_length, exponent * period):
                spans.setdefault((i, length), period)
            i = end + 1
    return sorted(((s, n, q) for (s, n), q in spans.items()), key=lambda r: (r[0], r[2]))


def odd_sequences(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        words = []
        while len(words) < rng.randint(0, 90):
            block = [rng.randint(0, rng.choice([1, 2, 5, 300])) for _ in range(rng.randint(1, 8))]
            words += block * rng.randint(1, 9) + block[: rng.randint(0, len(block))]
        yield words


@pytest.mark.parametrize(("min_length", "exponent"), [(6, 4), (2, 2), (5, 3), (12, 2), (9, 6), (3, 4)])
def test_runs_equal_plain_ones(min_length, exponent):
    for words in odd_sequences(min_length, 400):
        found = word_runs(np.array(words, dtype=np.int64), min_length, exponent)
        assert found == plain_runs(words, min_length, exponent), words


def test_suffixes_are_in_order():
    for words in odd_sequences(3, 200):
        if words:
            order, common = suffix_order(np.array(words))
            suffixes = [words[i:] for i in order]
            assert suffixes == sorted(suffixes)
            for a, b, n in zip(suffixes, suffixes[1:], common[1:]):
                assert a[:n] == b[:n] and (a[n : n + 1] != b[n : n + 1])


def test_long_runs_take_little():
    assert word_runs(np.zeros(40000, dtype=np.int64)) == [(0, 40000, 1)]
    block = np.arange(5000)
    assert word_runs(np.tile(block, 8)) == [(0, 40000, 5000)]
    assert word_runs(np.concatenate([np.arange(30000), np.tile([1, 2], 3000)])) == [(30000, 6000, 2)]


def test_the_strongest_is_compared_exactly():
    # 12/3 = 4, 13/3, and 26/6 as 13/3: the first of equals counts.
    assert strongest([(0, 12, 3), (20, 13, 3), (40, 26, 6)]) == (20, 13, 3)
    assert strongest([]) is None


def test_collapsed_keeps_first_periods():
    words = [b"x"] + [b"a", b"b"] * 4 + [b"a", b"y"]
    assert collapsed(words, [(1, 9, 2)]) == [b"x", b"a", b"b", b"y"]


def test_documents(spark, odd_docs, odd):
    rows = {}
    for r in collapse_runs(odd_docs).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sorted(map(str, rows)) == sorted({str(i) for i, *_ in odd})
    for i, text, _ in odd:
        words = (text or "").encode().split()
        runs = plain_runs(words) if len(words) < 5000 else None
        wanted = hashlib.sha256(b" ".join(collapsed(words, runs or []))).hexdigest()
        hits = [r for r in rows[i] if hashlib.sha256(r.collapsed.encode()).hexdigest() == wanted]
        assert hits and hits[0].n_words == len(words)
        assert runs is None or [tuple(x) for x in hits[0].runs] == runs
        assert (hits[0].strongest is None) == (not hits[0].runs)


def test_no_documents_and_refused_settings(no_docs):
    assert collapse_runs(no_docs).collect() == []
    with pytest.raises(ValueError):
        collapse_runs(no_docs, exponent=1)
    assert periodic_runs.word_runs(np.array([], dtype=np.int64)) == []
