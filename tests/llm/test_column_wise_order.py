"""The order of all suffixes by rounds that sort few rows, against a plain sort."""

import random

import numpy as np

from daybook.llm import substrings


def _by_sorting(pieces):
    """Suffixes in order, the empty one after the symbol 0 that is before any byte; ties by piece."""
    return sorted((p[k:], i) for i, p in enumerate(pieces) for k in range(len(p) + 1))


def test_a_round_sorts_no_more_than_a_row_per_piece(monkeypatch):
    dealt = random.Random(7)
    alphabets = [b"ab", b"\xff\x00", bytes(range(256))]
    sort, sizes = np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda a, *p, **k: sizes.append(len(a)) or sort(a, *p, **k))
    for alphabet in alphabets:
        pieces = [bytes(dealt.choices(alphabet, k=dealt.choice([0, 3, 40, 300]))) for _ in range(12)]
        pieces += pieces[:3]
        sizes.clear()
        piece, size, common = substrings.column_wise_order(pieces)
        assert max(sizes) <= len(pieces)
        found = [(pieces[p][len(pieces[p]) - s :], p) for p, s in zip(piece.tolist(), size.tolist())]
        assert [t for t, _ in found] == [t for t, _ in _by_sorting(pieces)]
        assert sorted(found) == _by_sorting(pieces)
        for (a, _), (b, _), n in zip(found, found[1:], common[1:].tolist()):
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert n == same
