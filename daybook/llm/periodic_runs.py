"""Periodic runs of words, by maximal pairs.

A run is a stretch of words that repeats itself: words ``period`` apart are equal, the
period is the smallest such, and neither neighbour goes on with it. Its first and its
second period start two equal stretches whose left neighbours differ and whose right
neighbours differ: a maximal pair, as far apart as the period and shorter than the run
by one period. So the maximal pairs whose distance is small against their length *are*
the runs, and nothing has to be extended; of pairs that span the same words the
closest gives the period.

Maximal pairs come out of the LCP-interval tree of a document's suffixes, walked bottom
up. Each node keeps the positions below it, all of them in order and also by the word to
their left. Where two children meet, the positions of the smaller one look, within the
longest distance allowed, for positions of the other one under a different left word;
then the smaller one's positions move over.

Stretches that cannot hold a run are set aside before: within a run every three words
in a row occur there twice.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from daybook.llm.common import batch_with, picked, schema_with

MIN_LENGTH = 6
MIN_EXPONENT = 4

_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_ARROW_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

#: All positions below a node in order, and by the word to their left.
Node = tuple[list[int], dict[int, list[int]]]


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the common prefix of each with the one before it (0 for the first)."""
    n = len(ids)
    ranks = [np.unique(ids, return_inverse=True)[1]]
    width = 1
    while ranks[-1].max() < n - 1:
        after = np.zeros(n, dtype=np.int64)
        after[: n - width] = ranks[-1][width:] + 1
        ranks.append(np.unique(ranks[-1] * (n + 1) + after, return_inverse=True)[1])
        width *= 2
    order = np.argsort(ranks[-1])
    x, y = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        # Equal ranks mean equal words over the whole width: suffixes that end sooner rank apart.
        of_x, of_y = np.append(ranks[level], -1)[x], np.append(ranks[level], -2)[y]
        step = (of_x == of_y).astype(np.int64) << level
        common += step
        x, y = x + step, y + step
    return order, np.concatenate(([0], common))


def stretches(ids: np.ndarray, gram: int, min_length: int) -> Iterator[tuple[int, int]]:
    """From and to (exclusive) of what is left once words in no repeated gram are set aside, again and again."""
    todo = [(0, len(ids))]
    while todo:
        lo, hi = todo.pop()
        n = hi - lo - gram + 1
        if hi - lo < min_length or n < 1:
            continue
        part = ids[lo:hi]
        key = np.unique(part, return_inverse=True)[1] if gram > 1 else part
        base = int(key.max()) + 1
        code = key[:n]
        for k in range(1, gram):
            code = code * base + key[k : n + k]
        _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], counts[inverse] > 1, [0]))))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if (a, b) == (0, n):
                yield lo, hi
            else:
                todo.append((lo + a, lo + b + gram - 1))


def _meet(a: Node, b: Node, depth: int, left: list[int], runs: dict, min_length: int, exponent: int) -> Node:
    """Report the close pairs between two children of a node ``depth`` words deep, and merge them."""
    if len(a[0]) < len(b[0]):
        a, b = b, a
    everywhere, by_left = a
    nearest, farthest = max(1, min_length - depth), depth // (exponent - 1)
    if nearest <= farthest:
        for p in b[0]:
            word = left[p]
            lo, hi = bisect_left(everywhere, p - farthest), bisect_right(everywhere, p + farthest)
            if lo == hi:
                continue
            if hi - lo <= len(by_left):
                near = [q for q in everywhere[lo:hi] if left[q] != word]
            else:
                near = []
                for other, places in by_left.items():
                    if other != word:
                        near += places[bisect_left(places, p - farthest) : bisect_right(places, p + farthest)]
            for q in near:
                period = abs(p - q)
                if period >= nearest:
                    span = (min(p, q), depth + period)
                    if runs.get(span, period) >= period:
                        runs[span] = period
    for word, places in b[1].items():
        own = by_left.setdefault(word, [])
        for p in places:
            insort(own, p)
            insort(everywhere, p)
    return a


def _pairs_of(order: list[int], common: list[int], left: list[int], runs: dict, min_length: int, exponent: int):
    """Walk one subtree bottom up: suffixes in order, each with its common prefix with the one before."""
    leaf = lambda p: ([p], {left[p]: [p]})
    open_: list[list] = []
    node = leaf(order[0])
    for p, depth in zip(order[1:], common[1:]):
        while open_ and open_[-1][0] > depth:
            deeper, earlier = open_.pop()
            node = _meet(earlier, node, deeper, left, runs, min_length, exponent)
        if open_ and open_[-1][0] == depth:
            open_[-1][1] = _meet(open_[-1][1], node, depth, left, runs, min_length, exponent)
        else:
            open_.append([depth, node])
        node = leaf(p)
    while open_:
        deeper, earlier = open_.pop()
        node = _meet(earlier, node, deeper, left, runs, min_length, exponent)


def word_runs(
    ids: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT
) -> list[tuple[int, int, int]]:
    """All runs ``start, length, period`` of a sequence of word numbers, by start, then period."""
    # In a run of three periods and four words every three words in a row occur twice.
    gram = 3 if exponent >= 3 and min_length >= 4 else 1
    # Pairs shorter than this have no distance that would do.
    shallow = min(max((exponent - 1) * d, min_length - d) for d in range(1, min_length + 1))
    runs: dict[tuple[int, int], int] = {}
    for lo, hi in stretches(ids, gram, min_length):
        part = ids[lo:hi]
        left = [int(ids[lo - 1]) if lo else -1, *part[:-1].tolist()]
        order, common = suffix_order(part)
        found: dict[tuple[int, int], int] = {}
        deep = np.flatnonzero(np.diff(np.concatenate(([0], common >= shallow, [0]))))
        for a, b in zip(deep[::2].tolist(), deep[1::2].tolist()):
            _pairs_of(order[a - 1 : b].tolist(), common[a - 1 : b].tolist(), left, found, min_length, exponent)
        runs |= {(lo + start, length): period for (start, length), period in found.items()}
    return sorted(((s, n, q) for (s, n), q in runs.items()), key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods, exactly; ties: the first, then the shortest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without what a run repeats: all that some run has after its first period."""
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [w for w, inside in zip(words, np.cumsum(edges[:-1]).tolist()) if not inside]


def _numbers(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))


def collapse_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, strongest, collapsed``.

    ``runs`` holds ``start, length, period`` of every run of at least ``min_length``
    words and ``exponent`` (2 or more) periods, by start, then period; ``strongest`` is
    the one with most periods, null without runs; ``collapsed`` are the words left,
    joined by a space. Words are what ASCII white space parts, numbered from 0. A null
    or empty text has none: no runs, and an empty ``collapsed``. Null and repeated ids
    change nothing; an empty table gives no rows. A task holds a batch of documents.
    """
    if exponent < 2 or min_length < 2:
        raise ValueError("a run has two words and two periods at least")
    source = picked(docs, doc_id=id_col, text=text_col)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, all_runs, best, rest = [], [], [], []
            for text in batch.column("text").to_pylist():
                # split() on bytes without argument splits at ASCII white space alone.
                words = (text or "").encode("utf-8", "surrogatepass").split()
                runs = word_runs(_numbers(words), min_length, exponent) if len(words) >= min_length else []
                n_words.append(len(words))
                all_runs.append([dict(zip(_RUN.names, r)) for r in runs])
                best.append(dict(zip(_RUN.names, strongest(runs))) if runs else None)
                rest.append(b" ".join(collapsed(words, runs) if runs else words))
            yield batch_with(
                batch,
                "text",
                n_words=pa.array(n_words, pa.int64()),
                runs=pa.array(all_runs, pa.list_(_ARROW_RUN)),
                strongest=pa.array(best, _ARROW_RUN),
                collapsed=pa.array(rest, pa.binary()).cast(pa.string()),
            )

    schema = schema_with(
        source,
        "text",
        ("n_words", T.LongType()),
        ("runs", T.ArrayType(_RUN)),
        ("strongest", _RUN),
        ("collapsed", T.StringType()),
    )
    return source.mapInArrow(found, schema)
