"""Minimum bin slack against enumeration, and packed documents against the tokenizer's own ids."""

import random
import zlib
from array import array
from collections import Counter, defaultdict
from itertools import combinations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daybook.llm import bin_slack

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_closest_fill_equals_enumeration():
    rng = random.Random(1)
    for _ in range(300):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(0, 8))]
        goal = rng.randint(0, 60)
        counts = Counter(lengths)
        chosen = bin_slack.closest_fill(counts, sorted(counts, reverse=True), goal)
        assert all(0 < times <= counts[n] for n, times in chosen.items())
        sums = {sum(c) for k in range(len(lengths) + 1) for c in combinations(lengths, k)}
        assert sum(n * times for n, times in chosen.items()) == max(s for s in sums if s <= goal)


@pytest.mark.parametrize("capacity", [64, 60])
def test_windows_hold_every_id_once(capacity):
    rng = random.Random(2)
    kinds = [lambda: rng.randint(1, capacity), lambda: capacity // 2 + 1, lambda: rng.choice([1, 2, 33, capacity])]
    for _ in range(200):
        kind = rng.choice(kinds)
        lengths = [kind() for _ in range(rng.randint(0, 60))]
        windows = list(bin_slack.Windows(capacity, lengths).pack())
        seen = defaultdict(list)
        for window in windows:
            for n, key, start in window:
                seen[key].append((start, n))
        for key, length in enumerate(lengths):
            at = 0
            for start, n in sorted(seen[key]):
                assert start == at
                at += n
            assert at == length
        sums = [sum(n for n, *_ in w) for w in windows]
        assert all(0 < s <= capacity for s in sums)
        if capacity == 64:
            assert all(s & (s - 1) == 0 for s in sums)
            assert sum(s < capacity for s in sums) <= 6


def test_whole_documents_that_fit_stay_whole():
    windows = list(bin_slack.Windows(64, [40, 24, 30, 34, 64, 1, 63]).pack())
    assert sorted(sorted(n for n, *_ in w) for w in windows) == [[1, 63], [24, 40], [30, 34], [64]]


def test_words_give_the_ids_of_the_text():
    tokenizer = Tokenizer.from_file(PATH)
    ids_of = bin_slack.WordIds(PATH)
    rng = random.Random(3)
    marks = ["a", "It's", "'LL", "é", "é", "́", " ", "  ", "\t\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "ß", "İ", "Σ"]
    marks += ["12", "漢字", "<|endoftext|>", "<|", "…", "\x00", "ﬁ", "​", "x" * 80, "!?", "ͅ"]
    for _ in range(3000):
        text = "".join(rng.choice(marks) for _ in range(rng.randint(0, 12)))
        assert list(array("I", ids_of(text))) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    plain = [chr(c) for c in range(0x21, 0x180)]
    letters = [c for c in plain if c.isalpha()]
    for n in range(20000):
        pool = (plain, letters, letters[:52], letters[26:52])[n % 4]
        word = "".join(rng.choice(pool) for _ in range(rng.randint(1, 25)))
        assert list(array("I", ids_of(word))) == tokenizer.encode(word, add_special_tokens=False).ids, repr(word)


@pytest.mark.parametrize("capacity", [4096, 64])
def test_documents_come_back_from_their_sequences(odd_docs, odd, capacity):
    packed = bin_slack.pack_documents(odd_docs, PATH, capacity, keep_ids=True).collect()
    tokenizer = Tokenizer.from_file(PATH)
    ids = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in odd]
    expected, found, once = Counter(), Counter(), {i for i, n in Counter(i for i, *_ in odd).items() if n == 1}
    for i, whole in ids:
        expected[i] += len(whole)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in packed:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, array("I", bytes(r.ids)).tolist(), r.doc_tokens))
        found[r.doc_id] += r.length
    assert found == expected
    for i, whole in ids:
        if i in once:
            assert [x for _, piece, _ in sorted(pieces[i]) for x in piece] == whole
            assert {n for *_, n in pieces[i]} == {len(whole)}
    sizes = []
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        sizes.append(at)
    assert all(s <= capacity and s & (s - 1) == 0 for s in sizes)
    assert sum(s < capacity for s in sizes) <= capacity.bit_length()
