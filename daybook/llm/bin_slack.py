"""Packing documents into sequences by minimum bin slack.

A document's ids and an end id become whole windows and a remainder. Tasks pack their
share of remainders window by window: the longest one left starts a window, and a
subset-sum over the lengths left, kept as a bitset with one bit per sum, tells which
choice of them comes closest to filling it; the choice is read back from the bitsets on
the way. A length counts as often as there are remainders of it.

Documents may be cut. Where no choice fills a window, the shortest document left that
is long enough is cut into powers of two, of which some fill any gap. What is left last
becomes sequences of a power of two, which need no padding. So nearly all documents stay
whole and nothing is padded, unless the capacity is no power of two: then a task's last
few sequences may have to be.

Only lengths and checksums are shuffled; a task holds about ``ITEMS_PER_TASK`` of them.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from daybook.llm.common import batch_with, picked, schema_with
from daybook.sources.scratch import saved, scratch_folder

CAPACITY = 4096
END_ID = 2
ITEMS_PER_TASK = 1 << 14

_ID_BYTES = 4
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: White space to ``str.split`` that does not part words.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

_PART = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")])
_ITEM = T.StructType(
    [*_PART.fields, T.StructField("doc_tokens", T.LongType()), T.StructField("parts", T.ArrayType(_PART))]
    + [T.StructField("ids", T.BinaryType())]
)


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others, in order, are the characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


def words_of(text: str) -> list[str]:
    """What ``_WORDS`` finds; by ``str.split``, which is quicker, where that parts words alike."""
    return _WORDS.findall(text) if _OTHER_SPACE.search(text) else text.split()


class WordIds(dict):
    """Ids of texts as little-endian unsigned 32-bit numbers; the dict keeps words met before.

    For vocabularies that drop white space: no token reaches over it, so the ids of a
    text are those of its words, one after the other. Words of plain Latin letters are
    split and merged by tiktoken, with a space for the vocabulary's end of a word; all
    others go to the tokenizer itself.
    """

    LIMIT = 1 << 19
    LONGEST = 64
    #: Characters whose lower case, kind and normal form no library sees differently.
    PLAIN = re.compile("[!-~\xa1-\xac\xae-\u012f\u0131-\u017e]+")
    #: What the vocabulary takes for a word, as its file says; a fixed value of it.
    PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    END = "</w>"

    def __init__(self, json_path: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(json_path)
        byte_of = _byte_of()
        ranks = {}
        with open(json_path, encoding="utf-8") as f:
            for token, rank in json.load(f)["model"]["vocab"].items():
                body = bytes(byte_of[c] for c in token.removesuffix(self.END))
                ranks[body + b" " if token.endswith(self.END) else body] = rank
        self.quick = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    def _ids(self, word: str) -> list[int]:
        if word.isascii() and word.isalpha():  # one run of letters to the pattern
            return self.quick.encode_ordinary(word.lower() + " ")
        if self.PLAIN.fullmatch(word) and "<|" not in word:
            return self.quick.encode_ordinary(" ".join(self.PATTERN.findall(word.lower())) + " ")
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def __missing__(self, word: str) -> bytes:
        found = array("I", self._ids(word)).tobytes()
        if len(word) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.clear()
            self[word] = found
        return found

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, words_of(text)))


@lru_cache(maxsize=2)
def _word_ids(json_path: str) -> WordIds:
    """One for all tasks of a worker."""
    return WordIds(json_path)


def powers(length: int) -> list[int]:
    """The powers of two that add up to a length, the greatest first."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


def closest_fill(counts: dict[int, int], lengths: list[int], goal: int) -> dict[int, int]:
    """How many of each length to take so that their sum comes closest to ``goal`` from below.

    Bit ``s`` of a bitset says that some choice of the lengths so far sums to ``s``; a
    length taken many times enters in multiples of 1, 2, 4, ... and the bitset before
    each entry is kept to read the choice back. Earlier lengths are preferred.
    """
    mask, sums = (1 << (goal + 1)) - 1, 1
    entries: list[tuple[int, int, int]] = []
    for length in lengths:
        left, times = min(counts[length], goal // length), 1
        while left:
            times = min(times, left)
            entries.append((sums, length, times))
            sums |= sums << length * times & mask
            left -= times
            times *= 2
        if sums >> goal & 1:
            break
    at = sums.bit_length() - 1
    chosen: dict[int, int] = {}
    for before, length, times in reversed(entries):
        if not before >> at & 1:
            at -= length * times
            chosen[length] = chosen.get(length, 0) + times
    return chosen


class Windows:
    """Packs items of the given lengths, window by window, cutting as few as it can.

    A piece of a window is ``length, key, start``: the item's number, and where in it
    the piece begins (0 for an item that is not cut).
    """

    def __init__(self, capacity: int, lengths: list[int]) -> None:
        self.capacity, self.total = capacity, sum(lengths)
        self.whole: dict[int, list[int]] = {}
        self.parts: dict[int, list[tuple[int, int]]] = {}
        self.counts: dict[int, int] = {}
        for key, length in enumerate(lengths):
            self.whole.setdefault(length, []).append(key)
            self.counts[length] = self.counts.get(length, 0) + 1
        self.lengths = sorted(self.counts)

    def _add(self, length: int) -> None:
        if length not in self.counts:
            insort(self.lengths, length)
        self.counts[length] = self.counts.get(length, 0) + 1

    def _drop(self, length: int) -> None:
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.counts[length]
            del self.lengths[bisect_left(self.lengths, length)]

    def _whole(self, length: int) -> int:
        key = self.whole[length].pop()
        if not self.whole[length]:
            del self.whole[length]
        return key

    def _take(self, length: int) -> tuple[int, int, int]:
        if self.parts.get(length):
            key, start = self.parts[length].pop()
        else:
            key, start = self._whole(length), 0
        self._drop(length)
        self.total -= length
        return length, key, start

    def _cut_one(self, gap: int) -> bool:
        """Cut the shortest item that has ``gap`` ids, else the longest; False if none can be cut."""
        able = [n for n in self.whole if n & (n - 1)]
        if not able:
            return False
        length = min((n for n in able if n >= gap), default=max(able))
        key, start = self._whole(length), 0
        self._drop(length)
        for n in powers(length):
            self.parts.setdefault(n, []).append((key, start))
            self._add(n)
            start += n
        return True

    def _choice(self, goal: int) -> tuple[list[int], int]:
        """Lengths for a window, and what they leave open: the longest that fits, and what goes best with it."""
        longest = self.lengths[: bisect_right(self.lengths, goal)][-1:]
        if not longest:
            return [], goal
        rest = goal - longest[0]
        self.counts[longest[0]] -= 1
        fitting = self.lengths[: bisect_right(self.lengths, rest)]
        chosen = closest_fill(self.counts, fitting[::-1], rest)
        self.counts[longest[0]] += 1
        found = longest + [n for n, times in chosen.items() for _ in range(times)]
        return found, goal - sum(found)

    def pack(self) -> Iterator[list[tuple[int, int, int]]]:
        """The windows. What is left for the last one becomes windows of a power of two."""
        while self.total:
            goal = self.capacity if self.total >= self.capacity else powers(self.total)[0]
            found, gap = self._choice(goal)
            if not gap or not self._cut_one(gap):
                yield [self._take(n) for n in found]


def tokenized(
    docs: DataFrame,
    json_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """A row per whole window and remainder: ``doc_id, start, length, ids_crc32, doc_tokens, parts, ids``.

    ``parts`` are the powers of two that a remainder may be cut into, null where there
    is nothing to cut. ``ids`` is null unless wanted.
    """
    source = picked(docs, doc_id=id_col, text=text_col)
    end = array("I", [end_id]).tobytes()

    def part(ids: bytes, start: int, length: int) -> dict:
        piece = ids[start * _ID_BYTES : (start + length) * _ID_BYTES]
        return {"start": start, "length": length, "ids_crc32": zlib.crc32(piece)}

    def items(ids: bytes) -> list[dict]:
        n = len(ids) // _ID_BYTES
        found = []
        for start in range(0, n, capacity):
            length = min(capacity, n - start)
            item = part(ids, start, length) | {"doc_tokens": n, "parts": None, "ids": None}
            if length < capacity and length & (length - 1):
                pieces = powers(length)
                starts = [start + sum(pieces[:k]) for k in range(len(pieces))]
                item["parts"] = [part(ids, s, p) for s, p in zip(starts, pieces)]
            if keep_ids:
                item["ids"] = ids[start * _ID_BYTES : (start + length) * _ID_BYTES]
            found.append(item)
        return found

    fields = [(n, pa.int64()) for n in _PART.names]
    kind = pa.list_(
        pa.struct([*fields, ("doc_tokens", pa.int64()), ("parts", pa.list_(pa.struct(fields))), ("ids", pa.binary())])
    )

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _word_ids(json_path)
        for batch in batches:
            found = [items(ids_of(t or "") + end) for t in batch.column("text").to_pylist()]
            yield batch_with(batch, "text", items=pa.array(found, kind))

    cut = source.mapInArrow(tokenize, schema_with(source, "text", ("items", T.ArrayType(_ITEM))))
    return cut.select("doc_id", F.explode("items").alias("item")).select("doc_id", "item.*")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``items`` is a written table like :func:`tokenized` gives.

    Items are dealt over tasks by a running number, about ``ITEMS_PER_TASK`` each, and
    every task packs its own. A sequence belongs to one task; reruns of a task give the
    same places.
    """
    n_tasks = max(1, round(items.count() / ITEMS_PER_TASK))
    numbered = items.withColumn("row_id", F.monotonically_increasing_id())
    dealt = numbered.repartition(n_tasks, F.xxhash64("row_id")).sortWithinPartitions("row_id")
    dealt = dealt.withColumn("task", F.spark_partition_id().cast("long"))
    kept = [f for f in items.schema.fields if f.name != "parts"]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def placed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        lengths, starts = rows.column("length").to_pylist(), rows.column("start").to_pylist()
        sums, cuts = rows.column("ids_crc32").to_pylist(), rows.column("parts")
        first = rows.column("task")[0].as_py() << 40
        keys, out = [], {n: [] for n in ("start", "length", "ids_crc32", "sequence_id", "offset")}
        for number, window in enumerate(Windows(capacity, lengths).pack()):
            offset = 0
            for length, key, start in sorted(window, reverse=True):
                start, crc = start + starts[key], sums[key]
                if length != lengths[key]:
                    crc = next(p["ids_crc32"] for p in cuts[key].as_py() if p["start"] == start)
                keys.append(key)
                for name, value in zip(out, (start, length, crc, first + number, offset)):
                    out[name].append(value)
                offset += length
        columns = {n: pa.array(values, pa.int64()) for n, values in out.items()}
        taken = rows.drop_columns(["parts"]).take(pa.array(keys, pa.int64()))
        if "ids" in schema.names:
            spans = zip(taken.column("ids").to_pylist(), taken.column("start").to_pylist(), out["start"], out["length"])
            pieces = [ids[(s - f) * _ID_BYTES : (s - f + n) * _ID_BYTES] for ids, f, s, n in spans]
            columns["ids"] = pa.array(pieces, pa.binary())
        whole = pa.table({n: columns[n] if n in columns else taken.column(n) for n in schema.names})
        yield from whole.to_batches(max_chunksize=1 << 13)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [b for b in batches if b.num_rows]
        if given:
            yield from placed(pa.Table.from_batches(given))

    return dealt.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    json_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Tokenize and pack: a row per piece, ``doc_id, start, length, ids_crc32, doc_tokens, ids, sequence_id, offset``.

    ``ids`` is there if ``keep_ids`` asks for it. Null and empty texts, and texts without
    a word, are their end id alone. Repeated rows are packed each, null ids too. An
    empty table gives no rows.
    """
    root = scratch_folder(docs.sparkSession)
    items = tokenized(docs, json_path, capacity, end_id, id_col, text_col, keep_ids)
    return pack(saved(items if keep_ids else items.drop("ids"), f"{root}/items"), capacity)
