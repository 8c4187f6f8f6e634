"""Packing documents into sequences by bounded-space online best fit.

A document's ids and an end id become pieces of at most one sequence. Tasks pack
their share of pieces one by one: a fixed number of sequences is open, and a bitset
with one bit per amount of free space finds, in one step, the open sequence that a
piece fills best. When all are open and none has room, the fullest closes first.
Pieces arrive longest first within a task, which is when best fit wastes least.

Only lengths are shuffled; a task holds its open sequences and nothing else.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import batch_with, picked, schema_with
from daybook.llm.tokens import TokenIds
from daybook.sources.scratch import saved, scratch_folder

CAPACITY = 2048
END_ID = 0
PIECES_PER_TASK = 1 << 14
#: More are open only where most of a task's pieces are longer than half a sequence; the
#: fullest, which close then, have room for few other pieces.
OPEN = PIECES_PER_TASK // 2

_ID_BYTES = 4


class OpenSequences:
    """A fixed number of open sequences; ``place`` gives a piece its sequence and offset."""

    def __init__(self, capacity: int, limit: int) -> None:
        self.capacity, self.limit = capacity, limit
        self.free = 0  # bit f: a sequence with room for exactly f more is open
        self.by_free: dict[int, list[int]] = {}
        self.n_open = self.n_all = 0

    def _take(self, room: int) -> int:
        stack = self.by_free[room]
        sequence = stack.pop()
        if not stack:
            del self.by_free[room]
            self.free &= ~(1 << room)
        self.n_open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        enough = self.free >> length
        if enough:
            room = length + (enough & -enough).bit_length() - 1
            sequence = self._take(room)
        else:
            if self.n_open >= self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
            sequence, room = self.n_all, self.capacity
            self.n_all += 1
        if room > length:
            self.by_free.setdefault(room - length, []).append(sequence)
            self.free |= 1 << (room - length)
            self.n_open += 1
        return sequence, self.capacity - room


def cut_lengths(total: int, capacity: int) -> list[int]:
    """A document's pieces: whole sequences, the remainder first."""
    rest = total % capacity
    return ([rest] if rest else []) + [capacity] * (total // capacity)


_PIECE = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32")]
    + [T.StructField("ids", T.BinaryType())]
)


def tokenized_pieces(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids``.

    A null text is empty, and an empty one is its end id alone.
    """
    source = picked(docs, doc_id=id_col, text=text_col)
    end = array("I", [END_ID]).tobytes()
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in _PIECE.names[:-1]] + [("ids", pa.binary())]))

    def pieces(text: str | None, ids_of: TokenIds) -> list[dict]:
        data, found, start = ids_of(text or "") + end, [], 0
        for n, length in enumerate(cut_lengths(len(data) // _ID_BYTES, capacity)):
            ids = data[start * _ID_BYTES : (start + length) * _ID_BYTES]
            row = {"piece": n, "start": start, "length": length, "ids_crc32": zlib.crc32(ids)}
            found.append(row | {"ids": ids if keep_ids else None})
            start += length
        return found

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = TokenIds(json_path, ranks_path)
        for batch in batches:
            found = pa.array([pieces(t, ids_of) for t in batch.column("text").to_pylist()], kind)
            yield batch_with(batch, "text", pieces=found)

    cut = source.mapInArrow(tokenize, schema_with(source, "text", ("pieces", T.ArrayType(_PIECE))))
    out = cut.select("doc_id", F.explode("pieces").alias("p")).select("doc_id", "p.*")
    return out if keep_ids else out.drop("ids")


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_sequences: int = OPEN) -> DataFrame:
    """The rows with ``sequence_id`` and ``offset``; ``pieces`` has ``doc_id, piece, length`` and is a written table.

    Pieces are dealt over tasks by their document's id and piece, about
    ``PIECES_PER_TASK`` each, and every task packs its own; only the last few
    sequences of a task stay part empty. A sequence belongs to one task. Reruns of
    a task give the same places. Null ids and repeated rows are pieces like others; an
    empty table gives no rows.
    """
    n_tasks = max(1, round(pieces.count() / PIECES_PER_TASK))
    order = [F.desc("length"), "doc_id", "piece", *[c for c in ("ids_crc32", "start") if c in pieces.columns]]
    dealt = pieces.repartition(n_tasks, F.xxhash64("doc_id", "piece", "length"))
    dealt = dealt.withColumn("task", F.spark_partition_id().cast("long"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = OpenSequences(capacity, open_sequences)
        for batch in batches:
            tasks = batch.column("task").to_pylist()
            placed = [open_.place(n) for n in batch.column("length").to_pylist()]
            ids = [(task << 40) + sequence for task, (sequence, _) in zip(tasks, placed)]
            yield batch_with(
                batch,
                "task",
                sequence_id=pa.array(ids, pa.int64()),
                offset=pa.array([offset for _, offset in placed], pa.int64()),
            )

    ordered = dealt.sortWithinPartitions(*order)
    schema = schema_with(ordered, "task", ("sequence_id", T.LongType()), ("offset", T.LongType()))
    return ordered.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its place.

    Null and empty texts are their end id alone. Repeated rows are packed each, a
    null id too. An empty table gives no rows.
    """
    root = scratch_folder(docs.sparkSession)
    pieces = tokenized_pieces(docs, json_path, ranks_path, capacity, id_col, text_col, keep_ids)
    return pack(saved(pieces, f"{root}/pieces"), capacity)
