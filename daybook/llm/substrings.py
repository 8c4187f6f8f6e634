"""Removal of repeated byte strings by a column-wise multi-document suffix order.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier goes.

The order of all suffixes of a collection is built column by column: a round takes
one more symbol from the end of every member and inserts that member's next longer
suffix into the collection's Burrows-Wheeler transform, with the common prefixes of
the neighbours it lands between. A round passes once, front to back, over what the
round before left. After as many rounds as a member has bytes, equal strings stand
side by side with a common prefix of at least ``LENGTH``.

A document of 100,000 bytes would take as many rounds, and no task may hold a corpus.
So the members are not documents but pieces cut around content-chosen anchors. The
anchor of a string is the place of the smallest hash among its ``k``-byte grams.
Equal strings have equal anchors, wherever they stand, so strings can only be equal if
their anchors' hashes are; a piece is a run of consecutive strings with one anchor, at
most ``2 * LENGTH - k`` bytes. Pieces whose anchor hash occurs once have nothing to
compare with and stay where they are. Of the others, equal ones fold into their first
occurrence (by the anchor's hash and a hash of the whole piece, 128 bits together), in
their block and again before the shuffle; bytes travel only for what then still shares
an anchor with a different piece, and collections of a bounded number of such pieces
are ordered as above. Where too many share an anchor, they are cut again by the
anchors of longer grams, in the end of whole strings, where equal hash means equal
piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import picked
from daybook.sources.scratch import saved, scratch_folder

LENGTH = 100
BLOCK_BYTES = 1 << 20
#: Anchor hashes per task that looks for repeated ones.
HASHES = 1 << 19
#: Different pieces of one anchor that are compared at once, and pieces per collection.
CROWD = 2048
COLLECTION = 1024
PIECES_PER_TASK = 1 << 14

#: Places whose hashes are looked at together: what a core's own cache holds.
_SLICE = 1 << 17
_POS = np.uint64((1 << 20) - 1)
_BYTE = np.random.default_rng(1901).integers(1, 1 << 64, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = 20


def grams(length: int) -> tuple[int, int, int]:
    """Bytes of the grams that choose anchors; the next where too many pieces meet."""
    return max(1, length // 3), max(1, 2 * length // 3), length


# -- anchors ----------------------------------------------------------------------------


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the ``k`` bytes from each place, by doubling."""
    n = len(data) - k + 1
    power, width, done, found = _BYTE[data], 1, 0, None
    left = k
    while left:
        if left & 1:
            part = power[done : done + n]
            found = part.copy() if found is None else (found ^ (found >> np.uint64(29))) * _ODD + part
            done += width
        left >>= 1
        if left:
            size = len(power) - width
            power = (power[:size] ^ (power[:size] >> np.uint64(31))) * _ODD + power[width : width + size]
            width *= 2
    return (found ^ (found >> np.uint64(32))) * _ODD


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    least, have = values, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    return np.minimum(least[: len(values) - width + 1], least[width - have :]) if have < width else least


@dataclass
class Runs:
    """Runs of consecutive strings with one anchor: member, start in it, strings, hash."""

    member: np.ndarray
    start: np.ndarray
    n: np.ndarray
    hash: np.ndarray


def anchor_runs(data: np.ndarray, sizes: np.ndarray, k: int, length: int = LENGTH) -> Runs:
    """Runs of the members that lie one after another in ``data``."""
    member_of = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    found: list[tuple[np.ndarray, ...]] = []
    for lo in range(0, max(0, len(data) - length + 1), _SLICE):
        part = data[lo : lo + _SLICE + length - 1]
        hashes = gram_hashes(part, k)
        # The place in the low bits: of equal hashes the leftmost is the anchor.
        keys = (hashes & ~_POS) | np.arange(len(hashes), dtype=np.uint64)
        anchor = _sliding_least(keys, length - k + 1) & _POS
        own = member_of[lo : lo + len(part)]
        whole = np.nonzero(own[: len(anchor)] == own[length - 1 :])[0]
        if not len(whole):
            continue
        anchor = anchor[whole].astype(np.int64)
        new = np.concatenate(([True], (np.diff(whole) != 1) | (anchor[1:] != anchor[:-1])))
        at = np.nonzero(new)[0]
        n = np.diff(np.append(at, len(whole)))
        member = own[whole[at]]
        found.append((member, lo + whole[at] - first[member], n, hashes[anchor[at]]))
    if not found:
        empty = np.empty(0, dtype=np.int64)
        return Runs(empty, empty, empty, empty.astype(np.uint64))
    return Runs(*(np.concatenate(x) for x in zip(*found)))


# -- the column-wise order ----------------------------------------------------------------


def _put_in(old: np.ndarray, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``old`` with ``values`` at the places ``at`` of the longer result."""
    grown = np.empty(len(old) + len(at), dtype=old.dtype)
    stay = np.ones(len(grown), dtype=bool)
    stay[at] = False
    grown[stay] = old
    grown[at] = values
    return grown


def column_wise_order(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of the pieces in order: piece, suffix length, common prefix with the one before.

    The transform is kept as its rows ordered by symbol and place, one number each, so
    that a round finds ranks and neighbours by search and sorts its new rows alone.
    """
    m = len(pieces)
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    rounds = int(sizes.max(initial=0))
    # before[j, i]: the symbol before the last j bytes of piece i; 0 before its first.
    before = np.zeros((rounds + 1, m), dtype=np.int64)
    for i, piece in enumerate(pieces):
        before[: len(piece), i] = np.frombuffer(piece, dtype=np.uint8)[::-1]
        before[: len(piece), i] += 1
    bits = (m + int(sizes.sum())).bit_length()
    kind, places = np.int32 if bits + 9 < 32 else np.int64, (1 << bits) - 1

    common = np.zeros(m, dtype=np.uint8 if rounds < 256 else np.int16)
    place = np.arange(m)  # of each piece's longest suffix so far
    rows = np.sort((before[0] << bits) + place).astype(kind)
    for j in range(1, rounds + 1):
        growing = np.nonzero(sizes >= j)[0]
        growing = growing[np.argsort(place[growing])]
        at = place[growing]
        symbol = before[j - 1, growing]
        n = len(rows)
        # Putting a symbol before every suffix keeps the order among equal symbols.
        mine = np.searchsorted(rows, ((symbol << bits) + at).astype(kind))
        ended = m - len(growing)
        new = m + mine - ended

        # Common prefixes with the neighbours: one more than the least between their rests.
        padded = np.append(common, common[:1])
        prev = rows[np.maximum(mine - 1, 0)].astype(np.int64)
        has_prev = (mine > 0) & (prev >> bits == symbol)
        with_prev = np.zeros(len(at), dtype=common.dtype)
        lo, hi = (prev[has_prev] & places) + 1, at[has_prev] + 1
        if len(lo):
            with_prev[has_prev] = 1 + np.minimum.reduceat(padded, np.stack([lo, hi], axis=1).ravel())[::2]
        nxt = rows[np.minimum(mine + 1, n - 1)].astype(np.int64)
        has_next = (mine + 1 < n) & (nxt >> bits == symbol)
        with_next = np.zeros(len(at), dtype=common.dtype)
        lo, hi = at[has_next] + 1, (nxt[has_next] & places) + 1
        if len(lo):
            with_next[has_next] = 1 + np.minimum.reduceat(padded, np.stack([lo, hi], axis=1).ravel())[::2]

        # One pass over the prefixes and the rows puts the new ones in; rows behind them move on.
        common = _put_in(common, new, with_prev)
        follows = new + 1 < len(common)
        common[new[follows] + 1] = with_next[follows]
        up_to = np.sort(new) - np.arange(len(new))
        moved = np.repeat(np.arange(len(new) + 1, dtype=kind), np.diff(up_to, prepend=0, append=n))
        rows += moved[rows & kind(places)]
        fresh = np.sort((before[j, growing] << bits) + new).astype(kind)
        rows = _put_in(rows, np.searchsorted(rows, fresh) + np.arange(len(fresh)), fresh)
        place[growing] = new

    # A suffix's rank among equal symbols is the place of the suffix one longer.
    n = len(rows)
    rank = np.empty(n, dtype=np.int64)
    rank[rows & kind(places)] = np.arange(n)
    piece, size = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    which, at = np.arange(m), np.arange(m)
    for j in range(rounds + 1):
        piece[at], size[at] = which, j
        longer = sizes[which] > j
        which, at = which[longer], rank[at[longer]]
    return piece, size, common.astype(np.int16)


_OWNER = ["no_id", "doc_id", "block", "idx", "start"]


def later_spans(pieces: list[bytes], owners: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """Spans of strings that also start earlier: piece, first and last string in it.

    ``owners`` has a row per piece: what orders places in the corpus, the place of
    its first byte in the document last.
    """
    piece, size, common = column_wise_order(pieces)
    group = np.cumsum(common < length)
    total = np.array([len(p) for p in pieces])
    shared = np.bincount(group)[group] > 1
    piece, size, group = piece[shared], size[shared], group[shared]
    offset = total[piece] - size
    keys = owners[piece].copy()
    keys[:, -1] += offset
    order = np.lexsort((*keys.T[::-1], group))
    later = order[np.concatenate(([False], group[order][1:] == group[order][:-1]))] if len(order) else order
    piece, offset = piece[later], offset[later]
    order = np.lexsort((offset, piece))
    piece, offset = piece[order], offset[order]
    if len(piece):
        cut = np.nonzero((np.diff(piece) != 0) | (np.diff(offset) != 1))[0]
        for a, b in zip(np.concatenate(([0], cut + 1)), np.append(cut, len(piece) - 1)):
            yield int(piece[a]), int(offset[a]), int(offset[b])


# -- batches ------------------------------------------------------------------------------


def _table(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole documents, one after another, in rows of about ``BLOCK_BYTES``."""

    def out() -> pa.RecordBatch:
        row = (ids, [len(t) for t in texts], b"".join(texts))
        return _table(["ids", "sizes", "data"], [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()], [row])

    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            text = (text or "").encode("utf-8", "surrogatepass")
            ids.append(doc_id)
            texts.append(text)
            held += len(text) + 16
            if held >= BLOCK_BYTES:
                yield out()
                ids, texts, held = [], [], 0
    if ids:
        yield out()


def _members(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["data"], dtype=np.uint8), np.array(row["sizes"], dtype=np.int64)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _buckets(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """Even buckets: an anchor's hash is the least of many, so its own leading bits are mostly zeros."""
    mixed = (hashes ^ (hashes >> np.uint64(29))) * _ODD
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _ODD
    return ((mixed >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)


def _hash_batches(batches: Iterator[pa.RecordBatch], n_buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    """Each block's different anchor hashes, by bucket."""
    for batch in batches:
        for row in _rows(batch):
            hashes = np.unique(anchor_runs(*_members(row), grams(length)[0], length).hash)
            bucket = _buckets(hashes, n_buckets)
            order = np.argsort(bucket, kind="stable")
            hashes, bucket = hashes[order], bucket[order]
            ends = np.searchsorted(bucket, np.arange(n_buckets + 1, dtype=np.uint64))
            out = [
                (b, row["block"], hashes[lo:hi].tobytes()) for b, (lo, hi) in enumerate(zip(ends, ends[1:])) if hi > lo
            ]
            if out:
                yield _table(["bucket", "block", "hashes"], [pa.int32(), pa.int64(), pa.binary()], out)


def _repeated_hashes(table: pa.Table) -> pa.Table:
    """For one bucket: which hashes of each block also occur in another one."""
    blocks = table.column("block").to_pylist()
    parts = [np.frombuffer(x, dtype=np.uint64) for x in table.column("hashes").to_pylist()]
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    repeated = values[counts > 1]
    out = []
    for block, part in zip(blocks, parts):
        here = part[np.isin(part, repeated, assume_unique=True)]
        if len(here):
            out.append((block, here.tobytes()))
    return pa.Table.from_batches([_table(["block", "hashes"], [pa.int64(), pa.binary()], out)])


_KEY = ["hash", "digest", "size"]
_PLACE_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
_PLACES = "no_id int, doc_id long, block long, idx int, start long"
_FOUND = f"hash long, digest long, size int, {_PLACES}, copy boolean"
_PIECES = f"hash long, digest long, size int, {_PLACES}, piece binary"
_BYTES = f"hash long, n long, {_PLACES}, piece binary"
_SPANS = "block long, idx int, start long, stop long"


def _cut(runs: Runs, data: bytes, first: np.ndarray, length: int) -> list[bytes]:
    lo = first[runs.member] + runs.start
    hi = lo + runs.n + length - 1
    return [data[a:b] for a, b in zip(lo.tolist(), hi.tolist())]


def _digests(pieces: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces), dtype=np.uint64, count=len(pieces)).view(np.int64)


def _piece_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a block whose anchor hash is repeated, in another block or in this one.

    Of equal pieces of the block all but the first are marked as copies.
    """
    for batch in batches:
        for row in _rows(batch):
            data, sizes = _members(row)
            runs = anchor_runs(data, sizes, grams(length)[0], length)
            if not len(runs.hash):
                continue
            elsewhere = np.frombuffer(b"".join(row["answers"] or []), dtype=np.uint64)
            _, where, counts = np.unique(runs.hash, return_inverse=True, return_counts=True)
            which = (counts[where] > 1) | np.isin(runs.hash, elsewhere)
            runs = Runs(runs.member[which], runs.start[which], runs.n[which], runs.hash[which])
            digest = _digests(_cut(runs, row["data"], np.cumsum(sizes) - sizes, length))
            no_id = np.array([i is None for i in row["ids"]], dtype=np.int32)[runs.member]
            doc_id = np.array([i or 0 for i in row["ids"]], dtype=np.int64)[runs.member]
            order = np.lexsort((runs.start, runs.member, doc_id, no_id, digest, runs.hash))
            again = (np.diff(runs.hash[order].view(np.int64)) == 0) & (np.diff(digest[order]) == 0)
            copy = np.zeros(len(order), dtype=bool)
            copy[order[1:]] = again & (np.diff(runs.n[order]) == 0)
            columns = [runs.hash.view(np.int64), digest, runs.n + length - 1, no_id, doc_id]
            columns += [np.full(len(order), row["block"]), runs.member, runs.start, copy]
            types = [pa.int64(), pa.int64(), pa.int32(), *_PLACE_TYPES, pa.bool_()]
            names = [*_KEY, *_OWNER, "copy"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _bytes_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the pieces asked of each block."""
    for batch in batches:
        for row in _rows(batch):
            first = (np.cumsum(row["sizes"]) - np.array(row["sizes"])).tolist()
            rows = []
            for w in row["wanted"]:
                at = first[w["idx"]] + w["start"]
                place = (w["no_id"], w["doc_id"], row["block"], w["idx"], w["start"])
                rows.append((w["hash"], w["n"], *place, row["data"][at : at + w["size"]]))
            names = ["hash", "n", *_OWNER, "piece"]
            yield _table(names, [pa.int64(), pa.int64(), *_PLACE_TYPES, pa.binary()], rows)


def _recut_batches(batches: Iterator[pa.RecordBatch], k: int, length: int) -> Iterator[pa.RecordBatch]:
    """The pieces cut again by the anchors of longer grams."""
    for batch in batches:
        held = batch.column("piece").to_pylist()
        sizes = np.array([len(p) for p in held], dtype=np.int64)
        whole = b"".join(held)
        runs = anchor_runs(np.frombuffer(whole, dtype=np.uint8), sizes, k, length)
        pieces = _cut(runs, whole, np.cumsum(sizes) - sizes, length)
        owner = {n: batch.column(n).take(pa.array(runs.member)) for n in _OWNER}
        owner["start"] = pa.array(owner["start"].to_numpy() + runs.start, pa.int64())
        columns = [pa.array(runs.hash.view(np.int64)), pa.array(_digests(pieces), pa.int64())]
        columns += [pa.array(runs.n + length - 1, pa.int32()), *owner.values(), pa.array(pieces, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [*_KEY, *_OWNER, "piece"])


def _span_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Orders collections of whole anchor groups; pieces come sorted by hash."""

    def out(hashes: np.ndarray, pieces: list[bytes], owners: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.append(np.nonzero(np.concatenate(([True], np.diff(hashes) != 0)))[0], len(hashes))
        lo = 0
        while lo < len(hashes):
            hi = int(edges[min(np.searchsorted(edges, lo + COLLECTION), len(edges) - 1)])
            own = owners[lo:hi]
            rows = []
            for p, a, b in later_spans(pieces[lo:hi], own, length):
                _, _, block, idx, start = own[p].tolist()
                rows.append((block, idx, start + a, start + b + length))
            if rows:
                yield _table(["block", "idx", "start", "stop"], [pa.int64(), pa.int32(), pa.int64(), pa.int64()], rows)
            lo = hi

    hashes, pieces, owners = np.empty(0, dtype=np.int64), [], np.empty((0, len(_OWNER)), dtype=np.int64)
    for batch in batches:
        hashes = np.concatenate((hashes, batch.column("hash").to_numpy()))
        pieces = pieces + batch.column("piece").to_pylist()
        new = [batch.column(n).to_numpy().astype(np.int64) for n in _OWNER]
        owners = np.concatenate((owners, np.stack(new, axis=1)))
        if not len(hashes):
            continue
        # The last group may go on in the next batch.
        to = int(np.searchsorted(hashes, hashes[-1]))
        yield from out(hashes[:to], pieces[:to], owners[:to])
        hashes, pieces, owners = hashes[to:], pieces[to:], owners[to:]
    if len(hashes):
        yield from out(hashes, pieces, owners)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut_batches(batches: Iterator[pa.RecordBatch], keep_bytes: bool) -> Iterator[pa.RecordBatch]:
    """Every document of a block without its spans."""
    for batch in batches:
        for row in _rows(batch):
            spans: dict[int, list[tuple[int, int]]] = {}
            for s in row["spans"] or []:
                spans.setdefault(s["idx"], []).append((s["start"], s["stop"]))
            rows, at = [], 0
            for idx, (doc_id, size) in enumerate(zip(row["ids"], row["sizes"])):
                data, at = row["data"][at : at + size], at + size
                kept, end, removed, n = [], 0, 0, 0
                for start, stop in sorted(spans.get(idx, ())):
                    if start > end or n == 0:
                        kept.append(data[end:start])
                        n += 1
                        removed += stop - start
                        end = stop
                    elif stop > end:
                        removed += stop - end
                        end = stop
                kept = b"".join([*kept, data[end:]])
                rows.append((doc_id, size, removed, n, hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            width = len(names) if keep_bytes else len(names) - 1
            yield _table(names[:width], types[:width], [r[:width] for r in rows])


# -- the operator -------------------------------------------------------------------------


def _folded(pieces: DataFrame, root: str, level: int) -> tuple[DataFrame, DataFrame]:
    """The first of each set of equal pieces, with ``n`` different ones of its anchor; the spans of all others."""
    carried = [F.any_value("piece").alias("piece")] if "piece" in pieces.columns else []
    first = F.min(F.struct(*_OWNER)).alias("first")
    distinct = saved(pieces.groupBy(*_KEY).agg(first, *carried), f"{root}/distinct-{level}")
    other = (F.col("block") != F.col("first.block")) | (F.col("idx") != F.col("first.idx"))
    other |= F.col("start") != F.col("first.start")
    stop = (F.col("start") + F.col("size")).alias("stop")
    joined = pieces.select(*_KEY, *_OWNER).join(distinct.select(*_KEY, "first"), _KEY)
    copies = saved(joined.where(other).select("block", "idx", "start", stop), f"{root}/copies-{level}")
    counts = saved(
        distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), f"{root}/counts-{level}"
    )
    several = distinct.join(counts, "hash").select(*_KEY, "n", "first.*", *["piece"] * len(carried))
    return several, copies


def _ordered(several: DataFrame, root: str, level: int, length: int) -> list[DataFrame]:
    """Spans to remove among different pieces that share an anchor, this level's and the finer ones'."""
    n, crowded = several.agg(F.count("*"), F.max("n") > CROWD).first()
    if not n:
        return []
    k = grams(length)
    last = level == len(k) - 1
    few = several if last else several.where(F.col("n") <= CROWD)
    dealt = few.repartition(max(1, round(n / PIECES_PER_TASK)), "hash").sortWithinPartitions("hash")
    spans = [saved(dealt.mapInArrow(partial(_span_batches, length=length), _SPANS), f"{root}/spans-{level}")]
    if crowded and not last:
        recut = partial(_recut_batches, k=k[level + 1], length=length)
        finer = several.where(F.col("n") > CROWD).select(*_OWNER, "piece").mapInArrow(recut, _PIECES)
        finer, copies = _folded(saved(finer, f"{root}/pieces-{level + 1}"), root, level + 1)
        spans += [copies, *_ordered(saved(finer, f"{root}/several-{level + 1}"), root, level + 1, length)]
    return spans


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_bytes: bool = False
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, with ``keep_bytes`` also ``kept``.

    Places are ordered by integer id, then by row, then by start; a null id comes
    last. Rows that repeat a text keep it once. Null and empty texts have no bytes.
    Texts shorter than ``length`` stay whole; an empty table gives no rows.
    """
    spark = docs.sparkSession
    root = scratch_folder(spark)
    source = picked(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    blocks = source.mapInArrow(_block_batches, "ids array<long>, sizes array<long>, data binary")
    blocks = saved(blocks.select(F.monotonically_increasing_id().alias("block"), "*"), f"{root}/blocks", "zstd")

    total = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    # An anchor for about every third of a string's length.
    n_buckets = max(1, -(-total * 3 // (length * HASHES)))
    hashed = blocks.mapInArrow(partial(_hash_batches, n_buckets=n_buckets, length=length), "bucket int, block long, hashes binary")
    answers = hashed.groupBy("bucket").applyInArrow(_repeated_hashes, "block long, hashes binary")
    answers = answers.groupBy("block").agg(F.collect_list("hashes").alias("answers"))
    answers = saved(answers, f"{root}/answers")
    found = blocks.join(answers, "block", "left").mapInArrow(partial(_piece_batches, length=length), _FOUND)
    found = saved(found, f"{root}/pieces-0")
    several, copies = _folded(found.where("NOT copy").drop("copy"), root, 0)
    wanted = several.groupBy("block").agg(
        F.collect_list(F.struct("hash", "n", "no_id", "doc_id", "idx", "start", "size")).alias("wanted")
    )
    pieces = blocks.join(saved(wanted, f"{root}/wanted"), "block").mapInArrow(_bytes_batches, _BYTES)
    near = found.where("copy").select("block", "idx", "start", (F.col("start") + F.col("size")).alias("stop"))
    spans = [near, copies, *_ordered(saved(pieces, f"{root}/several-0"), root, 0, length)]

    joined = spans[0]
    for more in spans[1:]:
        joined = joined.unionAll(more)
    by_block = joined.groupBy("block").agg(F.collect_list(F.struct("idx", "start", "stop")).alias("spans"))
    by_block = saved(by_block, f"{root}/by-block")
    schema = _RESULT + (", kept binary" if keep_bytes else "")
    return blocks.join(by_block, "block", "left").mapInArrow(partial(_cut_batches, keep_bytes=keep_bytes), schema)
