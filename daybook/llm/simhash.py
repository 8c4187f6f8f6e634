"""SimHash near-dedup with pivot distance tables.

Each distinct fingerprint is one node, whatever number of documents has it. Links
(few differing bits) are found among the fingerprints that agree on some blocks of
bits: with ``b`` blocks and at most ``d`` differing bits, some ``b - d`` blocks are
equal, so every choice of ``b - d`` blocks is a key and no link is lost. The number
of blocks follows the number of fingerprints, so that unrelated ones seldom meet.

Where several meet, their Hamming distances to many reference fingerprints decide
first: by the triangle inequality two fingerprints whose distances to any reference
differ by more than ``d`` cannot be linked, so the pair is discarded by its maximum
coordinate difference; survivors are verified bit by bit. In crowded keys some of the
fingerprints themselves serve as references too: two that lie within ``d/2`` of one
are linked without a look, which leaves few groups to compare. A task reports links
that span what it found connected, never all pairs, and a key with more fingerprints
than a task should hold is compared cell by cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import batch_with, picked, schema_with
from daybook.llm.components import components
from daybook.sources.scratch import saved, scratch_folder

WORDS = 4
MAX_BITS = 4
SEED = 42
PIVOTS = 32
CELL = 1 << 13

_PIVOTS = np.random.default_rng(2007).integers(0, 1 << 64, PIVOTS, dtype=np.uint64, endpoint=False)
_HASH = partial(xxhash.xxh64_intdigest, seed=SEED)
_CHUNK = 1 << 14


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64 bits, each set if it is set in over half the shingles' hashes; 0 for no words."""
    # lower() on bytes changes A-Z alone; split() without argument splits at ASCII white space.
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        ends = np.cumsum([len(w) + 1 for w in found]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        line = b" ".join(found)
        shingles = [line[s:e] for s, e in zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist())]
    hashes = np.fromiter(map(_HASH, shingles), dtype="<u8", count=len(shingles))
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _CHUNK):
        octets = hashes[i : i + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        yield batch_with(batch, "text", fp=pa.array(found.view(np.int64), pa.int64()))


# -- links --------------------------------------------------------------------------


def n_blocks(n_fingerprints: int, max_bits: int = MAX_BITS) -> int:
    """Blocks enough that a key has more values than there are fingerprints, eight times over."""
    for b in range(max_bits + 1, 3 * max_bits + 1):
        if 64 * (b - max_bits) / b >= math.log2(max(1, n_fingerprints)) + 3:
            return b
    return 3 * max_bits


def block_masks(blocks: int, max_bits: int = MAX_BITS) -> list[int]:
    """A mask for each choice of the blocks that must agree."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    each = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(each, blocks - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a[:, None] ^ b[None, :])


def _any_link(a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[int, int] | None:
    """Some pair of the two sets that is linked, by their pivot tables, then bit by bit."""
    ta, tb = _distances(a, _PIVOTS).astype(np.int16), _distances(b, _PIVOTS).astype(np.int16)
    step = max(1, _CHUNK * 64 // max(1, len(b) * PIVOTS))
    for i in range(0, len(a), step):
        apart = np.abs(ta[i : i + step, None, :] - tb[None, :, :]).max(axis=2)
        x, y = np.nonzero(apart <= max_bits)
        near = np.nonzero(np.bitwise_count(a[i + x] ^ b[y]) <= max_bits)[0]
        if len(near):
            return int(a[i + x[near[0]]]), int(b[y[near[0]]])
    return None


def spanning_links(fps: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that connect whatever is connected among these fingerprints."""
    links: list[tuple[int, int]] = []
    leads: list[int] = []
    balls: list[np.ndarray] = []
    rest = np.unique(fps)
    while len(rest):
        far = np.bitwise_count(rest ^ rest[0])
        ball = rest[far <= max_bits // 2]
        leads.append(int(rest[0]))
        balls.append(ball)
        links += [(leads[-1], int(x)) for x in ball[1:]]
        rest = rest[far > max_bits // 2]
    if len(leads) == 1:
        return links
    # Two balls can only be linked if their leads are within the bits plus both radii.
    parent = list(range(len(leads)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    reach = max_bits + 2 * (max_bits // 2)
    lead = np.array(leads, dtype=np.uint64)
    table = _distances(lead, _PIVOTS).astype(np.int16)
    for i in range(len(leads) - 1):
        near = np.abs(table[i + 1 :] - table[i]).max(axis=1) <= reach
        others = i + 1 + np.nonzero(near)[0]
        far = np.bitwise_count(lead[others] ^ lead[i])
        for j, bits in sorted(zip(others[far <= reach].tolist(), far[far <= reach].tolist()), key=lambda x: x[1]):
            a, b = root(i), root(j)
            if a == b:
                continue
            link = (leads[i], leads[j]) if bits <= max_bits else _any_link(balls[i], balls[j], max_bits)
            if link is not None:
                parent[a] = b
                links.append(link)
    return links


def _pair_links(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of the pairs ``a[i], b[i]`` are linked: pivot tables first, survivors verified."""
    apart = np.zeros(len(a), dtype=np.int16)
    for pivot in _PIVOTS:
        difference = np.bitwise_count(a ^ pivot).astype(np.int16) - np.bitwise_count(b ^ pivot)
        np.maximum(apart, np.abs(difference), out=apart)
    left = np.nonzero(apart <= max_bits)[0]
    return left[np.bitwise_count(a[left] ^ b[left]) <= max_bits]


def _link_batches(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links of each run of equal keys; rows come sorted by key, runs may cross batches."""

    def found(keys: np.ndarray, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        starts = np.nonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))[0]
        sizes = np.diff(np.append(starts, len(keys)))
        two = starts[sizes == 2]
        linked = _pair_links(fps[two], fps[two + 1], max_bits)
        yield fps[two[linked]], fps[two[linked] + 1]
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            links = spanning_links(fps[s : s + n], max_bits)
            if links:
                pairs = np.array(links, dtype=np.uint64)
                yield pairs[:, 0], pairs[:, 1]

    def out(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys):
            for a, b in found(keys, fps):
                if len(a):
                    columns = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (a, b)]
                    yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    keys, fps = np.empty((0, 4), dtype=np.int64), np.empty(0, dtype=np.uint64)
    for batch in batches:
        new = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in ("choice", "bits", "i", "j")], axis=1)
        keys = np.concatenate((keys, new))
        fps = np.concatenate((fps, batch.column("fp").to_numpy().view(np.uint64)))
        if not len(keys):
            continue
        # The last run may go on in the next batch.
        same = (keys == keys[-1]).all(axis=1)
        open_from = len(keys) - int(np.argmin(same[::-1])) if not same.all() else 0
        yield from out(keys[:open_from], fps[:open_from])
        keys, fps = keys[open_from:], fps[open_from:]
    yield from out(keys, fps)


def fingerprint_links(distinct: DataFrame, n: int, folder: str, max_bits: int = MAX_BITS, cell: int = CELL) -> DataFrame:
    """Spanning links ``a, b`` of the ``n`` distinct fingerprints in column ``fp``."""
    masks = block_masks(n_blocks(n, max_bits), max_bits)
    choices = F.array(
        *[
            F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
            for i, m in enumerate(masks)
        ]
    )
    keyed = distinct.select("fp", F.explode(choices).alias("k")).select("fp", "k.choice", "k.bits")
    crowded = saved(
        keyed.groupBy("choice", "bits")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > cell)
        .select("choice", "bits", F.ceil(F.col("n") / cell).cast("int").alias("parts")),
        f"{folder}/crowded",
    )
    keyed = keyed.withColumn("parts", F.lit(1)) if crowded.isEmpty() else keyed.join(
        crowded, ["choice", "bits"], "left"
    ).withColumn("parts", F.coalesce("parts", F.lit(1)))
    # A crowded key is a triangle of cells, each with two of its parts.
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    cells = keyed.withColumn("own", part).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    cells = cells.select("fp", "choice", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    key = ["choice", "bits", "i", "j"]
    links = cells.repartition(*key).sortWithinPartitions(*key)
    return links.mapInArrow(lambda batches: _link_batches(batches, max_bits), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = MAX_BITS,
    keep_rows: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id, stays``.

    ``fp`` is the fingerprint as a signed number. A component is what links reach;
    its id is the smallest ``doc_id`` in it (null ids count last), and one row of it
    ``stays``. A null text is empty; all texts without words share fingerprint zero.
    Repeated rows are in one component. An empty table gives no rows.
    """
    spark = docs.sparkSession
    root = scratch_folder(spark)
    source = picked(docs, keep_rows, doc_id=id_col, text=text_col)
    extra = ["row"] if keep_rows else []
    schema = schema_with(source, "text", ("fp", T.LongType()))
    marked = source.mapInArrow(_fingerprint_batches, schema)
    marked = saved(marked.withColumn("row_id", F.monotonically_increasing_id()), f"{root}/marked")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")
    distinct = saved(marked.groupBy("fp").agg(F.min(order).alias("first")), f"{root}/distinct")
    links = saved(
        fingerprint_links(distinct.select("fp"), distinct.count(), root, max_bits).distinct(), f"{root}/found"
    )
    nodes = components(links, root)
    rooted = distinct.join(nodes, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = saved(rooted, f"{root}/rooted")
    least = saved(rooted.groupBy("root").agg(F.min("first").alias("least")), f"{root}/least")
    labels = saved(rooted.join(least, "root").select(F.col("fp").alias("of"), "least"), f"{root}/labels")
    stays = (F.col("row_id") == F.col("least.row_id")).alias("stays")
    component = F.col("least.doc_id").alias("component_id")
    return marked.join(labels, F.col("fp") == F.col("of")).select("doc_id", "fp", component, stays, *extra)
