"""Resharding by minimum-cost flow.

From the sizes of the old shards and the capacities of the new ones, a flow says how
many bytes go from where to where so that the fewest leave their place. The flow is
then cut out of the rows: within an old shard rows have a seeded order, what stays
comes first and each transfer is a block of that order. A row that straddles the end
of a block, and a small fixed number of each shard's smallest rows, are dealt one by
one at the end, largest first, to the new shard with most room; so new shards differ
by about the smallest of them.

The driver sees shards and transfers only. Rows are numbered within a shard by
blocks of bounded size, so no task holds a shard.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import order_hash, picked, utf8
from daybook.llm.cuts import BITS, find_cuts
from daybook.sources.scratch import saved, scratch_folder

SEED = 7
CHANGE = 64
BLOCK_BYTES = 32 << 20
_FAR = 1 << 62


@dataclass(frozen=True)
class Transfer:
    old: int
    new: int
    size: int


def cheapest_transfers(
    old: dict[int, int], capacity: dict[int, int], cost: Callable[[int, int], int] | None = None
) -> list[Transfer]:
    """Who gives how many bytes to whom, at the least total cost.

    ``cost`` is what a byte from an old to a new shard costs, 0 or more; by default 1 if
    it changes its shard. Capacities must hold all bytes. What may stay for nothing is
    settled first. The rest follows shortest augmenting paths, found over costs that are
    reduced by node potentials, so that a search ends at the nearest shard with room.
    """
    if sum(old.values()) > sum(capacity.values()):
        raise ValueError("the new shards cannot hold the old ones")
    givers, takers = sorted(old), sorted(capacity)
    if cost is None:
        price = (np.array(givers)[:, None] != np.array(takers)[None, :]).astype(np.int64)
    else:
        price = np.array([[cost(i, j) for j in takers] for i in givers], dtype=np.int64).reshape(len(givers), len(takers))
    if price.size and price.min() < 0:
        raise ValueError("costs may not be negative")
    left, room = [old[i] for i in givers], np.array([capacity[j] for j in takers], dtype=object)
    flow: list[dict[int, int]] = [{} for _ in takers]  # by new shard: old shard and bytes
    at = {j: n for n, j in enumerate(takers)}
    for i, shard in enumerate(givers):
        j = at.get(shard)
        if j is not None and price[i, j] == 0 and min(left[i], room[j]):
            flow[j][i] = stays = min(left[i], room[j])
            left[i] -= stays
            room[j] -= stays
    high_old, high_new = np.zeros(len(givers), dtype=np.int64), np.zeros(len(takers), dtype=np.int64)
    for source in range(len(givers)):
        while left[source]:
            has_room = room > 0
            far = price[source] + high_old[source] - high_new
            via = np.full(len(takers), source)
            far_old, back, seen = {source: 0}, {}, np.zeros(len(takers), dtype=bool)
            while True:
                open_far = np.where(seen, _FAR, far)
                least = open_far.min()
                ends = np.flatnonzero((open_far == least) & has_room)
                if len(ends):
                    end = int(ends[0])
                    break
                j = int(open_far.argmin())
                seen[j] = True
                for i in flow[j]:
                    if i not in far_old:
                        far_old[i], back[i] = int(least), j
                        onward = least + price[i] + high_old[i] - high_new
                        nearer = onward < far
                        far, via = np.where(nearer, onward, far), np.where(nearer, i, via)
            high_new += np.minimum(far, least)
            reached = np.full(len(givers), least)
            reached[list(far_old)] = list(far_old.values())
            high_old += reached
            path, j = [], end
            while True:
                i = int(via[j])
                path.append((i, j))
                if i == source:
                    break
                j = back[i]
            amount = min([left[source], room[end], *(flow[back[i]][i] for i, _ in path[:-1])])
            for i, j in path:
                flow[j][i] = flow[j].get(i, 0) + amount
                if i != source:
                    flow[back[i]][i] -= amount
                    if not flow[back[i]][i]:
                        del flow[back[i]][i]
            room[end] -= amount
            left[source] -= amount
    moved = [(givers[i], takers[j], n) for j, given in enumerate(flow) for i, n in given.items()]
    return [Transfer(*m) for m in sorted(moved)]


def _singles(sized: DataFrame) -> dict[tuple[int, int], int]:
    """Each old shard's smallest rows: at most ``CHANGE`` a shard."""
    nth = F.row_number().over(Window.partitionBy("key").orderBy("size", "h"))
    small = sized.withColumn("nth", nth).where(F.col("nth") <= CHANGE).select("key", "h").distinct()
    # Rows that tie in the order go together.
    same = sized.join(F.broadcast(small), ["key", "h"]).groupBy("key", "h").agg(F.sum("size").alias("size"))
    return {(r["key"], r["h"]): r["size"] for r in same.collect()}


def _plan(sized: DataFrame, n_shards: int) -> tuple[list[tuple], list[tuple], list[Transfer]]:
    """Blocks ``old, from, before, new`` and single rows ``old, h, new``."""
    spark = sized.sparkSession
    singles = _singles(sized)
    if not singles:
        return [], [], []
    apart = F.broadcast(spark.createDataFrame(list(singles), "key int, h long"))
    rest = sized.join(apart, ["key", "h"], "left_anti")
    sizes = {r["key"]: r["size"] for r in rest.groupBy("key").agg(F.sum("size").alias("size")).collect()}
    total = sum(sizes.values())
    each = {j: total // n_shards + (j < total % n_shards) for j in range(n_shards)}
    transfers = cheapest_transfers(sizes, each)

    out: dict[int, list[Transfer]] = {i: [] for i in sizes}
    for t in sorted(transfers, key=lambda t: (t.old, t.new != t.old, t.new)):
        out[t.old].append(t)
    ends = {i: [sum(t.size for t in moved[:n]) for n in range(1, len(moved))] for i, moved in out.items()}
    cuts = find_cuts(rest, ends, "int")
    blocks, held = [], dict.fromkeys(range(n_shards), 0)
    for i, moved in out.items():
        start, done = 0, 0
        for t, cut in zip(moved, [*cuts[i], None]):
            end = cut and cut.at
            upto = sizes[i] if end is None else cut.below
            if upto > done:
                blocks.append((i, start, end, t.new))
                held[t.new] += upto - done
            if end is None:
                break
            if end >= start:
                singles[(i, end)] = cut.size
                start, done = end + 1, cut.below + cut.size
    placed = []
    for (i, h), size in sorted(singles.items(), key=lambda x: (-x[1], x[0])):
        new = min(held, key=lambda j: (held[j], j != i, j))
        held[new] += size
        placed.append((i, h, new))
    return blocks, placed, transfers


def reshard(
    docs: DataFrame,
    old_shard: str,
    n_shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
) -> tuple[DataFrame, list[Transfer]]:
    """Every document's new ``shard`` and ``slot`` beside ``doc_id, text, old_shard``, and the flow.

    ``old_shard`` names an integer column: where the document is now, counted from 0.
    A document's size is its UTF-8 bytes plus 8; a null text has none. Rows go one by
    one, also those that repeat an id or have none. An old shard of null counts as -1,
    whose rows all move. An empty table gives no rows and no transfers.
    """
    spark = docs.sparkSession
    root = scratch_folder(spark)
    source = picked(docs, doc_id=id_col, text=text_col, old_shard=old_shard)
    size = (F.octet_length(utf8(F.col("text"))) + 8).cast("long").alias("size")
    # The running number tells equal rows apart; the written table keeps it.
    numbered = source.select(
        "doc_id",
        "text",
        F.coalesce("old_shard", F.lit(-1)).cast("int").alias("old_shard"),
        size,
        order_hash(F.col("doc_id"), F.monotonically_increasing_id(), seed=seed).alias("h"),
    )
    rows = saved(numbered, f"{root}/rows", compression="zstd")
    sized = rows.select(F.col("old_shard").alias("key"), "h", "size")
    blocks, singles, transfers = _plan(sized, n_shards)

    # A block per transfer and a row per single row: bounded by the numbers of shards.
    block_table = spark.createDataFrame(blocks, "of int, start long, before long, block_shard int")
    single_table = spark.createDataFrame(singles, "of_one int, h_one long, one_shard int")

    def placed(df: DataFrame, key: str) -> DataFrame:
        inside = (F.col(key) == F.col("of")) & (F.col("h") >= F.col("start"))
        inside &= F.col("before").isNull() | (F.col("h") < F.col("before"))
        alone = (F.col(key) == F.col("of_one")) & (F.col("h") == F.col("h_one"))
        joined = df.join(F.broadcast(single_table), alone, "left").join(F.broadcast(block_table), inside, "left")
        shard = F.coalesce("one_shard", "block_shard").alias("shard")
        return joined.select(*df.columns, shard, F.pmod(F.xxhash64("h"), F.lit(n_blocks)).cast("int").alias("block"))

    bytes_ = sized.agg(F.sum("size")).first()[0] or 0
    n_blocks = max(1, -(-bytes_ // (n_shards * BLOCK_BYTES)))
    # Slots: a number within the block of a shard, after the rows of its earlier blocks.
    counts = saved(placed(sized, "key").groupBy("shard", "block").agg(F.count("*").alias("n")), f"{root}/counts")
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "block").orderBy("h", "doc_id")
    numbered = placed(rows, "old_shard").withColumn("nth", F.row_number().over(within))
    slot = (F.col("first") + F.col("nth") - 1).cast("long").alias("slot")
    return (
        numbered.join(first, ["shard", "block"]).select("doc_id", "text", "old_shard", "shard", slot),
        transfers,
    )


def affected_shards(placed: DataFrame) -> list[int]:
    """The shards that lose or get a row, in order; as many values as there are shards.

    -1, the old shard of rows that had none, is among them if any; none for an empty table.
    """
    moved = placed.where(F.col("shard") != F.col("old_shard"))
    ends = moved.select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
    return sorted(r["shard"] for r in ends.collect())


def rewrite_shards(placed: DataFrame, path: str, shards: list[int] | None = None) -> None:
    """Write the given shards (all by default), each in its folder ``shard=``, and leave the rest.

    A shard's rows come from as many tasks as it has blocks, so its files have a
    bounded size each. Files of a shard written before are replaced. Shards without rows,
    and an empty table, write nothing and leave what was there.
    """
    rows = placed if shards is None else placed.where(F.col("shard").isin(shards))
    rows.write.partitionBy("shard").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
