"""Cutting each group's rows, in a seeded order, at given sums of their sizes.

The order is a 63-bit hash. A running sum over a group would put the group into one
task, so the cut is found by radix instead: sizes are summed by the leading bits of
the hash, only the interval a cut falls into is looked at again by further bits, and
once few rows are left in all such intervals, those are read. What reaches the driver
is bounded by about ``READ`` rows per pass, whatever the input.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 63
READ = 1 << 17


@dataclass(frozen=True)
class Cut:
    """Rows with a smaller hash than ``at`` sum to ``below``; those at it have ``size``.

    ``at`` is None where the group's whole sum does not pass the goal.
    """

    at: int | None
    below: int
    size: int = 0


def _sums(rows: DataFrame, intervals: list[tuple], key_type: str, shift: int, finer: int) -> DataFrame:
    """Sizes in the given intervals (a key and leading bits), by further bits."""
    # At most one interval per goal; goals are few (checked by the callers).
    table = rows.sparkSession.createDataFrame(intervals, f"wanted {key_type}, lead long")
    same = F.col("key").eqNullSafe(F.col("wanted")) & (F.shiftright("h", shift) == F.col("lead"))
    return (
        rows.join(F.broadcast(table), same)
        .groupBy("key", "lead", F.shiftright("h", finer).alias("part"))
        .agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    )


def find_cuts(rows: DataFrame, goals: dict[object, list[int]], key_type: str) -> dict[object, list[Cut]]:
    """For each group and goal the hash at which the running sum would pass the goal.

    ``rows`` has ``key, h, size``; it is read several times and should be a written
    table. Rows that tie in ``h`` belong together. A null key is a group of its own.
    """
    found = {k: [Cut(None, 0)] * len(g) for k, g in goals.items()}
    # By key and leading bits: which goals lie there, and the sum before.
    open_ = {(k, 0): [(i, 0) for i in range(len(g))] for k, g in goals.items() if g}
    shift, inside = BITS, READ + 1
    while open_:
        step = max(2, (READ // len(open_)).bit_length() - 1)
        finer = 0 if inside <= READ else max(0, shift - step)
        parts = defaultdict(list)
        for r in _sums(rows, list(open_), key_type, shift, finer).collect():
            parts[(r["key"], r["lead"])].append((r["part"], r["size"], r["n"]))
        deeper, inside = defaultdict(list), 0
        for (k, lead), cuts in open_.items():
            ordered = sorted(parts.get((k, lead), []))
            for i, total in cuts:
                for part, size, n in ordered:
                    if total + size > goals[k][i]:
                        break
                    total += size
                else:
                    found[k][i] = Cut(None, total)
                    continue
                if finer == 0:
                    found[k][i] = Cut(part, total, size)
                    continue
                inside += 0 if (k, part) in deeper else n
                deeper[(k, part)].append((i, total))
        open_, shift = dict(deeper), finer
    return found
