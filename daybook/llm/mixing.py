"""Mixing sources to target weights by capped water-filling.

Targets: every source gets its weight's share of the words wanted; a source whose
share passes its maximum number of epochs is clamped there and what it cannot give is
shared among the others by weight, again and again until none is above.

Sampling: a source's target over its size is a number of epochs. Its whole part
repeats every document; its fraction takes the documents whose seeded hash lies below
a cut, chosen where the words taken come nearest the target. So reruns agree and no
document comes more often than the rounded-up number of epochs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import SPACE, order_hash, picked
from daybook.llm.cuts import find_cuts
from daybook.sources.scratch import saved, scratch_folder

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
#: A mixture names its sources, so there are few; their totals and targets are on the driver.
MAX_SOURCES = 1 << 16
SEED = 20240229

_PLAN = "source string, source_size long, target double, whole long, at long"


def n_words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def water_fill(sizes: list[int], weights: list[float], wanted: float, max_epochs: float) -> list[float]:
    """Targets by weight, none above ``max_epochs`` times its size."""
    caps = [float(max_epochs * s) for s in sizes]
    targets = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(min(wanted, sum(caps)))
    while open_:
        weight = sum(weights[i] for i in open_)
        above = {i for i in open_ if left * weights[i] / weight > caps[i]}
        for i in above or open_:
            targets[i] = caps[i] if above else left * weights[i] / weight
        left -= sum(caps[i] for i in above)
        open_ = open_ - above if above else set()
    return targets


@dataclass(frozen=True)
class SourcePlan:
    """``whole`` copies of every document, one more of those up to the hash ``at``."""

    source: str | None
    size: int
    target: float
    whole: int
    at: int | None


def plan_mixture(
    sized: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float
) -> list[SourcePlan]:
    """Targets and cuts for rows of ``source, size, h``."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"a mixture of more than {MAX_SOURCES} sources")
    # Code point order, null last.
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in totals]
    each = [weights[i % len(weights)] for i in range(len(totals))]
    targets = water_fill(sizes, each, share * sum(sizes), max_epochs)
    whole = [int(t // s) if s else 0 for s, t in zip(sizes, targets)]
    goals = {r["source"]: [round(t - w * s)] for r, s, t, w in zip(totals, sizes, targets, whole)}
    goals = {k: g for k, g in goals.items() if g[0] > 0}
    cuts = find_cuts(sized.select(F.col("source").alias("key"), "h", "size"), goals, "string")
    plans = []
    for r, size, target, n in zip(totals, sizes, targets, whole):
        at = -1
        if r["source"] in goals:
            cut, goal = cuts[r["source"]][0], goals[r["source"]][0]
            # The document at the cut is taken if that comes nearer the goal.
            nearer = cut.at is not None and cut.below + cut.size - goal < goal - cut.below
            at = (1 << 63) - 1 if cut.at is None else cut.at - (0 if nearer else 1)
        plans.append(SourcePlan(r["source"], size, target, n, at))
    return plans


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    keep_rows: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, repetitions``.

    A null text has no words, a null source is a source of its own, the last one.
    Rows that repeat an id and its text are taken alike. An empty table, or one
    without words, gives no repetitions. ``repeated`` unfolds them. More than
    ``MAX_SOURCES`` sources, such as a column of hosts may hold, are refused with a
    ``ValueError``: totals, targets and cuts of all sources pass through the driver.
    """
    spark = docs.sparkSession
    source = picked(docs, keep_rows, doc_id=id_col, text=text_col, source=source_col)
    extra = ["row"] if keep_rows else []
    sized = saved(
        source.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            n_words(F.col("text")).alias("size"),
            order_hash("doc_id", "text", seed=seed).alias("h"),
            *extra,
        ),
        f"{scratch_folder(spark)}/sized",
    )
    plans = plan_mixture(sized, weights, share, max_epochs)
    # One row per source, at most MAX_SOURCES.
    table = spark.createDataFrame([(p.source, p.size, p.target, p.whole, p.at) for p in plans], _PLAN)
    plan = F.broadcast(table.withColumnRenamed("source", "of"))
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("of")))
    taken = F.col("whole") + (F.col("h") <= F.col("at")).cast("long")
    return joined.select("doc_id", "size", "source_size", "target", taken.alias("repetitions"), *extra)


def repeated(mixed: DataFrame) -> DataFrame:
    """Each row as often as the mix takes it; ``repetitions`` goes."""
    kept = [c for c in mixed.columns if c != "repetitions"]
    copies = F.sequence(F.lit(1), F.col("repetitions").cast("int"))
    unfolded = mixed.where("repetitions > 0").select(*kept, F.explode(copies).alias("nth"))
    return unfolded.drop("nth")
