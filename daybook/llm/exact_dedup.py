"""Exact dedup by distributed MSD radix partitioning.

Texts are split by their leading bytes, each group again by the bytes after those,
until a group is a single text or has ended. No digest decides equality: a group's
members agree in every byte read, and a group ends only where all its texts do.

One round is one run of bytes, and runs grow eightfold, so a text of n bytes takes
about log8(n) rounds; a round only sees the texts that still share everything read
so far. A round counts its groups before the shuffle (many copies leave a task as
one row) and joins the counts back to the texts; both inputs of that join are
plain exchanges of written tables, so AQE can split a group with a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import SPACE, picked
from daybook.sources.scratch import saved, scratch_folder

FIRST_BYTES = 128
GROWTH = 8

# Only runs that are not one plain space yet.
_RUNS = rf"[\x09-\x0D][{SPACE}]*|\x20[{SPACE}]+"


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_bytes: int = FIRST_BYTES,
    keep_rows: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after normalisation. Of equal texts the smallest
    id stays. A null text is an empty one. A null id comes after all others; of rows
    that repeat an id and its text exactly one stays. An empty table gives no rows.
    """
    spark = docs.sparkSession
    root = scratch_folder(spark)
    source = picked(docs, keep_rows, doc_id=id_col, text=text_col)
    extra = ["row"] if keep_rows else []
    texts = source.select("doc_id", *extra, normalised(F.col("text")).cast("binary").alias("rest"))
    texts = texts.withColumn("run", F.substring("rest", 1, first_bytes))

    shared = saved(
        texts.groupBy("run")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("run", F.monotonically_increasing_id().alias("group")),
        f"{root}/heads",
    )
    tail = F.substring("rest", first_bytes + 1, 0x7FFFFFFF)
    first = saved(
        texts.join(shared, "run", "left").select(
            "doc_id",
            *extra,
            F.sha2("rest", 256).alias("text_sha256"),
            "group",
            F.when(F.col("group").isNotNull(), tail).alias("rest"),
            F.monotonically_increasing_id().alias("row_id"),
        ),
        f"{root}/round-0",
    )
    done = [
        first.where(F.col("group").isNull()).select(
            "doc_id",
            F.col("doc_id").alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
            "text_sha256",
            *extra,
        )
    ]

    active, width, n = first.where(F.col("group").isNotNull()), first_bytes, 0
    while not active.isEmpty():
        width, n = width * GROWTH, n + 1
        read = active.withColumn("run", F.substring("rest", 1, width))
        order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")
        counted = saved(
            read.groupBy("group", "run")
            .agg(F.count("*").alias("n"), F.min(order).alias("first"))
            .withColumn("next", F.monotonically_increasing_id()),
            f"{root}/groups-{n}",
        )
        ended = (F.col("n") == 1) | (F.octet_length("run") < width)
        split = saved(
            read.join(counted, ["group", "run"]).select(
                "doc_id",
                *extra,
                "text_sha256",
                "row_id",
                "n",
                "first",
                F.when(~ended, F.col("next")).alias("group"),
                F.when(~ended, F.substring("rest", width + 1, 0x7FFFFFFF)).alias("rest"),
            ),
            f"{root}/round-{n}",
        )
        done.append(
            split.where(F.col("group").isNull()).select(
                "doc_id",
                F.col("first.doc_id").alias("keep_id"),
                F.col("n").alias("group_size"),
                (F.col("row_id") == F.col("first.row_id")).alias("kept"),
                "text_sha256",
                *extra,
            )
        )
        active = split.where(F.col("group").isNotNull()).drop("n", "first")

    result = done[0]
    for part in done[1:]:
        result = result.unionAll(part)
    return result
