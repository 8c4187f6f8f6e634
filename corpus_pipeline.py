"""A corpus from raw documents to packed sequences, stage by stage.

Quality classifier, exact dedup, near-dedup, mixing to target weights, packing. Each
stage takes what the one before kept; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from daybook.llm import compression_quality, exact_dedup, mixing, packing, simhash
from daybook.llm.common import rows_of
from daybook.llm.queries import VOCABULARY
from daybook.sources.scratch import passing_scratch, remove_folder, saved, scratch_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labelled ones, accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = compression_quality.judge_quality(docs, labels, keep_rows=True)
    return rows_of(judged.where("predicted = 1"), docs.columns)


def _settled(spark: SparkSession, step: Callable[[], DataFrame]) -> DataFrame:
    """The step's result as a written table; what it set down on the way is gone."""
    path = scratch_folder(spark)
    with passing_scratch(spark):
        return saved(step(), path)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts, the one with the smallest id."""

    def kept() -> DataFrame:
        return rows_of(exact_dedup.exact_duplicates(docs, keep_rows=True).where("kept"), docs.columns)

    return _settled(spark, kept)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links, the one with the smallest id.

    Four-word shingles and at most four differing bits, as in op5.
    """

    def kept() -> DataFrame:
        found = simhash.near_duplicates(docs, max_bits=simhash.MAX_BITS, keep_rows=True)
        return rows_of(found.where("stays"), docs.columns)

    return _settled(spark, kept)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return rows_of(mixing.repeated(mixing.mix(docs, keep_rows=True)), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences."""
    paths = [public_tokenizers.path(f"{VOCABULARY}.{kind}") for kind in ("json", "tiktoken")]
    return packing.pack_documents(docs, *paths)


STAGES = [
    ("quality", quality),
    ("exact dedup", exact),
    ("near-dedup", near),
    ("mixing", mix),
    ("packing", pack),
]

#: No SQL: compression, fingerprints and tokens are not for it. tests/llm has plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a written table, the one before goes."""
    root = scratch_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        with passing_scratch(spark):
            docs = saved(stage(spark, docs, sf_dir), f"{root}/stage-{n}")
        if n:
            remove_folder(spark, f"{root}/stage-{n - 1}")
    return docs
