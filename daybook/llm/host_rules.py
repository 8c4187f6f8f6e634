"""Rules judged by host: a document falls with its host, not by one odd line.

Per document some base measures; per host the share of documents that fail any rule.
A small host's share means little, so shares are shrunk towards all hosts' by a beta
prior fitted to them (method of moments); a host whose shrunk share reaches a limit
is rejected, and the verdicts are joined back to the documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import batch_with, picked, schema_with
from daybook.sources.scratch import saved, scratch_folder

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINES_PER_WORD = 0.1
MAX_HOST_RATE = 0.5
#: The weakest and the strongest prior, in documents, whatever the hosts' shares say.
PRIOR_BOUNDS = (2.0, 1000.0)

_WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, code points in them, symbols, repeated lines, words in repeated 3-word windows."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, _WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    windows = list(zip(words, words[1:], words[2:]))
    repeats = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        until = 0  # words before this one are counted
        for i, window in enumerate(windows):
            if seen[window] > 1:
                repeats += i + 3 - max(i, until)
                until = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = list(zip(*map(measures, batch.column("text").to_pylist()))) or [()] * len(MEASURES)
        yield batch_with(batch, "text", **{n: pa.array(c, pa.int64()) for n, c in zip(MEASURES, columns)})


def base_failed() -> Column:
    """Too short, or most words in repeated windows."""
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def any_rule_failed() -> Column:
    """What counts against a host: a base rule, many symbols, or many repeated lines."""
    n = F.col("n_words")
    symbols = F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n
    return base_failed() | symbols | (F.col("n_dup_lines") > MAX_DUP_LINES_PER_WORD * n)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Alpha and beta of the hosts' shares by moments; ``hosts`` has ``n, failed``."""
    rate = F.col("failed") / F.col("n")
    r = hosts.agg(
        F.sum("failed").alias("failed"),
        F.sum("n").alias("n"),
        F.count("*").alias("hosts"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("n") * rate * rate).alias("second"),
    ).first()
    if not r["n"]:
        return 1.0, 1.0
    mean = r["failed"] / r["n"]
    # Spread between hosts beyond what chance gives shares of this many documents.
    spread = r["second"] / r["n"] - mean * mean
    chance = mean * (1 - mean) * (r["hosts"] - 1) / r["n"]
    between = (spread - chance) / max(1e-12, 1 - r["squares"] / (r["n"] * r["n"]))
    low, high = PRIOR_BOUNDS
    strength = mean * (1 - mean) / between - 1 if between > 0 else high
    strength = min(high, max(low, strength))
    return mean * strength, (1 - mean) * strength


def judge_by_host(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_rate: float = MAX_HOST_RATE,
    keep_rows: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id``, the measures, ``base_failed, kept, host_rate``.

    A null text has no words and fails. A document of a null host is judged alone
    (``host_rate`` null). Repeated rows count each. An empty table gives no rows.
    """
    spark = docs.sparkSession
    root = scratch_folder(spark)
    source = picked(docs, keep_rows, doc_id=id_col, text=text_col, host=host_col)
    schema = schema_with(source, "text", *((n, T.LongType()) for n in MEASURES))
    measured = saved(source.mapInArrow(_measure_batches, schema), f"{root}/measured")
    hosts = saved(
        measured.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum(any_rule_failed().cast("long")).alias("failed")),
        f"{root}/hosts",
    )
    alpha, beta = beta_prior(hosts)
    rate = (F.col("failed") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
    joined = measured.join(hosts.select("host", rate.alias("host_rate")), "host", "left")
    kept = ~base_failed() & (F.col("host_rate").isNull() | (F.col("host_rate") < max_rate))
    extra = ["row"] if keep_rows else []
    return joined.select(
        "doc_id", *MEASURES, base_failed().alias("base_failed"), kept.alias("kept"), "host_rate", *extra
    )
