"""Quality by compression: which of two dictionaries suits a text better.

Zstandard dictionaries are built from good and from bad labelled texts. A text is
compressed with either, in small blocks, so that the dictionary and not the text
itself decides; the difference of the two sizes over their sum says which kind it
resembles. A logistic fit on the labelled sample turns that difference, with the
text's own compressibility and length, into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import batch_with, held_out, picked, schema_with
from daybook.llm.fitting import fit_logistic, labelled_sample, sigmoid

#: The bound on what is learnt from: so many labelled documents, none longer than this.
MAX_DOCS = 6000
MAX_DOC_BYTES = 64 << 10
DICTIONARY_BYTES = 64 << 10
BLOCK = 512
LEVEL = 3
SEED = 11
THRESHOLD = 0.3


def _blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def _dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary; too few blocks to train on serve as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:] or b" " * 8


class _Sizes:
    """Features of a text from its sizes under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.good, self.bad = _compressor(good), _compressor(bad)
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)

    def __call__(self, text: str | None) -> tuple[float, float, float, float]:
        data = (text or "").encode("utf-8", "surrogatepass")
        blocks = _blocks(data)
        good = sum(map(len, map(self.good.compress, blocks)))
        bad = sum(map(len, map(self.bad.compress, blocks)))
        whole = len(self.plain.compress(data))
        difference = (bad - good) / max(1, bad + good)
        length = math.log1p(len(data)) / 10
        own = whole / (len(data) + 32)
        return difference, own, length, own * length


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the weights that calibrate their difference."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def fit_quality(sample: list[tuple[str, int]], seed: int = SEED) -> QualityModel:
    """A model from texts and their labels (1 good, 0 bad).

    Dictionaries come from one half of the sample and the calibration from the
    other, which they have not seen. With one label only, or none, the score is the
    share of good texts.
    """
    order = np.random.default_rng(seed).permutation(len(sample))
    half = [sample[i] for i in order[: len(sample) // 2]]
    rest = [sample[i] for i in order[len(sample) // 2 :]]
    blocks = {k: [b for text, label in half if label == k for b in _blocks(text.encode("utf-8", "surrogatepass"))] for k in (0, 1)}
    # Equal amounts, or the larger side would know more words for that alone.
    n = min(map(len, blocks.values()))
    rng = np.random.default_rng(seed)
    even = {k: [b[i] for i in sorted(rng.permutation(len(b))[:n])] for k, b in blocks.items()}
    good, bad = _dictionary(even[1]), _dictionary(even[0])
    y = np.array([label for _, label in rest], dtype=float)
    if len(set(y)) < 2:
        mean = float(y.mean()) if len(y) else 0.5
        odds = math.log(max(mean, 1e-6) / max(1 - mean, 1e-6))
        return QualityModel(good, bad, (0.0, 0.0, 0.0, 0.0, odds))
    sizes = _Sizes(good, bad)
    x = np.array([sizes(text) for text, _ in rest])
    return QualityModel(good, bad, tuple(map(float, fit_logistic(x, y, l2=1e-5))))


def score_quality(
    docs: DataFrame,
    model: QualityModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    keep_rows: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    A null or empty text gets the score that the calibration gives no bytes.
    Repeated rows are scored each; an empty table gives no rows.
    """
    source = picked(docs, keep_rows, doc_id=id_col, text=text_col)
    weights = np.array(model.weights)
    good, bad = model.good, model.bad

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = _Sizes(good, bad)
        for batch in batches:
            x = np.array([sizes(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(weights) - 1)
            scores = sigmoid(x @ weights[:-1] + weights[-1])
            yield batch_with(batch, "text", score=pa.array(scores, pa.float64()))

    scored = source.mapInArrow(score, schema_with(source, "text", ("score", T.DoubleType())))
    extra = ["row"] if keep_rows else []
    predicted = (F.col("score") >= threshold).cast("int")
    apart = held_out(F.col("doc_id")).alias("held_out")
    return scored.select("doc_id", apart, "score", predicted.alias("predicted"), *extra)


def judge_quality(docs: DataFrame, labels: DataFrame, keep_rows: bool = False) -> DataFrame:
    """Fit on the labelled sample, then score every document.

    Rows as in :func:`score_quality`: null and empty texts are scored, repeated rows each,
    an empty table gives none. Labels that are null, or of ids that no document has, teach
    nothing; without any label all documents get the same score.
    """
    sample = labelled_sample(docs, labels, "quality", MAX_DOCS, MAX_DOC_BYTES, SEED)
    return score_quality(docs, fit_quality(sample), keep_rows=keep_rows)
