"""Toxicity with a counterfactual penalty.

A logistic classifier over the words of a text and the beginnings of its words.
Besides the loss on the labels it is charged for every change of its score when the
identity terms of a labelled text are swapped for others of their kind, so that a
neutral mention of a group does not make a text look toxic.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import batch_with, held_out, picked, schema_with
from daybook.llm.fitting import labelled_sample, sigmoid

#: The bound on what is learnt from: so many labelled documents, none longer than this.
MAX_DOCS = 8000
MAX_DOC_BYTES = 32 << 10
MAX_FEATURES = 4000
#: Features are counted and weighted by a hash of this many values.
BUCKETS = 1 << 22
MIN_DOCS = 3
PREFIXES = (4, 5, 6)
PENALTY = 2.0
SEED = 13
THRESHOLD = 0.5

# Words for groups of people; those of one line may stand for each other.
IDENTITY_TERMS = tuple(
    tuple(line.split())
    for line in (
        "muslim christian jewish hindu buddhist sikh catholic protestant atheist",
        "muslims christians jews hindus buddhists sikhs catholics protestants atheists",
        "black white asian latino african european arab indigenous",
        "gay lesbian straight bisexual transgender queer heterosexual",
        "woman man girl boy",
        "women men girls boys",
        "immigrant refugee foreigner native",
        "immigrants refugees foreigners natives",
        "american mexican chinese indian german french spanish russian turkish polish nigerian",
        "deaf blind disabled autistic",
        "muslime christen juden hindus buddhisten",
        "frauen männer mädchen jungen",
        "musulmans chrétiens juifs hindous bouddhistes",
        "femmes hommes filles garçons",
        "musulmanes cristianos judíos hindúes budistas",
        "mujeres hombres niñas niños",
    )
)

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(word: str) -> tuple[int, ...]:
    """The word itself and its beginnings, which are marked apart from words, as hashes."""
    names = [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) > n)]
    return tuple(zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS for name in names)


def _features(words: set[str]) -> np.ndarray:
    return np.unique(np.fromiter((f for w in words for f in features_of(w)), dtype=np.int64))


def swap_identities(words: set[str], rng: np.random.Generator) -> set[str] | None:
    """The words with every identity term replaced by another of its line; None if there is none."""
    swapped, changed = set(words), False
    for line in IDENTITY_TERMS:
        for term in line:
            if term in words:
                swapped.discard(term)
                swapped.add([t for t in line if t != term][rng.integers(len(line) - 1)])
                changed = True
    return swapped if changed else None


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[int, float]
    constant: float


class _Rows:
    """Sparse rows of zeros and ones over the chosen features (sorted)."""

    def __init__(self, rows: list[np.ndarray], chosen: np.ndarray) -> None:
        kept = [r[np.isin(r, chosen, assume_unique=True)] for r in rows]
        self.at = np.repeat(np.arange(len(rows)), [len(r) for r in kept])
        self.col = np.searchsorted(chosen, np.concatenate([*kept, np.empty(0, dtype=np.int64)]))
        self.n, self.width = len(rows), len(chosen)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=w[self.col], minlength=self.n)

    def back(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=v[self.at], minlength=self.width)


def _vocabulary(found: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The features that tell toxic from other texts most surely, and all identity terms, sorted."""
    counts = np.zeros((2, BUCKETS), dtype=np.int32)
    for features, label in zip(found, y):
        counts[int(label), features] += 1
    n1, n0 = y.sum(), len(y) - y.sum()
    often = np.nonzero(counts.sum(axis=0) >= MIN_DOCS)[0]
    other, toxic = counts[:, often]
    share = (toxic + other) / len(y)
    sure = np.abs(toxic / n1 - other / n0) / np.sqrt(share * (1 - share) + 1e-9)
    chosen = often[np.argsort(-sure, kind="stable")[:MAX_FEATURES]]
    return np.union1d(chosen, _features({t for line in IDENTITY_TERMS for t in line}))


def fit_toxicity(
    sample: list[tuple[str, int]], penalty: float = PENALTY, l2: float = 1e-3, rounds: int = 600, seed: int = SEED
) -> ToxicityModel:
    """A model from texts and labels (1 toxic). With one label only, a constant score."""
    y = np.array([label for _, label in sample], dtype=float)
    if len(set(y)) < 2:
        mean = float(y.mean()) if len(y) else 0.0
        return ToxicityModel({}, float(np.log((mean + 1e-3) / (1 - mean + 1e-3))))
    found, before, after = [], [], []
    rng = np.random.default_rng(seed)
    for text, _ in sample:
        words = words_of(text)
        found.append(_features(words))
        swapped = swap_identities(words, rng)
        if swapped is not None:
            before.append(found[-1])
            after.append(_features(swapped))
    chosen = _vocabulary(found, y)
    x, a, b = (_Rows(rows, chosen) for rows in (found, before, after))

    w, c = np.zeros(len(chosen)), float(np.log(y.mean() / (1 - y.mean())))
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))  # both labels count alike
    m, v, mc, vc = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, rounds + 1):  # Adam on the whole sample
        off = (sigmoid(x.times(w) + c) - y) * weight / len(y)
        grad, grad_c = x.back(off) + l2 * w, off.sum()
        if before:
            pa_, pb_ = sigmoid(a.times(w) + c), sigmoid(b.times(w) + c)
            change = 2 * penalty * (pa_ - pb_) / a.n
            da, db = change * pa_ * (1 - pa_), change * pb_ * (1 - pb_)
            grad += a.back(da) - b.back(db)
            grad_c += (da - db).sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        mc, vc = 0.9 * mc + 0.1 * grad_c, 0.999 * vc + 0.001 * grad_c**2
        up, down = 1 - 0.9**step, 1 - 0.999**step
        w -= 0.02 * (m / up) / (np.sqrt(v / down) + 1e-8)
        c -= 0.02 * (mc / up) / (np.sqrt(vc / down) + 1e-8)
    return ToxicityModel({int(f): float(v) for f, v in zip(chosen, w) if abs(v) > 1e-4}, float(c))


class _Scorer(dict):
    """The weighted features of each word met so far."""

    LIMIT = 1 << 18

    def __init__(self, model: ToxicityModel) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.LIMIT:
            self.clear()
        known = tuple(f for f in features_of(word) if f in self.model.weights)
        self[word] = known
        return known

    def logit(self, text: str | None) -> float:
        features = set()
        for word in words_of(text):
            if known := self[word]:
                features.update(known)
        return self.model.constant + sum(self.model.weights[f] for f in sorted(features))


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    keep_rows: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    A null or empty text has no words and gets the constant's score. Repeated rows
    are scored each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    source = picked(docs, keep_rows, doc_id=id_col, text=text_col)
    shared = spark.sparkContext.broadcast(model)  # at most MAX_FEATURES weights and the terms

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            scores = sigmoid(np.array([scorer.logit(t) for t in batch.column("text").to_pylist()], dtype=float))
            yield batch_with(batch, "text", score=pa.array(scores, pa.float64()))

    scored = source.mapInArrow(score, schema_with(source, "text", ("score", T.DoubleType())))
    extra = ["row"] if keep_rows else []
    predicted = (F.col("score") >= threshold).cast("int")
    apart = held_out(F.col("doc_id")).alias("held_out")
    return scored.select("doc_id", apart, "score", predicted.alias("predicted"), *extra)


def judge_toxicity(docs: DataFrame, labels: DataFrame, keep_rows: bool = False) -> DataFrame:
    """Fit on the labelled sample, then score every document.

    Rows as in :func:`score_toxicity`: null and empty texts are scored, repeated rows each,
    an empty table gives none. Labels that are null, or of ids that no document has, teach
    nothing; without any label all documents get the same score.
    """
    sample = labelled_sample(docs, labels, "toxic", MAX_DOCS, MAX_DOC_BYTES, SEED)
    return score_toxicity(docs, fit_toxicity(sample), keep_rows=keep_rows)
