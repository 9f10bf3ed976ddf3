"""Document quality by Bradley-Terry ranking.

Documents are compared in pairs, one of label 1 (preferred) with one of label 0. Each has
a worth w.x, linear in its features, and is preferred with probability sigmoid of the
difference; w minimises the logistic loss on feature differences plus an L2 term. The
threshold is a quantile of the training documents' worths: the share of label 0 among
all that may be learned from. A document's score is the probability that it is preferred
to one at the threshold, so 0.5 is reached there.

Features are scale-free and read whole texts: shares of bytes, shares of upper-case
letters, digits and symbols, lengths of words and lines, and how many words, lines and
three-word shingles are repetitions.

Training reads a sample of at most ``PER_CLASS`` documents per label, with seeded pairs,
and runs in numpy on the driver; all documents are scored in the executors.

Defined results: a text without words (null, empty) scores 0; without any label of either
kind to learn from every other text scores 0.5; repeated rows get equal scores; no rows
give no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemart.llm import textbytes
from tidemart.llm.labels import bounded_sample, labelled, sampled_texts

PER_CLASS = 3000
PAIRS = 20_000
ROUNDS = 300
L2 = 1e-3
SEED = 31

_UPPER, _LETTER, _DIGIT = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT[48:58] = True
_SYMBOL = np.array([33 <= b < 127 and not _LETTER[b] and not _DIGIT[b] for b in range(256)])
N_FEATURES = 256 + 10


def features(texts: textbytes.Texts) -> tuple[np.ndarray, np.ndarray]:
    """A row of features per text, and its number of words."""
    n, size = len(texts), np.diff(texts.offsets)
    out = np.zeros((n, N_FEATURES), np.float32)
    owner = np.repeat(np.arange(n), size)
    counts = np.bincount(owner * 256 + texts.data, minlength=n * 256).reshape(n, 256).astype(np.float32)
    long = np.maximum(size, 1)[:, None]
    out[:, :256] = np.sqrt(counts / long)
    words = textbytes.words_of(texts)
    n_words = np.diff(words.bounds)
    some = np.maximum(n_words, 1)
    letters = np.maximum(counts[:, _LETTER].sum(1), 1)
    lines = np.maximum(counts[:, 10] + 1, 1)
    out[:, 256] = counts[:, _UPPER].sum(1) / letters
    out[:, 257] = counts[:, _DIGIT].sum(1) / long[:, 0]
    out[:, 258] = counts[:, _SYMBOL].sum(1) / some
    out[:, 259] = np.log1p(n_words)
    out[:, 260] = np.log1p(textbytes.segment_sums(words.end - words.start, words.bounds) / some)
    out[:, 261] = np.log1p(n_words / lines)
    for i, k in ((262, 1), (263, 3)):
        distinct = np.fromiter((len(s) for s in textbytes.shingle_sets(words, k)), np.float32, n)
        out[:, i] = 1 - distinct / np.maximum(n_words - k + 1, 1)
    out[:, 264] = counts[:, 46] / some
    out[:, 265] = n_words < 20
    return out, n_words


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, x: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        # Row by row, not by a matrix product, so that equal texts get equal scores.
        worth = ((x - self.mean) / self.scale * self.weights).sum(axis=1) - self.threshold
        return np.where(n_words > 0, 1 / (1 + np.exp(-np.clip(worth, -30, 30))), 0.0)


def fit(x: np.ndarray, y: np.ndarray, share_low: float, seed: int = SEED) -> Model:
    """Learn from features and labels 0/1; ``share_low``: the share of label 0 among all documents."""
    mean = x.mean(0) if len(x) else np.zeros(N_FEATURES, np.float32)
    # A feature that hardly varies in the sample must not dominate elsewhere.
    scale = np.maximum(x.std(0), 0.01) if len(x) else np.ones(N_FEATURES, np.float32)
    z = (x - mean) / scale
    high, low = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    weights, threshold = np.zeros(N_FEATURES, np.float32), 0.0
    if len(high) and len(low):
        rng = np.random.default_rng(seed)
        difference = z[rng.choice(high, PAIRS)] - z[rng.choice(low, PAIRS)]
        first, second = np.zeros_like(weights), np.zeros_like(weights)
        for t in range(1, ROUNDS + 1):
            lost = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
            gradient = L2 * weights - lost @ difference / PAIRS
            first = 0.9 * first + 0.1 * gradient
            second = 0.99 * second + 0.01 * gradient**2
            weights = weights - 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        worth = z @ weights
        # Each sampled document stands for its class's share of all.
        mass = np.where(y == 1, (1 - share_low) / len(high), share_low / len(low))
        order = np.argsort(worth)
        at = int(np.searchsorted(np.cumsum(mass[order]), share_low - 1e-9))
        beyond = min(at + 1, len(order) - 1)
        threshold = float(worth[order[at]] + worth[order[beyond]]) / 2
    return Model(mean, scale, weights, threshold)


def _rows(make, keep_text: bool):
    """A mapInArrow function that reads the column text and adds the arrays that ``make`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for texts in textbytes.texts_of(batch.column(at)):
                part = batch.slice(texts.first, len(texts))
                kept = [i for i in range(part.num_columns) if keep_text or i != at]
                names, arrays = zip(*make(*features(texts)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in kept), *arrays], [*(part.schema.names[i] for i in kept), *names]
                )

    return run


def train(docs: DataFrame, labels: DataFrame, training: Column, per_class: int = PER_CLASS) -> Model:
    """Learn from the rows of ``labels`` (doc_id, quality) for which ``training`` holds."""
    rows = labelled(labels, "quality", training)
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect() if r["label"] in (0, 1)}
    share = counts.get(0, 0) / max(1, sum(counts.values()))
    sample = sampled_texts(docs, bounded_sample(rows, [0, 1], per_class, SEED))

    def packed(x, n_words):
        return [("x", pa.array([r.tobytes() for r in x], pa.binary()))]

    # At most 2 * per_class rows of N_FEATURES floats.
    got = (
        sample.select("doc_id", F.col("label").cast("int").alias("label"), "text")
        .mapInArrow(_rows(packed, keep_text=False), f"doc_id {dict(docs.dtypes)['doc_id']}, label int, x binary")
        .orderBy("doc_id")
        .toArrow()
    )
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, N_FEATURES)
    return fit(x, got.column("label").to_numpy(), share)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` (with text, null as empty) with ``column`` added, in which one of that name is replaced.

    All other columns are kept; text is the only one read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != column]

    def scored(x, n_words):
        return [(column, pa.array(sent.value.scores(x, n_words), pa.float64()))]

    inner = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = StructType([*inner.schema.fields, StructField(column, DoubleType())])
    return inner.mapInArrow(_rows(scored, keep_text=True), schema)


def quality_scores(docs: DataFrame, labels: DataFrame, training: Column, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, score and predicted of every row of ``docs`` (doc_id, text)."""
    model = train(docs, labels, training, per_class)
    scored = score(docs.select("doc_id", "text"), model).select("doc_id", "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
