"""Toxicity by multiple-instance learning.

A document is a bag of sentences (ended by ``.``, ``!``, ``?`` or a line break) and only
documents are labelled. A sentence has a probability, the sigmoid of a bias plus the
weights of its words; the document's is their noisy-or, 1 - product of (1 - p): it is
toxic if any sentence is. Weights are learned through the noisy-or from the documents'
labels, with an L1 pull that leaves only words that tell something, and then locate the
offending sentences.

Words are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased. A word and its
first 4 and 6 bytes (so that forms of a word share something) are hashed into ``2^BITS``
weights. Training reads at most ``PER_CLASS`` documents per label, whole and of any length, each class
weighted to its true share. Their hashed words are taken in the executors; the fit runs in numpy
on the driver. Long clean documents are part of it, so a sentence's probability stays small where
there are thousands of them. All texts are scored whole, in the executors.

Defined results: texts without sentences (null, empty) score 0; without both labels to
learn from all score 0; repeated rows get equal scores; no rows give no rows. Only doc_id
and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm import textbytes
from tidemart.llm.labels import bounded_sample, labelled, sampled_texts

BITS = 18
PREFIXES = (4, 6)
PER_CLASS = 3000
# A word must occur in as many documents of the sample to get a weight.
LEAST_DOCS = 5
ROUNDS = 150
L1 = 8e-5
SEED = 47

_WORD, _END = np.zeros(256, bool), np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_END[[ord(c) for c in ".!?\n"]] = True


@dataclass(frozen=True)
class Sentences:
    """Slots of the words of some texts (and of their prefixes, word by word), the first slot of each
    sentence, the first sentence of each text, and the byte range of each sentence."""

    slots: np.ndarray
    first: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray


def sentences_of(texts: textbytes.Texts) -> Sentences:
    words = textbytes.words_of(texts, _WORD[texts.data], PREFIXES)
    ends = np.r_[0, np.cumsum(_END[texts.data])]
    owner = np.searchsorted(texts.offsets, words.start, "right")
    sentence = ends[words.start] + owner
    new = np.ones(len(sentence), bool)
    # Texts without bytes share their offset with the next; the owner is the last of those.
    np.not_equal(sentence[1:], sentence[:-1], out=new[1:])
    new[1:] |= owner[1:] != owner[:-1]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(sentence)] - 1
    bounds = np.searchsorted(first, words.bounds)
    hashes = np.vstack([words.hashes, words.prefixes]).T.ravel()
    slots = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    if not len(sentence):
        first = last = first[:0]
    return Sentences(slots, first * (1 + len(PREFIXES)), bounds, words.start[first], words.end[last])


def _bag(slots: np.ndarray, first: np.ndarray) -> Sentences:
    """One text's sentences as ``fit`` reads them, without their byte ranges."""
    return Sentences(slots, first, np.array([0, len(first)]), first[:0], first[:0])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def sentence_scores(self, s: Sentences) -> np.ndarray:
        if not len(s.first):
            return np.zeros(0)
        z = self.bias + np.add.reduceat(self.weights[s.slots].astype(np.float64), s.first)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """1 - product of (1 - p) over each text's sentences."""
    none = textbytes.segment_sums(np.log1p(-np.minimum(p, 1 - 1e-12)), bounds)
    return np.clip(-np.expm1(none), 0.0, 1.0)


def fit(bags: list[Sentences], y: np.ndarray, shares: tuple[float, float]) -> Model:
    """Learn from one bag per document and labels 0/1; ``shares``: of the labels among all documents."""
    none = Model(np.zeros(1 << BITS, np.float32), -30.0)
    if not ((y == 0).any() and (y == 1).any()):
        return none
    slots = np.concatenate([b.slots.astype(np.int32) for b in bags])
    words = np.array([len(b.slots) for b in bags])
    seen = np.zeros(1 << BITS, np.int32)
    for b in bags:
        seen[np.unique(b.slots)] += 1
    used = np.flatnonzero(seen >= LEAST_DOCS)
    place = np.full(1 << BITS, len(used), np.int32)
    place[used] = np.arange(len(used))
    shift = np.r_[0, np.cumsum(words)[:-1]]
    first = np.concatenate([b.first + s for b, s in zip(bags, shift)])
    per_bag = np.array([len(b.first) for b in bags])
    bag = np.repeat(np.arange(len(bags)), per_bag)
    bounds = np.r_[0, np.cumsum(per_bag)]
    # Words without a weight are left out; every sentence keeps its bias.
    sentence = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.r_[first, len(slots)]))
    keep = place[slots] < len(used)
    column, row = place[slots[keep]], sentence[keep]
    del slots, sentence, keep
    mass = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum())
    w, b = np.zeros(len(used)), -3.0
    first_m, second_m = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, ROUNDS + 1):
        z = np.clip(b + np.bincount(row, w[column], minlength=len(first)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        whole = noisy_or(p, bounds)
        # d loss / d z: p for a clean document, -p (1 - P) / P for a toxic one.
        push = np.where(y == 1, -(1 - whole) / np.maximum(whole, 1e-9), 1.0) * mass
        g = p * push[bag]
        gradient = np.r_[np.bincount(column, g[row], minlength=len(used)), g.sum()]
        first_m = 0.9 * first_m + 0.1 * gradient
        second_m = 0.99 * second_m + 0.01 * gradient**2
        step = 0.15 * (first_m / (1 - 0.9**t)) / (np.sqrt(second_m / (1 - 0.99**t)) + 1e-7)
        w, b = w - step[:-1], b - step[-1]
        pull = 0.15 * L1 / (np.sqrt(second_m[:-1] / (1 - 0.99**t)) + 1e-7)
        w = np.sign(w) * np.maximum(np.abs(w) - pull, 0)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w
    return Model(weights, float(b))


def train(docs: DataFrame, labels: DataFrame, training: Column, per_class: int = PER_CLASS) -> Model:
    """Learn from the rows of ``labels`` (doc_id, toxic) for which ``training`` holds."""
    rows = labelled(labels, "toxic", training)
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect() if r["label"] in (0, 1)}
    total = max(1, sum(counts.values()))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                (texts,) = textbytes.texts_of(batch.column(2).slice(i, 1))
                bag = sentences_of(texts)
                held = [pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (bag.slots, bag.first)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), *held], ["doc_id", "label", "slots", "first"]
                )

    sample = sampled_texts(docs, bounded_sample(rows, [0, 1], per_class, SEED))
    kinds = dict(sample.dtypes)
    schema = f"doc_id {kinds['doc_id']}, label {kinds['label']}, slots binary, first binary"
    # At most 2 * per_class documents, four bytes a slot.
    got = sample.mapInArrow(features, schema).orderBy("doc_id").select("label", "slots", "first").toArrow()
    y = got.column("label").to_numpy()

    def arrays(name: str) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), np.int32) for x in got.column(name)]

    bags = [_bag(slots, first) for slots, first in zip(arrays("slots"), arrays("first"))]
    return fit(bags, y, (counts.get(0, 0) / total, counts.get(1, 0) / total))


def toxicity(
    docs: DataFrame, labels: DataFrame, training: Column, per_class: int = PER_CLASS, least: float = 0.5
) -> DataFrame:
    """doc_id, score, n_sentences and ``offending`` of every row of ``docs`` (doc_id, text).

    ``offending``: start and end (in UTF-8 bytes) and score of each sentence of at least ``least``.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, training, per_class))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in textbytes.texts_of(batch.column(1)):
                s = sentences_of(texts)
                p = model.value.sentence_scores(s)
                bad = np.flatnonzero(p >= least)
                owner = np.searchsorted(s.bounds, bad, "right") - 1
                ends = np.searchsorted(bad, s.bounds)
                base = texts.offsets[owner]
                spans = pa.StructArray.from_arrays(
                    [pa.array(s.start[bad] - base), pa.array(s.end[bad] - base), pa.array(p[bad])],
                    ["start", "end", "score"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(texts)),
                        pa.array(noisy_or(p, s.bounds)),
                        pa.array(np.diff(s.bounds)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans),
                    ],
                    ["doc_id", "score", "n_sentences", "offending"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        judge,
        f"doc_id {kind}, score double, n_sentences long, offending array<struct<start: long, end: long, score: double>>",
    )
