"""Language of a text by a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes. Filters of several widths run over each
window's bytes; each filter's largest activation in the window is kept, and a softmax
layer turns these into language probabilities. A document's probability is the mean over
all its windows, weighted by their bytes: whole texts are read.

A filter is a table of weights per position and byte value, so applying it is a sum of
table look-ups. Training is plain numpy on the driver: Adam over seeded batches of one
window from each of at most ``PER_CLASS`` sampled documents per language, and, with so many
languages that this passes ``MOST_WINDOWS``, an equal share of those for each language, one at least.
The names of the languages are held on the driver, as every model of classes does.

Defined results: ``und`` with score 0 for null, for texts without a letter, and for all if
there is nothing to learn from; with a single language it is every text's; documents
with contradicting languages, null ids or null languages are not learned from; repeated
rows get equal results; no rows give no rows. Only doc_id and text are read.
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

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
PER_CLASS = 1500
MOST_WINDOWS = 500_000
EPOCHS = 5
BATCH = 64
# Windows times languages whose probabilities are worked out together, one window at least.
CELLS_AT_ONCE = 1 << 14
SEED = 59
UNKNOWN = "und"

_SPREAD = max(WIDTHS) - 1
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


@dataclass
class Network:
    """``tables[i]`` has shape (width, 256, filters)."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def activations(self, windows: np.ndarray) -> list[np.ndarray]:
        """Of every filter at every place; windows have WINDOW + _SPREAD bytes, padded by spaces."""
        out = []
        for table in self.tables:
            total = np.take(table[0], windows[:, :WINDOW], axis=0)
            for j in range(1, len(table)):
                total += np.take(table[j], windows[:, j : j + WINDOW], axis=0)
            out.append(total)
        return out

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        top = np.concatenate([a.max(axis=1) for a in self.activations(windows)], axis=1)
        return np.maximum(top + self.bias, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        # Row by row, not by a matrix product, so that equal texts get equal scores.
        return softmax((self.pooled(windows)[:, :, None] * self.dense).sum(axis=1) + self.offset)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class _Adam:
    def __init__(self, shape):
        self.m, self.v, self.t = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0

    def step(self, gradient: np.ndarray, rate: float) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.99 * self.v + 0.01 * gradient**2
        return rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-7)


def fit(windows: np.ndarray, y: np.ndarray, languages: list[str], seed: int = SEED) -> Network:
    """Learn from windows of bytes and indices into ``languages``."""
    rng = np.random.default_rng(seed)
    n, kinds = len(WIDTHS) * FILTERS, max(1, len(languages))
    net = Network(
        languages,
        [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(n, np.float32),
        rng.normal(0, 0.3, (n, kinds)).astype(np.float32),
        np.zeros(kinds, np.float32),
    )
    if len(languages) < 2 or not len(windows):
        return net
    adams = [_Adam(t.shape) for t in net.tables], _Adam(n), _Adam((n, kinds)), _Adam(kinds)
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, size = windows[rows], len(rows)
            acts = net.activations(x)
            best = [a.argmax(axis=1) for a in acts]
            top = np.concatenate([a.max(axis=1) for a in acts], axis=1) + net.bias
            hidden = np.maximum(top, 0)
            error = softmax(hidden @ net.dense + net.offset)
            error[np.arange(size), y[rows]] -= 1
            error /= size
            back = (error @ net.dense.T) * (top > 0)
            # Only the place of a filter's largest activation in a window learns.
            for i, (table, width) in enumerate(zip(net.tables, WIDTHS)):
                gradient = np.zeros_like(table)
                push = back[:, i * FILTERS : (i + 1) * FILTERS]
                columns = np.broadcast_to(np.arange(FILTERS), push.shape)
                for j in range(width):
                    byte = np.take_along_axis(x, best[i] + j, axis=1)
                    np.add.at(gradient[j], (byte, columns), push)
                table -= adams[0][i].step(gradient, 0.02)
            net.bias -= adams[1].step(back.sum(0), 0.02)
            net.dense -= adams[2].step(hidden.T @ error, 0.02)
            net.offset -= adams[3].step(error.sum(0), 0.02)
    return net


def windows_of(texts: textbytes.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and length of every window, and the first window of each text."""
    count = -(-np.diff(texts.offsets) // WINDOW)
    bounds = np.r_[0, np.cumsum(count)]
    nth = np.arange(bounds[-1]) - np.repeat(bounds[:-1], count)
    start = np.repeat(texts.offsets[:-1], count) + nth * WINDOW
    length = np.minimum(WINDOW, np.repeat(texts.offsets[1:], count) - start)
    return start, length, bounds


def cut(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The windows' bytes, padded by spaces."""
    at = start[:, None] + np.arange(WINDOW + _SPREAD)
    inside = np.arange(WINDOW + _SPREAD) < length[:, None]
    return np.where(inside, data[np.minimum(at, len(data) - 1)], np.uint8(32))


def text_probabilities(net: Network, texts: textbytes.Texts) -> np.ndarray:
    """Mean probabilities over each text's windows; 0 for texts without bytes."""
    start, length, bounds = windows_of(texts)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    total = np.zeros((len(bounds) - 1, len(net.offset)))
    step = min(256, max(1, CELLS_AT_ONCE // len(net.offset)))
    for at in range(0, len(start), step):
        part = slice(at, at + step)
        p = net.probabilities(cut(texts.data, start[part], length[part]))
        # One window after the other, so that a text's sum doesn't depend on where the steps fall.
        np.add.at(total, owner[part], p * length[part, None])
    return total / np.maximum(np.diff(texts.offsets), 1)[:, None]


def has_letter(texts: textbytes.Texts) -> np.ndarray:
    seen = np.r_[0, np.cumsum(_ASCII_LETTER[texts.data])]
    found = (seen[texts.offsets[1:]] - seen[texts.offsets[:-1]]) > 0
    for i in np.flatnonzero(~found):
        raw = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
        found[i] = bool((raw > 127).any()) and any(map(str.isalpha, raw.tobytes().decode(errors="replace")))
    return found


def train(docs: DataFrame, labels: DataFrame, training: Column, per_class: int = PER_CLASS) -> Network:
    """Learn from the rows of ``labels`` (doc_id, lang) for which ``training`` holds."""
    rows = labelled(labels, "lang", training)
    languages = sorted(r[0] for r in rows.select("label").distinct().collect())
    if len(languages) < 2:
        return fit(np.zeros((0, WINDOW + _SPREAD), np.uint8), np.zeros(0, int), languages)

    def one_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for texts in textbytes.texts_of(batch.column(2)):
                start, length, bounds = windows_of(texts)
                found, owners = [], []
                for i in np.flatnonzero(np.diff(bounds)):
                    seed = [SEED, *str(ids[texts.first + i]).encode()]
                    k = bounds[i] + int(np.random.default_rng(seed).integers(bounds[i + 1] - bounds[i]))
                    found.append(cut(texts.data, start[k : k + 1], length[k : k + 1]).astype(np.uint8).tobytes())
                    owners.append(texts.first + i)
                picked = batch.take(pa.array(owners, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [picked.column(0), picked.column(1), pa.array(found, pa.binary())], ["doc_id", "label", "window"]
                )

    each = min(per_class, max(1, MOST_WINDOWS // len(languages)))
    sample = sampled_texts(docs, bounded_sample(rows, languages, each, SEED))
    kind = dict(docs.dtypes)["doc_id"]
    # At most ``each`` windows per language.
    got = sample.mapInArrow(one_window, f"doc_id {kind}, label string, window binary").orderBy("doc_id").toArrow()
    windows = np.frombuffer(b"".join(got.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW + _SPREAD)
    y = np.searchsorted(np.array(languages), np.array(got.column("label").to_pylist(), dtype=object).astype(str))
    return fit(windows, y, languages)


def languages(docs: DataFrame, labels: DataFrame, training: Column, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, lang_pred and score (its probability) of every row of ``docs`` (doc_id, text)."""
    net = docs.sparkSession.sparkContext.broadcast(train(docs, labels, training, per_class))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in textbytes.texts_of(batch.column(1)):
                known = has_letter(texts) & bool(net.value.languages)
                p = text_probabilities(net.value, texts)
                best = p.argmax(axis=1)
                names = [net.value.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                score = np.where(known, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(texts.first, len(texts)), pa.array(names, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, lang_pred string, score double")
