"""Words of whole texts in numpy, read from the bytes of an Arrow column.

Used inside Spark tasks only. Texts are taken in runs of about ``CHUNK`` bytes, so the
memory of a step is a small multiple of that, or of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18

_rng = np.random.default_rng(0x5EED)
# A random 64-bit value per byte; letters A-Z count as a-z.
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base, and of its inverse modulo 2^64, for n places."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        each = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            each.append(np.multiply.accumulate(p))
        _powers = (each[0], each[1])
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finish that spreads every bit of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Texts:
    """Consecutive texts: their bytes, and where each begins (one more entry for the end)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass(frozen=True)
class Words:
    """Words of some texts: byte ranges, hashes, the first word of each text, hashes of prefixes."""

    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray
    prefixes: np.ndarray


def texts_of(column: pa.Array, chunk: int = CHUNK) -> Iterator[Texts]:
    """The texts of a string column in order, null as empty, in runs of about ``chunk`` bytes."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk, "right")) - 1)
        yield Texts(at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        at = end


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and first-per-text of the maximal runs of True within each text."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def words_of(texts: Texts, inside: np.ndarray | None = None, prefixes: tuple[int, ...] = ()) -> Words:
    """Words (runs of ``inside``, by default of anything but white space) and their hashes.

    Hashes are those of a polynomial over the bytes, from prefix sums: A-Z equals a-z.
    ``prefixes`` asks for hashes of the words' first bytes too, one row for each number.
    """
    if inside is None:
        inside = ~SPACE[texts.data]
    start, end, bounds = runs(inside, texts.offsets)
    power, inverse = _grown(len(texts.data) + 1)
    sums = np.zeros(len(texts.data) + 1, np.uint64)
    np.cumsum(_BYTE[texts.data] * power[: len(texts.data)], out=sums[1:])

    def hashed(until: np.ndarray, salt: int) -> np.ndarray:
        return mixed((sums[until] - sums[start]) * inverse[start] + np.uint64(salt))

    heads = np.array([hashed(np.minimum(end, start + n), n) for n in prefixes], np.uint64)
    return Words(start, end, hashed(end, 0), bounds, heads)


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles.

    A text of fewer words has its whole sequence as one; one without words, none.
    """
    h = words.hashes
    salts = mixed(np.arange(1, k + 2, dtype=np.uint64))
    odd = mixed(np.arange(100, 100 + k, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(h) - k + 1)
    full = np.full(n, salts[k], np.uint64)
    for j in range(k):
        full += h[j : j + n] * odd[j]
    full = mixed(full)
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= k:
            yield _distinct(full[a : b - k + 1])
        elif b > a:
            yield mixed(salts[b - a : b - a + 1] + (h[a:b] * odd[: b - a]).sum(dtype=np.uint64, keepdims=True))
        else:
            yield full[:0]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i] : bounds[i + 1]]; the result for a segment depends on it alone."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), values.dtype)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.add.reduceat(values[: bounds[-1]], bounds[some])
    return out
