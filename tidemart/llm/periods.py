"""Periodic runs of words, by a sparse dynamic program over diagonals.

A run of period q is a longest stretch of words in which words q apart are equal. Laid out
as a dot plot of a text against itself, it is a diagonal of matches at lag q, and the run
ends where its diagonal ends. Words meet their earlier occurrences in text order; each such
occurrence lengthens the diagonal of its lag, and a diagonal that ends long enough emits
its run there and then.

**Which occurrences.** A word that fills a text has n earlier occurrences at each place, so
taking all would be quadratic. A run of period q is asked to be four periods long or more,
and that tells which occurrence carries it: let 2^k be the least power of two not below q.
From place ``start + 2^k + q - 1`` of the run to its end, the **nearest** earlier
occurrence of the last 2^k words lies exactly q back (a nearer one would give the stretch a
smaller period, and one q back needs 2^k matches on the diagonal). So a word takes part in
at most one diagonal per power of two, and n words in n log n at most. Places whose last
2^k words occur once leave the program, which ends with the last of them; in ordinary prose
after three or four powers.

**What a diagonal tells.** Diagonal pieces from place a to b at lag q in power k belong to
the run ``[a - 2^k - q + 1, b]``, exactly; no text is compared again. Pieces shorter than
asked for are dropped. Periods are smallest ones: of a stretch of four periods, every
smaller period divides q, and then the nearest occurrence is nearer than q.

The program runs over a batch of whole texts at once, in numpy inside Spark tasks. Word
numbers, not hashes, are compared, so results are exact. A step holds about 100 bytes per
word of ``CHUNK`` bytes of texts, or of the longest single text; nothing is shuffled.

Defined results: null and empty texts and texts without words have no runs and an empty
collapsed text; a null doc_id is carried; repeated rows are treated each; no rows give no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import WORD

LEAST_LENGTH = 6
LEAST_PERIODS = 4
# Bytes of text taken at once.
CHUNK = 1 << 20

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _nearest(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For keys in text order: a number per distinct key, the index of the nearest earlier equal
    key (-1 for none), and whether the key occurs more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    np.equal(ranked[1:], ranked[:-1], out=same[1:-1])
    names, before, again = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    names[order] = np.cumsum(~same[:-1]) - 1
    before[order] = np.where(same[:-1], np.r_[-1, order[:-1]], -1)
    again[order] = same[:-1] | same[1:]
    return names, before, again


def find_runs(
    words: np.ndarray, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs among numbered words, by start, then period.

    ``least_periods`` is 4 or more. Texts may follow each other if they share no numbers.
    """
    if least_periods < 4:
        raise ValueError("runs of fewer than four periods are not told by nearest occurrences")
    n = len(words)
    places, names = np.arange(n), words
    found: list[np.ndarray] = []
    span = 1
    while len(places) and (span // 2 + 1) * least_periods <= n:
        names, before, again = _nearest(names)
        lag = np.where(before >= 0, places - places[before], 0)
        lag[(lag <= span // 2) | (lag > span)] = 0
        # A diagonal goes on while the next word meets its nearest occurrence at the same lag.
        open_ = lag > 0
        goes_on = np.zeros(len(lag) + 1, bool)
        goes_on[1:-1] = open_[1:] & (lag[1:] == lag[:-1]) & (places[1:] == places[:-1] + 1)
        first, last = np.flatnonzero(open_ & ~goes_on[:-1]), np.flatnonzero(open_ & ~goes_on[1:])
        period = lag[first]
        start = places[first] - span - period + 1
        length = places[last] - start + 1
        enough = length >= np.maximum(least_length, least_periods * period)
        found.append(np.stack([start[enough], length[enough], period[enough]]))
        # The last 2 * span words of a place: those of the place and of the one span before it.
        places, names = places[again], names[again]
        at = np.full(n, -1, np.int64)
        at[places] = np.arange(len(places))
        half = np.where(places >= span, at[places - span], -1)
        both = half >= 0
        names = names[half[both]] * (len(places) + 1) + names[both]
        places = places[both]
        span *= 2
    start, length, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _numbered(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, their numbers (different from text to text), and where each text begins."""
    # bytes.split() cuts at space, tab, line feed, vertical tab, form feed and carriage return.
    words = [t.split() for t in texts]
    numbers: dict[bytes, int] = {}
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for each in words for w in each), np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat += np.repeat(np.arange(len(words)) * len(numbers), sizes)
    return words, flat, np.r_[0, np.cumsum(sizes)]


def _chunks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``CHUNK`` bytes, null as empty, with the number of the first."""
    at, size, part = 0, 0, []
    for i, value in enumerate(column.cast(pa.large_binary())):
        text = value.as_py() or b""
        if part and size + len(text) > CHUNK:
            yield at, part
            at, size, part = i, 0, []
        part.append(text)
        size += len(text)
    if part:
        yield at, part


def _collapse(words: list[bytes], dropped: np.ndarray) -> bytes:
    return b" ".join([w for w, gone in zip(words, dropped.tolist()) if not gone] if dropped.any() else words)


def _batch(texts: list[bytes]) -> Iterator[tuple[int, list, bytes]]:
    """Number of words, runs and collapsed text of each text."""
    words, numbers, bounds = _numbered(texts)
    start, length, period = find_runs(numbers)
    # +1 where a run has repeated itself, -1 behind it.
    edges = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    dropped = np.cumsum(edges[:-1]) > 0
    owner = np.searchsorted(start, bounds)
    for i, each in enumerate(words):
        a, b = owner[i], owner[i + 1]
        runs = [
            {"start": s, "length": n, "period": p}
            for s, n, p in zip((start[a:b] - bounds[i]).tolist(), length[a:b].tolist(), period[a:b].tolist())
        ]
        yield len(each), runs, _collapse(each, dropped[bounds[i] : bounds[i + 1]])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed, the text of single words
    between spaces without what runs repeat, for every row of ``docs`` (doc_id, text)."""
    kind = dict(docs.dtypes)["doc_id"]
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in _chunks(batch.column(1)):
                counts, runs, collapsed = zip(*_batch(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(part)),
                        pa.array(counts, pa.int64()),
                        pa.array(runs, run),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        found, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string"
    )


def longest(runs: Column) -> Column:
    """The longest run; of several the first, then the one of the smaller period. Null without runs."""
    order = F.transform(
        runs, lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))
    )
    return F.array_min(order)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, some texts made periodic from a place on.

    h = crc32 of the id in decimal and g = h / 10, rounded down: if h is a multiple of 10, each
    word i from place a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8)
    rounded down. Texts without words and rows without id stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    rows = rows.withColumn("n", F.size("w"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    a, p = F.col("a"), F.col("p")
    edited = F.transform("w", lambda w, i: F.when(i >= a, F.get("w", a + (i - a) % p)).otherwise(w))
    return rows.select("doc_id", F.when(a.isNotNull(), F.array_join(edited, " ")).otherwise(F.col("text")).alias("text"))
