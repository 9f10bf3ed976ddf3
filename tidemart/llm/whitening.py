"""PCA whitening of embeddings by Chebyshev-filtered subspace iteration.

The principal axes are those of the covariance V of all vectors. V is never formed: a block
Q of a few more columns than the axes asked for is multiplied by it in passes over the data,
each of which sums (x - mean)ᵀ((x - mean) Q) inside the tasks and then across them.

1. **Sums.** One pass counts the vectors and adds them up, exactly, in whole numbers.
   Every later pass centres before it multiplies: n * x - S is a whole number too.
2. **Filter.** The block is replaced by p(V) Q, with p the Chebyshev polynomial of the
   interval of unwanted eigenvalues, by its three-term recurrence, one pass a degree. On the
   interval p is at most 1, above it it grows fastest, so the unwanted spectrum is damped.
   The interval's upper end is the block's last Ritz value, its lower end the least that the
   exact trace leaves to the eigenvalues outside the block. The degree is chosen so that
   wanted columns are not amplified more than ``SPREAD`` times as much as one another.
3. **QR and Rayleigh-Ritz.** The filtered block is made orthonormal, one pass gives V Q, and
   the small matrix QᵀVQ is diagonalised. The product V Q turned by its eigenvectors is
   the first step of the next recurrence, so it costs no pass of its own.
4. **Certificate.** The residual norm of an axis bounds the distance of its eigenvalue from a true
   one. Rounds end when all residuals are at most ``TOLERANCE`` of the largest
   eigenvalue, or when they are down at rounding (below ``ROUNDING``) and no longer fall;
   a block as wide as the space is exact after one round.

One row of ``width`` numbers per dimension leaves each task; only the summed block, bounded
by dimensions times ``width``, reaches the driver. Vectors are read from their table in each
pass and nothing is written. Whitened values are measured once more: a last pass computes
their covariance, and its largest distance from the identity is returned with them.

Entries c enter as whole numbers floor(scale * c) + shift.

Defined results: vectors that are null, or hold null or non-finite entries, or entries of
2^52 or more after scaling (beyond exact doubles), give no rows, nor do vectors of another
length than the most frequent one (of equally frequent ones the longest), which have no
place among its axes. Repeated vectors count and are returned each; a null vec_id is
carried. Axes without variance (at most 1e-12 of the largest) cannot be scaled to one and
give no rows, so equal vectors, a single one, or none give none. ``deviation`` is null if it
exceeds a long. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
# Columns of the block beyond the components: the wider the gap they span, the fewer passes.
GUARD = 24
SCALE, SHIFT = 64, 1_000_000
TOLERANCE = 1e-13
ROUNDING = 1e-11
SPREAD = 1e8
MOST_DEGREE = 16
# Below this part of the largest eigenvalue an axis counts as having no variance.
FLAT = 1e-12
SEED = 12
_LIMIT = float(1 << 52)


@dataclass(frozen=True)
class Whitening:
    """Axes (columns, unit), their eigenvalues and the exact sums behind them."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    passes: int

    def whiten(self, deviations: np.ndarray) -> np.ndarray:
        """Coordinates along the axes, in standard deviations, of rows n * x - S."""
        return (deviations.astype(float) / self.n) @ (self.axes / np.sqrt(self.values))


def _usable(column: pa.Array, d: int, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows that hold d usable entries, and those rows as whole numbers."""
    column = column.cast(pa.large_list(pa.float64()))
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    rows = np.flatnonzero(lengths == d)
    entries = column.take(pa.array(rows)).flatten()
    # Null entries become NaN.
    x = np.floor(scale * np.asarray(entries.to_numpy(zero_copy_only=False), float).reshape(-1, d))
    fine = (np.abs(x) < _LIMIT).all(axis=1)
    return rows[fine], x[fine].astype(np.int64) + shift


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - S, exactly: in longs where they hold it, else in Python's whole numbers."""
    largest = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums)))
    if 2 * largest < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _square_sums(deviations: np.ndarray) -> list[int | None]:
    """Exact sums of squares of the rows; None beyond a long."""
    largest = int(np.abs(deviations).max(initial=0))
    if largest * largest * deviations.shape[1] < 1 << 63:
        return (deviations.astype(np.int64) ** 2).sum(axis=1).tolist()
    exact = (deviations.astype(object) ** 2).sum(axis=1).tolist()
    return [v if v < 1 << 63 else None for v in exact]


class _Passes:
    """Sums over all usable vectors of a table, taken in the tasks and then across them."""

    def __init__(self, vectors: DataFrame, d: int, scale: int, shift: int):
        self.vectors, self.d, self.scale, self.shift, self.taken = vectors, d, scale, shift, 0

    def summed(self, width: int, step: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``step`` (rows as whole numbers -> a table of ``width`` columns) over all batches."""
        d, scale, shift = self.d, self.scale, self.shift

        def batch_of(total: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
            parts = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), width).cast(pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), parts], ["i", "part"])

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                _, x = _usable(batch.column(0), d, scale, shift)
                if len(x):
                    part = step(x)
                    total = part if total is None else total + part
            if total is not None:
                yield batch_of(total, np.arange(len(total)))

        def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[int, np.ndarray] = {}
            for batch in batches:
                values = batch.column(1).flatten().to_numpy().reshape(-1, width)
                for i, part in zip(batch.column(0).to_pylist(), values):
                    totals[i] = totals[i] + part if i in totals else part.copy()
            if totals:
                yield batch_of(np.stack(list(totals.values())), np.array(list(totals)))

        self.taken += 1
        schema = "i int, part array<double>"
        # Each number of a table is summed in one task, the tables' rows in many.
        parts = self.vectors.mapInArrow(partial, schema).repartition("i").mapInArrow(combined, schema)
        found = parts.toArrow()
        order = np.argsort(found.column("i").to_numpy())
        return found.column("part").combine_chunks().flatten().to_numpy().reshape(-1, width)[order]

    def count_and_sums(self) -> tuple[int, tuple[int, ...]]:
        """Number of usable vectors and the exact sums of their entries."""
        d, scale, shift = self.d, self.scale, self.shift

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, x = _usable(batch.column(0), d, scale, shift)
                # 1,024 entries of less than 2^52 add up to a long; beyond that Python's whole numbers go on.
                parts = [x[at : at + 1024].sum(axis=0).astype(object) for at in range(0, len(x), 1024)]
                sums = sum(parts, np.zeros(d, object))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x)] * d, pa.int64()), pa.array(range(d), pa.int32()), pa.array(map(str, sums), pa.string())],
                    ["n", "i", "total"],
                )

        self.taken += 1
        parts = self.vectors.mapInArrow(partial, "n bigint, i int, total string")
        total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        rows = sorted(parts.groupBy("i").agg(F.sum("n").alias("n"), total).collect())
        return (rows[0]["n"], tuple(int(r["total"]) for r in rows)) if rows else (0, ())


def _orthonormal(block: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.linalg.qr(block)[0])[0]


def _growth(t: float) -> float:
    """Growth per degree of the Chebyshev polynomial at t > 1."""
    return t + np.sqrt(max(t * t - 1, 0.0))


def _degree(values: np.ndarray, wanted: int, low: float, high: float) -> int:
    """The degree up to which the wanted columns are amplified alike within ``SPREAD``."""
    middle, half = (high + low) / 2, (high - low) / 2
    first, last = (_growth((values[j] - middle) / half) for j in (0, wanted - 1))
    apart = np.log(first / last)
    return int(np.clip(np.log(SPREAD) / max(apart, 1e-9), 2, MOST_DEGREE))


def _filtered(
    product: Callable[[np.ndarray], np.ndarray],
    block: np.ndarray,
    multiplied: np.ndarray,
    degree: int,
    low: float,
    high: float,
    top: float,
) -> np.ndarray:
    """p(V) block for the scaled Chebyshev polynomial of [low, high]; ``multiplied`` is V block."""
    middle, half = (high + low) / 2, (high - low) / 2
    scaled = half / (top - middle)
    before, sigma = block, scaled
    now = (multiplied - middle * block) * (scaled / half)
    for _ in range(1, degree):
        following = 1 / (2 / scaled - sigma)
        before, now = now, (product(now) - middle * now) * (2 * following / half) - sigma * following * before
        sigma = following
    return now


def fit(passes: _Passes, components: int = COMPONENTS, guard: int = GUARD) -> Whitening | None:
    """The leading axes of the covariance of all usable vectors; None if there is no variance."""
    d = passes.d
    n, sums = passes.count_and_sums()
    if n < 2:
        return None

    def centred(x: np.ndarray) -> np.ndarray:
        return _deviations(x, n, sums).astype(float) / n

    def product(block: np.ndarray) -> np.ndarray:
        """V block: one pass."""

        def step(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ block)

        return passes.summed(block.shape[1], step) / n

    trace = float(passes.summed(1, lambda x: (centred(x) ** 2).sum(axis=0)[:, None]).sum()) / n
    if not trace:
        return None
    width, wanted = min(d, components + guard), min(d, components)
    block = _orthonormal(np.random.default_rng(SEED).standard_normal((d, width)))
    residual, multiplied = np.inf, product(block)
    while True:
        values, turn = np.linalg.eigh((block.T @ multiplied + multiplied.T @ block) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, multiplied = block @ turn, multiplied @ turn
        before = residual
        residual = float(np.linalg.norm(multiplied - block * values, axis=0)[:wanted].max() / values[0])
        if width == d or residual <= TOLERANCE or (residual <= ROUNDING and residual > before / 2):
            break
        high = max(values[-1], FLAT * values[0])
        outside = d - width
        low = float(np.clip(trace - values.sum() - (outside - 1) * high, 0, 0.99 * high))
        degree = _degree(values, wanted, low, high)
        block = _orthonormal(_filtered(product, block, multiplied, degree, low, high, values[0]))
        multiplied = product(block)
    kept = int((values[:wanted] > FLAT * values[0]).sum())
    return Whitening(n, sums, block[:, :kept], values[:kept], trace, residual, passes.taken)


def _dimension(vectors: DataFrame, column: str) -> int:
    """The most frequent length of vectors with entries; 0 if there are none."""
    counts = vectors.groupBy(F.size(column).alias("d")).agg(F.count(F.lit(1)).alias("n")).filter("d > 0")
    most = counts.orderBy(F.desc("n"), F.desc("d")).first()
    return most["d"] if most else 0


def _identity_error(passes: _Passes, model: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity: one pass."""
    k = len(model.values)

    def step(x: np.ndarray) -> np.ndarray:
        w = model.whiten(_deviations(x, model.n, model.sums))
        return np.vstack([w.T @ w, w.sum(axis=0)])

    sums = passes.summed(k, step) / model.n
    return float(np.abs(sums[:k] - np.outer(sums[k], sums[k]) - np.eye(k)).max())


def whitened(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, guard: int = GUARD
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row for every usable
    vector and component, from ``vectors`` (vec_id, embedding)."""
    kind = dict(vectors.dtypes)["vec_id"]
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double"
    )
    d = _dimension(vectors, "embedding")
    passes = _Passes(vectors.select("embedding"), d, scale, shift)
    model = fit(passes, components, guard) if d else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error, k = _identity_error(passes, model), len(model.values)
    explained = model.values / model.trace

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _usable(batch.column(1), d, scale, shift)
            deviations = _deviations(x, model.n, model.sums)
            of = np.repeat(np.arange(len(at)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at[of])),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(of), model.n)),
                    pa.array(_square_sums(deviations), pa.int64()).take(pa.array(of)),
                    pa.array(model.whiten(deviations).ravel()),
                    pa.array(np.tile(explained, len(at))),
                    pa.array(np.full(len(of), error)),
                ],
                schema.replace(",", " ").split()[::2],
            )

    return vectors.select("vec_id", "embedding").mapInArrow(rows, schema)
