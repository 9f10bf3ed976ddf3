"""Global order without a single task: ranks, row numbers and n-tiles.

Row numbers: a frame is range-partitioned on its full sort key, sorted inside each
partition and written once. The position of a row is then its partition's
offset plus its place in the partition, and only the per-partition row counts
travel to the driver.

N-tiles need the rows at a few positions only, which a large frame selects without being
sorted: rows of a small sample guess narrow ranges around those positions, the exact ranks
of the guesses are counted in one pass, and only rows inside the ranges that hold a wanted
position are put in order. A poor guess makes a range wider, never a result wrong.
"""

from __future__ import annotations

import bisect
import itertools
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.session import in_parallel, write_shared

CHUNK, PLACE = "_chunk", "_place"
# Rows sampled on the driver to guess where tiles begin; a range then holds about 3 % of all rows.
GUESS_ROWS = 10_000
# A frame of no more rows is sorted as a whole, which then costs less than the passes it would save.
DIRECT_ROWS = 1_000_000
# Standard deviations of a sample rank between a guess and the ends of its range.
DEVIATIONS = 3


@dataclass(frozen=True)
class SortKey:
    """One column of a sort order."""

    name: str
    descending: bool = False
    nulls_first: bool = True

    def column(self) -> Column:
        col = F.col(self.name)
        if self.descending:
            return col.desc_nulls_first() if self.nulls_first else col.desc_nulls_last()
        return col.asc_nulls_first() if self.nulls_first else col.asc_nulls_last()

    def beyond(self, value: Column) -> Column:
        """Whether a row sorts strictly after ``value`` on this key."""
        col = F.col(self.name)
        later = F.coalesce(col < value if self.descending else col > value, F.lit(False))
        if self.nulls_first:
            return later | (value.isNull() & col.isNotNull())
        return later | (value.isNotNull() & col.isNull())


def as_keys(order: Sequence[SortKey | str]) -> list[SortKey]:
    return [SortKey(k) if isinstance(k, str) else k for k in order]


@dataclass(frozen=True)
class Placed:
    """A written, sorted frame with the row count of each of its chunks."""

    rows: DataFrame
    counts: list[tuple[int, int]]

    @property
    def total(self) -> int:
        return sum(n for _, n in self.counts)

    def offsets(self) -> list[tuple[int, int]]:
        """(chunk, rows before it) in sort order."""
        starts = itertools.accumulate((n for _, n in self.counts), initial=0)
        return [(chunk, start) for (chunk, _), start in zip(self.counts, starts)]

    def locate(self, positions: Sequence[int]) -> list[tuple[int, int]]:
        """Chunk and place of the rows at the given 0-based positions."""
        offsets = self.offsets()
        starts = [start for _, start in offsets]
        found = (offsets[bisect.bisect_right(starts, p) - 1] + (p,) for p in positions)
        return [(chunk, p - start) for chunk, start, p in found]


def place_in_order(
    df: DataFrame, order: Sequence[SortKey | str], label: str, least_chunks: int = 1
) -> Placed:
    """Sort ``df`` across the cluster and number its rows chunk by chunk.

    ``order`` must be total (end in a unique column) for a repeatable result.
    There is one chunk per shuffle partition, or ``least_chunks`` if that is
    more; a heavy key with distinct sort values is spread over as many chunks as
    its share of the rows asks for.
    """
    chunks = max(least_chunks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    columns = [k.column() for k in as_keys(order)]
    at = F.col("_at")
    sorted_rows = (
        df.repartitionByRange(chunks, *columns)
        .sortWithinPartitions(*columns)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn(CHUNK, F.shiftright(at, 33).cast("int"))
        .withColumn(PLACE, at.bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_at")
    )
    written = write_shared(sorted_rows, label)
    # One row per chunk.
    counts = written.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("n")).collect()
    return Placed(written, sorted((r[CHUNK], r["n"]) for r in counts))


def global_row_number(
    df: DataFrame, order: Sequence[SortKey | str], out: str, start: int = 1
) -> DataFrame:
    """Row numbers over the whole frame, counted from ``start``."""
    placed = place_in_order(df, order, "row-number")
    if not placed.counts:
        return placed.rows.drop(CHUNK, PLACE).withColumn(out, F.lit(None).cast("bigint"))
    # One row per shuffle partition.
    offsets = df.sparkSession.createDataFrame(placed.offsets(), f"{CHUNK} int, _before bigint")
    numbered = placed.rows.join(F.broadcast(offsets), CHUNK)
    return numbered.withColumn(out, F.col("_before") + F.col(PLACE) + F.lit(start)).drop(
        CHUNK, PLACE, "_before"
    )


def ntile_starts(total: int, tiles: int) -> list[int]:
    """0-based position of the first row of tile 2, 3, ... that exists."""
    size, larger = divmod(total, tiles)
    starts = (i * size + min(i, larger) for i in range(1, tiles))
    return [s for s in starts if s < total]


def ntiles(
    df: DataFrame,
    orders: Mapping[str, Sequence[SortKey | str]],
    tiles: int,
    direct_rows: int = DIRECT_ROWS,
    guess_rows: int = GUESS_ROWS,
) -> DataFrame:
    """Split the whole frame into ``tiles`` equal parts along each of several orders.

    Same numbers as the window function, without its single task: the first row of each
    tile is selected (``tiles - 1`` rows an order), and every row is then scored by
    comparing it with those rows. ``df`` itself is neither shuffled nor joined for the result,
    and above ``direct_rows`` rows not sorted either. Neither number changes the result.
    Each order must be total, and ``df`` must give the same rows each time it is read.
    """
    keys = {out: as_keys(order) for out, order in orders.items()}
    firsts = rows_at(df, keys, lambda total: ntile_starts(total, tiles), direct_rows, guess_rows)
    types = {f.name: f.dataType for f in df.schema}
    return df.select("*", *[(F.lit(1) + _reached(firsts[out], keys[out], types)).alias(out) for out in keys])


def ntile(df: DataFrame, order: Sequence[SortKey | str], tiles: int, out: str) -> DataFrame:
    """``ntiles`` along a single order."""
    return ntiles(df, {out: order}, tiles)


def _at_or_after(row: Mapping[str, str], keys: Sequence[SortKey], types: Mapping) -> Column:
    """1 for rows that sort at or after ``row`` (values as text), else 0."""
    ahead, tied = F.lit(False), F.lit(True)
    for key in keys:
        value = F.lit(row[key.name]).cast(types[key.name])
        ahead = ahead | (tied & key.beyond(value))
        tied = tied & F.col(key.name).eqNullSafe(value)
    return (ahead | tied).cast("int")


def _reached(rows: Sequence[Mapping[str, str]], keys: Sequence[SortKey], types: Mapping) -> Column:
    """How many of ``rows`` a row sorts at or after."""
    return reduce(Column.__add__, (_at_or_after(r, keys, types) for r in rows), F.lit(0))


def _as_text(df: DataFrame, keys: Sequence[SortKey]) -> list[dict]:
    return [r.asDict() for r in df.select(*[F.col(k.name).cast("string") for k in keys]).collect()]


def _sorted_at(df: DataFrame, keys: Sequence[SortKey], positions: Sequence[int], label: str, total: int) -> list[dict]:
    """The rows at ``positions`` of a frame of ``total`` rows, by putting it in order."""
    placed = place_in_order(df.select(*[k.name for k in keys]), keys, f"tiles-{label}")
    if placed.total != total:
        raise RuntimeError("the frame gave other rows when it was read again")
    spots = placed.locate(positions)
    wanted = reduce(Column.__or__, ((F.col(CHUNK) == c) & (F.col(PLACE) == p) for c, p in spots))
    return _as_text(placed.rows.filter(wanted), keys)


def _guesses(sample: list[dict], positions: Sequence[int], total: int) -> list[dict]:
    """Rows of the sorted sample safely before and after where each position should be."""
    wanted = set()
    for p in positions:
        q = p / total
        off = math.ceil(DEVIATIONS * math.sqrt(len(sample) * q * (1 - q))) + 1
        centre = int(q * len(sample))
        wanted.update(i for i in (centre - off, centre + off) if 0 <= i < len(sample))
    return [sample[i] for i in sorted(wanted)]


def rows_at(
    df: DataFrame,
    orders: Mapping[str, Sequence[SortKey]],
    positions: Callable[[int], Sequence[int]],
    direct_rows: int = DIRECT_ROWS,
    guess_rows: int = GUESS_ROWS,
) -> dict[str, list[dict]]:
    """The rows (sort columns as text) at 0-based ``positions`` of the row count, along each order.

    One pass samples and one counts the ranks of the guesses of all orders; the orders are then
    finished at the same time.
    """
    total = df.count()
    spots = list(positions(total))
    if not spots:
        return {out: [] for out in orders}
    if total <= direct_rows:
        jobs = [lambda out=out, keys=keys: _sorted_at(df, keys, spots, out, total) for out, keys in orders.items()]
        return dict(zip(orders, in_parallel(*jobs)))
    types = {f.name: f.dataType for f in df.schema}
    names = list(dict.fromkeys(k.name for keys in orders.values() for k in keys))
    # About ``guess_rows`` rows.
    part = write_shared(df.select(*names).sample(min(1.0, guess_rows / total), 17), "tile-guesses")

    def guess(keys: Sequence[SortKey]) -> list[dict]:
        ordered = part.orderBy(*[k.column() for k in keys])
        return _guesses(_as_text(ordered, keys), spots, total)

    guessed = dict(zip(orders, in_parallel(*[lambda keys=keys: guess(keys) for keys in orders.values()])))
    counts = [
        F.sum(_at_or_after(row, orders[out], types)) for out, rows in guessed.items() for row in rows
    ]
    after = iter(df.agg(*counts).first() if counts else ())
    ranks = {out: [total - next(after) for _ in rows] for out, rows in guessed.items()}

    def finish(out: str) -> list[dict]:
        keys, rows = orders[out], guessed[out]
        # Range j lies from guess j - 1 on, range 0 before them all.
        edges = [0, *ranks[out], total]
        found, open_spots = [], []
        for p in spots:
            j = bisect.bisect_right(edges, p) - 1
            if j and edges[j] == p:
                found.append(rows[j - 1])
            else:
                open_spots.append((p, j))
        if not open_spots:
            return found
        ranges = sorted({j for _, j in open_spots})
        sizes = [edges[j + 1] - edges[j] for j in ranges]
        before = dict(zip(ranges, itertools.accumulate(sizes, initial=0)))
        inside = df.filter(_reached(rows, keys, types).isin(ranges))
        moved = [before[j] + p - edges[j] for p, j in open_spots]
        return found + _sorted_at(inside, keys, moved, out, sum(sizes))

    return dict(zip(orders, in_parallel(*[lambda out=out: finish(out) for out in orders])))
