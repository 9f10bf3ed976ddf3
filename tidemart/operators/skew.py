"""Finding hot keys, and joins that do not funnel one key's rows into one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.session import write_shared

# A key is hot when it holds more rows than one task should sort.
HOT_ROWS = 2_000_000
# A derived side may be broadcast up to so many rows and bytes (as JSON text).
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class HotSplit:
    """Rows of hot keys apart from the rest; ``hot`` is None when no key is hot.

    ``keys`` is a written table of the hot keys, ``rows`` the number of their rows.
    """

    rest: DataFrame
    hot: DataFrame | None = None
    keys: DataFrame | None = None
    rows: int = 0


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = False
) -> DataFrame:
    """Equi-join in which a NULL key equals a NULL key; key columns come from the left.

    ``small`` marks a right side whose row bound is known, for broadcasting.
    """
    others = [c for c in right.columns if c not in keys]
    right = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *others)
    match = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys))
    joined = left.join(F.broadcast(right) if small else right, match, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> tuple[DataFrame | None, int]:
    """All keys with more than ``min_rows`` rows, as a written table, and how many rows they have.

    Counts are combined before the shuffle, so the probe moves one row per key
    and task. Writing the list keeps every later use of it identical.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    heavy = write_shared(counts.filter(F.col("_rows") > min_rows), "hot-keys")
    rows = heavy.agg(F.sum("_rows")).first()[0]
    return (heavy.select(*keys), rows) if rows else (None, 0)


def split_hot(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> HotSplit:
    """Separate the rows of hot keys from all others."""
    hot, rows = hot_keys(df, keys, min_rows)
    if hot is None:
        return HotSplit(df)
    small = fits_broadcast(hot)
    return HotSplit(
        null_safe_join(df, hot, keys, "left_anti", small=small),
        null_safe_join(df, hot, keys, "left_semi", small=small),
        hot,
        rows,
    )


def join_back(
    rows: DataFrame, totals: DataFrame, keys: Sequence[str], count: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join rows to what was aggregated from them; NULL counts as a key.

    ``totals`` has one row per key and in ``count`` how many rows went into it. It is written
    first: joined as it is, it would be made in the tasks of the join, whose hot keys Spark then
    cannot split. Keys of more than ``hot_rows`` rows, of which there can only be few, meet
    a broadcast of their totals where they are; adaptive splitting takes care of the others.
    """
    keys = list(keys)
    totals = write_shared(totals, "totals")
    hubs = totals.filter(F.col(count) > hot_rows)
    if not hubs.limit(1).count():
        return null_safe_join(rows, totals.drop(count), keys)
    small = fits_broadcast(hubs)
    hot = null_safe_join(rows, hubs.drop(count), keys, small=small)
    rest = null_safe_join(rows, hubs.select(*keys), keys, "left_anti", small=small)
    others = totals.filter(F.col(count) <= hot_rows).drop(count)
    return hot.unionByName(null_safe_join(rest, others, keys))


SKEW_JOINS = ("inner", "left", "left_semi", "left_anti")


def skew_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join a large side to a side that is unique on ``keys``.

    Rows of hot keys meet a broadcast of just those keys' partners (as few rows
    as there are hot keys); everything else is an ordinary shuffle join. Raises
    if a hot key has several partners, and for joins that keep unmatched rows
    of ``one``, which the two parts could not tell apart.
    """
    if how not in SKEW_JOINS:
        raise ValueError(f"skew_join does {', '.join(SKEW_JOINS)}, not {how}")
    keys = list(keys)
    split = split_hot(many, keys, min_rows)
    joined = split.rest.join(one, keys, how)
    if split.hot is None:
        return joined
    partners = write_shared(one.join(split.keys, keys, "left_semi"), "hot-partners")
    if partners.groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise ValueError(f"the second side is not unique on {', '.join(keys)}")
    partners = F.broadcast(partners) if fits_broadcast(partners) else partners
    return joined.unionByName(split.hot.join(partners, keys, how))


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a frame is small in rows and bytes. Looks at ``max_rows + 1`` rows at most."""
    size = F.length(F.to_json(F.struct(*df.columns)))
    rows, held = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and held <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after measuring; a larger side keeps its shuffle join.

    Meant for written or otherwise cheap tables; plain files are left to Spark's own
    size estimate.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df
