"""Measures along an ordered key: running totals, lags, latest rows, changes, shares.

The per-key measures run as plain window functions. Keys that hold more rows
than one task should sort are cut into ordered chunks instead, and each chunk
receives what it needs from the chunks before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.numeric import percent, percent_change
from tidemart.operators.ordering import CHUNK, PLACE, place_in_order
from tidemart.operators.skew import HOT_ROWS, HotSplit, fits_broadcast, join_back, null_safe_join, split_hot
from tidemart.session import write_shared


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep_ties: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The last row of each key along ``order``.

    One row per key: ``order`` should be total, and the maximum is combined
    before the shuffle, so a heavy key costs one row per task. ``keep_ties``
    returns every row that shares the last value of ``order``, however many;
    rows of a key with more than ``hot_rows`` are then not shuffled. NULL counts as a key.
    """
    keys, order = list(keys), list(order)
    if keep_ties:
        last = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_last"), F.count(F.lit(1)).alias("_rows"))
        tied = join_back(df, last, keys, "_rows", hot_rows)
        return tied.filter(F.struct(*order) == F.col("_last")).select(*df.columns)
    others = [c for c in df.columns if c not in keys and c not in order]
    last = F.max(F.struct(*order, *others)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)


# Fewer rows than this are not worth a chunk of their own.
LEAST_CHUNK = 500


def _chunks(split: HotSplit, hot_rows: int) -> int:
    """How many chunks the rows of hot keys need so that none is hot itself."""
    return -(-split.rows // max(hot_rows, LEAST_CHUNK))


def _by_key(df: DataFrame, keys: Sequence[str], ranged: bool) -> DataFrame:
    """With ``ranged``, dealt out by ranges of the key (NULL last): a later sort that begins
    with the key then needs no further shuffle."""
    if not ranged:
        return df
    return df.repartitionByRange(*[F.col(k).asc_nulls_last() for k in keys])


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    out: str,
    hot_rows: int = HOT_ROWS,
    ranged: bool = False,
) -> DataFrame:
    """Sum of ``value`` up to and including each row; rows tied on ``order`` share one total."""
    keys = list(keys)
    split = split_hot(df, keys, hot_rows)
    w = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_first())
    result = _by_key(split.rest, keys, ranged).withColumn(out, F.sum(value).over(w))
    if split.hot is None:
        return result
    hot = _chunked_total(split.hot, keys, order, value, out, _chunks(split, hot_rows))
    return result.unionByName(
        hot.withColumn(out, F.col(out).cast(result.schema[out].dataType))
    )


def _chunked_total(
    df: DataFrame, keys: list[str], order: str, value: str, out: str, chunks: int
) -> DataFrame:
    # One step per tied group, so the sort key is unique and can be cut anywhere.
    steps = df.groupBy(*keys, order).agg(F.sum(value).alias("_step"))
    placed = place_in_order(steps, [*keys, order], "running-total", chunks).rows
    by_key = Window.partitionBy(*keys).orderBy(CHUNK)
    # One row per chunk and key in it: chunks + hot keys rows in all.
    carried = (
        placed.groupBy(CHUNK, *keys)
        .agg(F.sum("_step").alias("_sum"))
        .withColumn("_carry", F.sum("_sum").over(by_key.rowsBetween(Window.unboundedPreceding, -1)))
        .drop("_sum")
    )
    carried = write_shared(carried, "carried-totals")
    inside = Window.partitionBy(CHUNK, *keys).orderBy(PLACE)
    local = placed.withColumn("_local", F.sum("_step").over(inside))
    total = F.coalesce(F.col("_carry") + F.col("_local"), F.col("_carry"), F.col("_local"))
    totals = null_safe_join(local, carried, [CHUNK, *keys], small=fits_broadcast(carried)).select(
        *keys, order, total.alias(out)
    )
    return null_safe_join(df, totals, [*keys, order])


def lag_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    n: int,
    out: str,
    hot_rows: int = HOT_ROWS,
    ranged: bool = False,
) -> DataFrame:
    """``value`` of the row ``n`` places earlier within the key, else NULL.

    ``order`` should end in a unique column so that ties have one outcome.
    """
    keys, order = list(keys), list(order)
    split = split_hot(df, keys, hot_rows)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    result = _by_key(split.rest, keys, ranged).withColumn(out, F.lag(value, n).over(w))
    if split.hot is None:
        return result
    chunks = _chunks(split, hot_rows)
    return result.unionByName(_chunked_lag(split.hot, keys, order, value, n, out, chunks))


def _chunked_lag(
    df: DataFrame, keys: list[str], order: list[str], value: str, n: int, out: str, chunks: int
) -> DataFrame:
    placed = place_in_order(df, [*keys, *order], "lag", chunks)
    # Each chunk borrows the n rows before its first one: at most n * chunks rows.
    wanted_by = [
        (position, chunk)
        for chunk, start in placed.offsets()
        for position in range(max(0, start - n), start)
    ]
    spots = placed.locate([position for position, _ in wanted_by])
    borrowed = [(*spot, chunk) for spot, (_, chunk) in zip(spots, wanted_by)]
    own = placed.rows.withColumn("_own", F.lit(True))
    rows = own
    if borrowed:
        wanted = df.sparkSession.createDataFrame(
            borrowed, f"{CHUNK} int, {PLACE} bigint, _to int"
        )
        guests = (
            placed.rows.join(F.broadcast(wanted), [CHUNK, PLACE])
            .withColumn(CHUNK, F.col("_to"))
            .withColumn("_own", F.lit(False))
            .drop("_to")
        )
        rows = own.unionByName(guests)
    w = Window.partitionBy(CHUNK, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return rows.withColumn(out, F.lag(value, n).over(w)).filter("_own").select(*df.columns, out)


def pct_change(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Change against the previous row in percent.

    For frames already aggregated to a calendar's worth of rows: the window has
    no partitions.
    """
    before = F.lag(value, 1).over(Window.orderBy(order))
    return df.withColumn(out, percent_change(F.col(value), before))


def share_of_total(df: DataFrame, value: str, out: str, digits: int = 1) -> DataFrame:
    """Each row's percentage of the column total. For small aggregated frames, as above."""
    return df.withColumn(out, percent(F.col(value), F.sum(value).over(Window.partitionBy()), digits))
