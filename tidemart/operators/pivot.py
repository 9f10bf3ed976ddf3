"""Long to wide."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.temporal import day_label
from tidemart.session import write_shared


# Columns a discovered pivot may have.
MOST_COLUMNS = 2_000


def periods_seen(df: DataFrame, column: str, most: int = MOST_COLUMNS) -> list[dt.date]:
    """The dates of ``column`` in order; more than ``most`` raise instead of being cut.

    Distinct dates are combined before the shuffle, so a row per date and task moves. NULL is
    not a period.
    """
    dates = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    if len(dates) > most:
        raise ValueError(f"{column} has more than {most} values, too many to be columns")
    return sorted(r[0] for r in dates)


def pivot_matrix(
    df: DataFrame, index: str, column: str, value: str, values: Sequence[dt.date] | None = None
) -> DataFrame:
    """One row per ``index`` date, one column per date; labels are ``YYYY-MM-DD``.

    Without ``values`` every date that occurs gets its column: the frame is written once and
    its dates are read off the written table. With ``values`` that job is saved, and a
    date that is not among them raises; nothing is left out silently.
    """
    if values is None:
        df = write_shared(df.select(index, column, value), "pivot")
        values = periods_seen(df, column)
    labels = [d.isoformat() for d in values]
    label = day_label(F.col(column))
    unknown = F.raise_error(F.concat(F.lit(f"{column} has a value without a column: "), label))
    checked = F.when(label.isNull() | label.isin(labels), label).otherwise(unknown)
    return (
        df.select(day_label(F.col(index)).alias(index), checked.alias(column), value)
        .groupBy(index)
        .pivot(column, labels)
        .agg(F.first(value))
    )
