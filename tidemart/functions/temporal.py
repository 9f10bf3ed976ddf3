"""Date and time expressions. All of them are built-in, code-generated functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(ts: Column, grain: str) -> Column:
    """First day of the ``day`` / ``week`` / ``month`` / ``year`` that contains ``ts``, as a DATE."""
    day = F.to_date(ts)
    return day if grain == "day" else F.to_date(F.trunc(day, grain))


def _midnight(day: dt.date) -> Column:
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def in_days(ts: Column, first: dt.date, last: dt.date) -> Column:
    """Calendar days ``first`` to ``last``, both whole.

    Written as a half-open range on the raw column so the bounds reach the
    Parquet reader as pushed filters.
    """
    return (ts >= _midnight(first)) & (ts < _midnight(last + dt.timedelta(days=1)))


def in_year(ts: Column, year: int) -> Column:
    return in_days(ts, dt.date(year, 1, 1), dt.date(year, 12, 31))


def between_instants(ts: Column, first: dt.date, last: dt.date) -> Column:
    """Closed range whose bounds are midnights: the last day counts only at 00:00:00."""
    return ts.between(_midnight(first), _midnight(last))


def since(ts: Column, start: dt.datetime) -> Column:
    return ts >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")


def months_later(ts: Column, months: int) -> Column:
    """Same day ``months`` later as a DATE; a missing day becomes the month's last."""
    return F.add_months(F.to_date(ts), months)


def full_days(end: Column, start: Column) -> Column:
    """Whole 24-hour days between two instants, rounded toward zero."""
    return F.extract(F.lit("DAY"), end - start).cast("int")


def period_key(day: Column, iso: bool = False) -> Column:
    """Week number key as an INT.

    By default the calendar year and the ISO week are written one after the
    other without padding, so the first days of January may carry week 53 and
    week 1 of 2024 is ``20241``. With ``iso`` the key is ISO year * 100 + week,
    which sorts.
    """
    week = F.weekofyear(day)
    if iso:
        return (F.extract(F.lit("YEAROFWEEK"), day) * 100 + week).cast("int")
    # Appending the week's digits, as numbers: a text per row would cost more.
    return F.year(day) * F.when(week < 10, 10).otherwise(100) + week


def date_key(day: Column) -> Column:
    """``YYYYMMDD`` as an INT."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_of_key(key: Column) -> Column:
    """The DATE behind a ``YYYYMMDD`` key."""
    return F.make_date(
        F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100
    )


def month_name(ts: Column, width: int | None = None) -> Column:
    """English month name; ``width`` blank-pads it on the right."""
    name = F.date_format(ts, "MMMM")
    return F.rpad(name, width, " ") if width else name


def day_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def month_starts(first: dt.date, last: dt.date) -> list[dt.date]:
    """Every month's first day from ``first`` to ``last``."""
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [dt.date(m // 12, m % 12 + 1, 1) for m in months]
