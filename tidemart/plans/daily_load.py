"""The retail load from landing files to the weekly mart.

Layout under a warehouse folder: ``staging/user_order_log`` by day of the file,
``mart/f_sales`` by day of the row, ``mart/d_city``, ``mart/d_item``, ``mart/d_customer`` appended,
``mart/f_customer_retention`` by period. Every step can be run again: staging and
fact days are replaced, and only keys a dimension lacks are appended. Each table is a list of
committed versions, so a step that fails leaves its table as it was.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions.temporal import date_of_key, period_key
from tidemart.plans import retail
from tidemart.schemas import conform
from tidemart.session import in_parallel
from tidemart.sources import versions
from tidemart.sources.landing import DAY, read_staged, stage_days
from tidemart.sources.tables import append_rows, read_or_empty
from tidemart.streaming.ingest import ingest_days

STAGING = "staging/user_order_log"
PERIOD = "period"
# The period of rows on days the calendar lacks.
NO_PERIOD = "none"

_DIMS = {
    "d_item": (retail.dim_item, schemas.DIM_ITEM),
    "d_city": (retail.dim_city, schemas.DIM_CITY),
    "d_customer": (retail.dim_customer, schemas.DIM_CUSTOMER),
}


def load_day(
    spark: SparkSession, feed: str, warehouse: str, calendar: DataFrame, day: dt.date
) -> None:
    """One day's run."""
    load_days(spark, feed, warehouse, calendar, [day.isoformat()])


def load_days(
    spark: SparkSession, feed: str, warehouse: str, calendar: DataFrame, days: Sequence[str]
) -> None:
    """Stage the files of the given days, then bring dimensions and fact up to date.

    Several days go through in one pass. The fact receives the rows dated from
    the first to the last of these days; a history export holds older rows too,
    which ``load_fact`` brings in.
    """
    target = schemas.USER_ORDER_LOG
    if not ingest_days(spark, feed, f"{warehouse}/{STAGING}", target, days):
        return
    log = read_staged(spark, f"{warehouse}/{STAGING}", target, days)

    def append(name: str) -> None:
        new_rows, schema = _DIMS[name]
        path = f"{warehouse}/mart/{name}"
        append_rows(new_rows(log, read_or_empty(spark, path, schema)), path, schema)

    in_parallel(*[lambda name=name: append(name) for name in _DIMS])
    first, last = (dt.date.fromisoformat(d) for d in (min(days), max(days)))
    load_fact(spark, warehouse, calendar, first, last)


def load_fact(
    spark: SparkSession, warehouse: str, calendar: DataFrame, first: dt.date, last: dt.date
) -> None:
    """Replace the fact days ``first`` to ``last`` with what staging holds for them.

    Staging is kept by the day of the file, the fact by the day of the row, so
    rows that came late or with a history export are found in whichever file
    brought them. A row is never later than its file's day (``ingest_days`` raises on
    one), so folders before ``first`` are not opened. Days of the range without rows
    are emptied.
    """
    log = read_staged(spark, f"{warehouse}/{STAGING}", schemas.USER_ORDER_LOG)
    log = log.filter(F.col(DAY) >= first.isoformat())
    dated = log.withColumn(DAY, F.to_date("date_time").cast("string"))
    fact = retail.fact_sales(dated, calendar, first, last, DAY)
    days = [(first + dt.timedelta(days=n)).isoformat() for n in range((last - first).days + 1)]
    stage_days(fact, f"{warehouse}/mart/f_sales", by_day=False, days=days)


def _period_names(fact: DataFrame, iso_period: bool) -> DataFrame:
    """dt and the period of its rows as text, each pair once."""
    period = period_key(date_of_key(F.col("date_id")), iso_period)
    return fact.select(DAY, F.coalesce(period.cast("string"), F.lit(NO_PERIOD)).alias(PERIOD)).distinct()


def rebuild_retention(
    spark: SparkSession, warehouse: str, iso_period: bool = False, full: bool = False
) -> list[str]:
    """Bring the weekly mart up to date with the fact table; returns the periods recomputed.

    The mart's version notes the fact version it was made from and the periods of each fact day.
    Days that another write has replaced since then tell which periods are touched; only the
    days of those are read, and only those periods replaced. ``full``, another kind of
    period, or a fact version that is no longer kept, recompute all.
    """
    fact_path, path = f"{warehouse}/mart/f_sales", f"{warehouse}/mart/f_customer_retention"
    now, mart = versions.latest(spark, fact_path), versions.latest(spark, path)
    made_from = mart.notes.get("fact_version")
    before = versions.version_of(spark, fact_path, made_from) if made_from else None
    if full or before is None or mart.notes.get("iso_period") != iso_period:
        before, known, touched = versions.Version(), {}, set(mart.parts)
    else:
        known, touched = dict(mart.notes["periods"]), set()

    def days(wanted) -> DataFrame:
        return versions.read_table(spark, fact_path, schemas.SALES_FACT, DAY, wanted, now)

    changed = {d for d in {*before.parts, *now.parts} if before.parts.get(d) != now.parts.get(d)}
    for day in changed:
        touched.update(known.pop(day, []))
    # A row per day and period.
    for row in _period_names(days(changed), iso_period).collect():
        known.setdefault(row[DAY], []).append(row[PERIOD])
        touched.add(row[PERIOD])
    if not touched and mart.number:
        return []
    weekly = retail.customer_retention_weekly(
        days(d for d, periods in known.items() if touched.intersection(periods)), iso_period=iso_period
    )
    rows = conform(weekly, schemas.CUSTOMER_RETENTION).withColumn(
        PERIOD, F.coalesce(F.col("period_id").cast("string"), F.lit(NO_PERIOD))
    )
    notes = {"fact_version": now.number, "iso_period": iso_period, "periods": known}
    wanted = sorted(touched)
    versions.replace_parts(rows.filter(F.col(PERIOD).isin(wanted)), path, PERIOD, wanted, notes)
    return wanted


def read_retention(spark: SparkSession, warehouse: str) -> DataFrame:
    """The weekly mart."""
    mart = versions.read_table(
        spark, f"{warehouse}/mart/f_customer_retention", schemas.CUSTOMER_RETENTION, PERIOD
    )
    return mart.drop(PERIOD)
