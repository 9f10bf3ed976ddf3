"""Retail star schema: dimension appends, the daily sales fact and the weekly retention mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.constants import REFUNDED, SHIPPED
from tidemart.functions.temporal import date_of_key, in_days, period_key
from tidemart.operators.dims import new_dim_rows
from tidemart.operators.skew import broadcast_if_small
from tidemart.schemas import CUSTOMER_RETENTION, SALES_FACT, conform


def dim_city(log: DataFrame, dim: DataFrame) -> DataFrame:
    return new_dim_rows(log, dim, "city_id", ["city_name"])


def dim_item(log: DataFrame, dim: DataFrame) -> DataFrame:
    return new_dim_rows(log, dim, "item_id", ["item_name"])


def dim_customer(log: DataFrame, dim: DataFrame) -> DataFrame:
    """New customers with the highest city id seen for them."""
    return new_dim_rows(
        log, dim, "customer_id", ["first_name", "last_name"], {"city_id": F.max("city_id")}
    )


def fact_sales(
    log: DataFrame, calendar: DataFrame, first: dt.date, last: dt.date, *extra: str
) -> DataFrame:
    """Fact rows of the days ``first`` to ``last``; a day the calendar lacks has no date id.

    One day is the daily load, a longer range a backfill. The range reaches the
    scan of the log; the calendar is one row per day. ``extra`` columns of the
    log are passed through.
    """
    days = calendar.select("date_id", F.col("date_actual").alias("_day"))
    rows = log.filter(in_days(F.col("date_time"), first, last)).withColumn(
        "_day", F.to_date("date_time")
    )
    return conform(rows.join(broadcast_if_small(days), "_day", "left"), SALES_FACT, *extra)


def fact_sales_daily(log: DataFrame, calendar: DataFrame, day: dt.date) -> DataFrame:
    return fact_sales(log, calendar, day, day)


def customer_retention_weekly(
    fact: DataFrame, by: Sequence[str] = (), iso_period: bool = False
) -> DataFrame:
    """New, returning and refunding customers per week with their revenue.

    A customer with one sale in the week is new, with several returning; refunds
    form a bucket of their own, so who buys and refunds is in two. ``by`` adds
    further grouping columns, such as an item group.
    """
    by = list(by)
    amount = F.col("payment_amount")
    sales = fact.select(
        *by,
        period_key(date_of_key(F.col("date_id")), iso_period).alias("period_id"),
        "customer_id",
        F.when(amount < 0, REFUNDED).otherwise(SHIPPED).alias("status"),
        "payment_amount",
    )
    per_customer = sales.groupBy(*by, "period_id", "customer_id", "status").agg(
        F.count(F.lit(1)).alias("_sales"), F.sum(amount).alias("_sum")
    )
    shipped = F.col("status") == SHIPPED
    buckets = {
        "new": shipped & (F.col("_sales") == 1),
        "returning": shipped & (F.col("_sales") > 1),
        "refunded": F.col("status") == REFUNDED,
    }

    def count_of(name: str):
        return F.count(F.when(buckets[name], 1))

    def sum_of(name: str):
        return F.sum(F.when(buckets[name], F.col("_sum")).otherwise(0))

    weeks = per_customer.groupBy(*by, "period_id").agg(
        count_of("new").alias("new_customers_count"),
        count_of("returning").alias("returning_customers_count"),
        count_of("refunded").alias("refunded_customer_count"),
        sum_of("new").alias("new_customers_revenue"),
        sum_of("returning").alias("returning_customers_revenue"),
        # The target column is whole-numbered; rounded, not cut.
        F.round(sum_of("refunded")).alias("customers_refunded"),
    )
    return conform(weeks, CUSTOMER_RETENTION, *by)


def retention_by_item(fact: DataFrame, item_groups: DataFrame, iso_period: bool = False) -> DataFrame:
    """The weekly mart per item group, to see which groups keep their customers."""
    grouped = fact.join(item_groups, "item_id")
    return customer_retention_weekly(grouped, ["item_group"], iso_period)
