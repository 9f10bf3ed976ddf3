"""Cohort retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.numeric import percent
from tidemart.functions.temporal import bucket


def cohort_table(df: DataFrame, user: str, ts: str, grain: str = "month") -> DataFrame:
    """How much of each cohort is active in each later period.

    A user's cohort is the period of the first row. The log shrinks to one row
    per user and period before any window runs, so a user's group is no longer
    than the calendar. Every user is active in the own first period, which makes
    that cell the cohort's size and saves a second pass over the users.
    """
    active = df.filter(F.col(user).isNotNull()).select(
        F.col(user).alias("_user"), bucket(F.col(ts), grain).alias("session_date")
    )
    first = F.min("session_date").over(Window.partitionBy("_user"))
    cells = (
        active.distinct()
        .withColumn("cohort_dt", first)
        .groupBy("cohort_dt", "session_date")
        .agg(F.count("_user").alias("users_cnt"))
    )
    return with_rates(cells)


def with_rates(cells: DataFrame) -> DataFrame:
    """Cohort size and retention rate beside each cell's number of users."""
    size = F.max(F.when(F.col("session_date") == F.col("cohort_dt"), F.col("users_cnt"))).over(
        Window.partitionBy("cohort_dt")
    )
    return cells.withColumn("cohort_users_cnt", size).withColumn(
        "retention_rate", percent(F.col("users_cnt"), F.col("cohort_users_cnt"))
    )
