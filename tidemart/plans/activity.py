"""Reports over a question-and-answer site's posts and users.

Inputs follow ``schemas.POSTS`` / ``schemas.USERS``. Where a report is about
users per period, the posts shrink to one row per user and period before they
are joined or windowed, so one very active author costs no more than the
calendar has periods.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.constants import ANSWER
from tidemart.functions.temporal import (
    between_instants,
    bucket,
    in_days,
    in_year,
    month_name,
    months_later,
)
from tidemart.operators.cohorts import cohort_table
from tidemart.operators.pivot import pivot_matrix
from tidemart.operators.skew import HOT_ROWS
from tidemart.operators.windows import lag_n, pct_change, running_total, share_of_total

SUM = "decimal(18,2)"


def sample_rows(df: DataFrame, order: Sequence[str], n: int = 10, last: bool = False) -> DataFrame:
    """The first (or last) ``n`` rows along ``order``; a top-k, not a sort."""
    return df.orderBy(*[F.desc(c) if last else F.asc(c) for c in order]).limit(n)


def user_activity(report: DataFrame, user_id: int) -> DataFrame:
    """One user's rows of a report."""
    return report.filter(F.col("user_id") == user_id)


def monthly_views_total(posts: DataFrame, year: int) -> DataFrame:
    """Views per month of one year, most viewed first."""
    return (
        posts.filter(in_year(F.col("creation_date"), year))
        .groupBy(bucket(F.col("creation_date"), "month").alias("month_date"))
        .agg(F.sum("views_count").cast(SUM).alias("total_views"))
        .orderBy(F.col("total_views").desc_nulls_last(), "month_date")
    )


def active_new_users(
    posts: DataFrame,
    users: DataFrame,
    post_types: DataFrame,
    months: int = 1,
    min_posts: int = 100,
    post_type: str = ANSWER,
    per_user: bool = False,
) -> DataFrame:
    """Names whose posts of one type soon after sign-up number more than ``min_posts``.

    The window runs from the sign-up instant to midnight ``months`` later. The
    threshold applies to all users of a name together, or with ``per_user`` to
    each user alone.
    """
    kind = post_types.filter(F.col("type") == post_type).select(F.col("id").alias("post_type_id"))
    wanted = posts.join(kind, "post_type_id", "left_semi").select("user_id", "creation_date")
    people = users.select(
        F.col("id").alias("user_id"),
        "display_name",
        F.col("creation_date").alias("_from"),
        months_later(F.col("creation_date"), months).cast("timestamp_ntz").alias("_to"),
    )
    # A very active author's rows are left to adaptive skew splitting of this join.
    at = F.col("creation_date")
    instants = wanted.groupBy("user_id", at).agg(F.count(F.lit(1)).alias("_n"))
    early = instants.join(people.drop("creation_date"), "user_id").filter(
        at.between(F.col("_from"), F.col("_to"))
    )
    # Per user first: the name groups then add up a few rows per user.
    counts = early.groupBy("display_name", "user_id").agg(F.sum("_n").alias("_posts"))
    if per_user:
        counts = counts.filter(F.col("_posts") > min_posts)
    names = counts.groupBy("display_name").agg(
        F.count("user_id").alias("count"), F.sum("_posts").alias("_posts")
    )
    return names.filter(F.col("_posts") > min_posts).drop("_posts").orderBy("display_name")


def cohort_posts_by_month(
    posts: DataFrame,
    users: DataFrame,
    year: int,
    reg_months: Sequence[int],
    active_first: dt.date,
    active_last: dt.date,
    reg_year: int | None = None,
) -> DataFrame:
    """Posts per month of ``year`` by users who signed up in ``reg_months`` and were active in a range.

    Without ``reg_year`` the sign-up month counts in any year.
    """
    signup = F.col("creation_date")
    chosen = users.filter(F.month(signup).isin(list(reg_months)))
    if reg_year is not None:
        chosen = chosen.filter(in_year(signup, reg_year))
    active = (
        posts.filter(in_days(F.col("creation_date"), active_first, active_last))
        .select("user_id")
        .distinct()
    )
    per_user = (
        posts.filter(in_year(F.col("creation_date"), year))
        .groupBy("user_id", bucket(F.col("creation_date"), "month").alias("month"))
        .agg(F.count("id").alias("_posts"))
    )
    return (
        per_user.join(chosen.select(F.col("id").alias("user_id")), "user_id")
        .join(active, "user_id", "left_semi")
        .groupBy("month")
        .agg(F.sum("_posts").alias("count"))
        .orderBy(F.col("month").desc_nulls_first())
    )


def running_views(posts: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every post with its author's views so far."""
    rows = posts.select("user_id", "creation_date", "views_count")
    total = running_total(
        rows, ["user_id"], "creation_date", "views_count", "cumulative_count", hot_rows, ranged=True
    )
    return total.withColumn("cumulative_count", F.col("cumulative_count").cast(SUM)).orderBy(
        F.col("user_id").asc_nulls_last(), F.col("creation_date").asc_nulls_last()
    )


def _posts_per_day(posts: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    return (
        posts.filter(in_days(F.col("creation_date"), first, last))
        .groupBy("user_id", bucket(F.col("creation_date"), "day").alias("day"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def avg_daily_posts(
    posts: DataFrame, first: dt.date, last: dt.date, min_posts: int = 120
) -> DataFrame:
    """Mean posts per active day, for users with more than ``min_posts`` in the range."""
    return (
        _posts_per_day(posts, first, last)
        .groupBy("user_id")
        .agg(F.avg("cnt").alias("avg_daily"), F.sum("cnt").alias("_posts"))
        .filter(F.col("_posts") > min_posts)
        .drop("_posts")
        .orderBy("avg_daily", "user_id")
    )


def avg_active_days(
    posts: DataFrame, users: DataFrame, post_types: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Mean number of active days per active user, rounded to a whole number.

    Only posts of a known user and type count.
    """
    known = posts.join(
        post_types.select(F.col("id").alias("post_type_id")), "post_type_id", "left_semi"
    )
    days = _posts_per_day(known, first, last).groupBy("user_id").agg(F.count("day").alias("days"))
    members = days.join(users.select(F.col("id").alias("user_id")), "user_id", "left_semi")
    return members.agg(F.round(F.avg("days")).cast("bigint").alias("result"))


def second_last_month(
    posts: DataFrame, width: int | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every post with the month name of its author's post two before it."""
    rows = posts.select("user_id", "creation_date", "id")
    lagged = lag_n(
        rows, ["user_id"], ["creation_date", "id"], "creation_date", 2, "_before", hot_rows, ranged=True
    )
    return lagged.select(
        "user_id", "creation_date", month_name(F.col("_before"), width).alias("second_last_month")
    ).orderBy(F.col("user_id").asc_nulls_last(), F.col("creation_date").asc_nulls_last())


def cohort_retention(posts: DataFrame) -> DataFrame:
    """Monthly retention of the cohorts of first-post months."""
    return cohort_table(posts, "user_id", "creation_date", "month")


def retention_matrix(retention: DataFrame, months: Sequence[dt.date] | None = None) -> DataFrame:
    """Cohorts down, months across, the retention rate in the cells.

    Every month that occurs has its column, unless ``months`` states them.
    """
    return pivot_matrix(retention, "cohort_dt", "session_date", "retention_rate", months)


def month_over_month(posts: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Posts per month number and the change against the month before in percent.

    The range ends at midnight of ``last``.
    """
    months = (
        posts.filter(between_instants(F.col("creation_date"), first, last))
        .groupBy(F.month("creation_date").alias("creation_month"))
        .agg(F.count(F.lit(1)).alias("posts_count"))
    )
    return pct_change(months, "creation_month", "posts_count", "percentage").orderBy(
        "creation_month"
    )


def posts_share(months: DataFrame) -> DataFrame:
    """Each month's share of the range's posts, to one decimal."""
    return share_of_total(months.select("creation_month", "posts_count"), "posts_count", "share_pct")


def top_author_weekly(posts: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Per ISO week of the range, the last post of the author with most posts ever.

    The smallest id wins a tie.
    """
    author = (
        posts.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("_posts"))
        .orderBy(F.desc("_posts"), "user_id")
        .limit(1)
        .select("user_id")
    )
    return (
        posts.filter(in_days(F.col("creation_date"), first, last))
        .join(F.broadcast(author), "user_id")  # one row
        .groupBy(F.weekofyear("creation_date").alias("week_creation"))
        .agg(F.max("creation_date").alias("creation_date"))
        .orderBy("week_creation")
    )
