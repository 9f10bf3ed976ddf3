"""The registered queries: plans bound to the available tables and parameters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart import constants as C
from tidemart import schemas
from tidemart.functions.temporal import in_days
from tidemart.operators import activity_state, quality
from tidemart.operators.cleaning import clean_log
from tidemart.operators.distinct import daily_bitmaps, trailing_distinct
from tidemart.plans import activity, daily_load, retail, rfm, shipping
from tidemart.session import fresh_path, in_parallel, write_shared
from tidemart.sources import adapters
from tidemart.sources.landing import (
    DAY,
    day_folder,
    name_by_day,
    read_csv,
    read_staged,
    union_generations,
    write_csv,
    write_csv_days,
)
from tidemart.sources.tables import publish_view, read_or_empty, table
from tidemart.streaming.ingest import catch_up_days, ingest_arrivals, ingest_days, stream_arrivals

Query = Callable[[SparkSession, str], DataFrame]

D = dt.date
RFM_START = dt.datetime(2000, 1, 1)
FACT_DAY = D(1995, 6, 19)
POSTS_FIRST, POSTS_LAST = D(1900, 1, 1), D(2100, 12, 31)
FACT_FIRST, FACT_LAST = D(1995, 1, 1), D(2001, 12, 31)
# Files before this day are of the generation without a status column.
STATUS_SINCE = D(1998, 1, 1)
# The first day that is delivered as a file of its own; all before it came as one export.
INCREMENTS_SINCE = D(2001, 7, 1)
# The day the catch-up run takes as today.
TODAY = D(2001, 8, 2)
SCORES = list(rfm.SCORES)

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_registry)


# --- user activity ------------------------------------------------------------


@query
def sample_rows(spark, root):
    return activity.sample_rows(adapters.users(spark, root), ["id"], 10)


@query
def sample_rows_last(spark, root):
    return activity.sample_rows(adapters.users(spark, root), ["id"], 10, last=True)


@query
def monthly_views_total(spark, root):
    return activity.monthly_views_total(adapters.posts_from_orders(spark, root), 1998)


@query
def active_new_users(spark, root):
    return activity.active_new_users(
        adapters.posts_from_orders(spark, root),
        adapters.users(spark, root),
        adapters.post_types(spark),
        months=3,
        min_posts=2,
    )


@query
def active_new_users_per_user(spark, root):
    return activity.active_new_users(
        adapters.posts_from_orders(spark, root),
        adapters.users(spark, root),
        adapters.post_types(spark),
        months=12,
        min_posts=2,
        per_user=True,
    )


@query
def cohort_posts_by_month(spark, root):
    return activity.cohort_posts_by_month(
        adapters.posts_from_orders(spark, root),
        adapters.users(spark, root),
        year=1996,
        reg_months=[1, 2, 3],
        active_first=D(1996, 10, 1),
        active_last=D(1996, 12, 31),
    )


@query
def running_views(spark, root):
    return activity.running_views(adapters.posts_from_orders(spark, root))


@query
def running_views_skewed(spark, root):
    """The same report with every busier user taken as a hot key."""
    return activity.running_views(adapters.posts_from_orders(spark, root), hot_rows=12)


@query
def avg_daily_posts(spark, root):
    return activity.avg_daily_posts(
        adapters.posts_from_events(spark, root), D(2024, 1, 8), D(2024, 1, 14), min_posts=15
    )


@query
def avg_active_days(spark, root):
    posts = adapters.posts_from_events(spark, root)
    authors = posts.select(F.col("user_id").alias("id")).distinct()
    kinds = adapters.event_types(spark)
    return activity.avg_active_days(posts, authors, kinds, D(2024, 1, 1), D(2024, 1, 7))


@query
def second_last_month(spark, root):
    return activity.second_last_month(adapters.posts_from_orders(spark, root))


@query
def second_last_month_skewed(spark, root):
    """The same report with every busier user taken as a hot key."""
    return activity.second_last_month(adapters.posts_from_orders(spark, root), hot_rows=12)


@query
def cohort_retention(spark, root):
    return activity.cohort_retention(adapters.posts_from_orders(spark, root))


@query
def cohort_retention_incremental(spark, root):
    """The same report from bitmaps of active months: a first load, then two increments, of which
    the first one repeats a part of the load."""
    posts = adapters.posts_from_orders(spark, root)
    state, at = fresh_path(spark, "activity-state"), F.col("creation_date")
    for first, last in ((POSTS_FIRST, D(1997, 12, 31)), (D(1997, 6, 1), D(1999, 6, 30)), (D(1999, 7, 1), POSTS_LAST)):
        activity_state.update(spark, state, posts.filter(in_days(at, first, last)), "user_id", "creation_date")
    return activity_state.retention(activity_state.read(spark, state))


@query
def retention_matrix(spark, root):
    return activity.retention_matrix(activity.cohort_retention(adapters.posts_from_orders(spark, root)))


@query
def month_over_month(spark, root):
    return activity.month_over_month(
        adapters.posts_from_orders(spark, root), D(1998, 9, 1), D(1998, 12, 31)
    )


@query
def posts_share(spark, root):
    return activity.posts_share(month_over_month(spark, root))


@query
def top_author_weekly(spark, root):
    return activity.top_author_weekly(
        adapters.posts_from_events(spark, root), D(2024, 1, 1), D(2024, 1, 31)
    )


@query
def user_activity(spark, root):
    posts = activity.user_activity(adapters.posts_from_orders(spark, root), 14)
    return activity.running_views(posts)


@query
def weekly_active_users(spark, root):
    """Distinct users of each kind of post in the seven days up to each day, from bitmaps per day."""
    posts = adapters.posts_from_events(spark, root)
    states = write_shared(
        daily_bitmaps(posts, F.to_date("creation_date"), ["post_type_id"], "user_id"), "daily-bitmaps"
    )
    return trailing_distinct(states, ["post_type_id"], 7, "active_users")


# --- customer segments --------------------------------------------------------


@query
def orders_since(spark, root):
    view = publish_view(rfm.orders_since(adapters.orders(spark, root), RFM_START), "orders_view")
    return view.sparkSession.table("orders_view")


@query
def orders_current_status(spark, root):
    return rfm.orders_current_status(
        adapters.orders(spark, root),
        adapters.order_status_log(spark, root),
        RFM_START,
        adapters.LOG_ORDER,
    )


@query
def rfm_segments(spark, root, newest_first=True):
    return rfm.rfm_segments(
        adapters.customers_as_users(spark, root),
        rfm.orders_since(adapters.orders(spark, root), RFM_START),
        adapters.order_statuses(spark),
        newest_first=newest_first,
    )


@query
def rfm_segments_documented(spark, root):
    return rfm_segments(spark, root, newest_first=False)


@query
def rfm_segments_status_log(spark, root):
    """The same mart over the orders view whose status comes from the log."""
    return rfm.rfm_segments(
        adapters.customers_as_users(spark, root),
        orders_current_status(spark, root),
        adapters.order_statuses(spark),
    )


@query
def rfm_segment_balance(spark, root):
    return quality.segment_balance(rfm_segments(spark, root), SCORES)


# --- deliveries ---------------------------------------------------------------


@query
def dim_country_rates(spark, root):
    return shipping.dim_country_rates(adapters.shipping_log(spark, root))


@query
def dim_agreement(spark, root):
    return shipping.dim_agreement(adapters.shipping_log(spark, root))


@query
def dim_transfer(spark, root):
    return shipping.dim_transfer(adapters.shipping_log(spark, root))


@query
def shipping_info(spark, root):
    log = adapters.shipping_log(spark, root)
    texts = write_shared(shipping.description_counts(log), "descriptions")
    countries, transfers = in_parallel(
        lambda: write_shared(shipping.dim_country_rates(texts), "countries"),
        lambda: write_shared(shipping.dim_transfer(texts), "transfers"),
    )
    return shipping.shipping_info(log, countries, transfers)


@query
def shipping_status(spark, root):
    return shipping.shipping_status(adapters.shipping_log(spark, root))


@query
def shipping_status_ties(spark, root):
    """States by day, so that several share the last one, and a third of the orders as one delivery."""
    key = F.col("shippingid")
    log = adapters.shipping_log(spark, root).withColumns({
        "shippingid": F.when(key % 3 == 0, 0).otherwise(key),
        "state_datetime": F.to_date("state_datetime").cast("timestamp_ntz"),
    })
    return shipping.shipping_status(log, keep_ties=True)


@query
def shipping_datamart(spark, root):
    log = adapters.shipping_log(spark, root)
    countries, agreements, transfers = shipping.shipping_dims(log)
    mart = shipping.shipping_datamart(
        shipping.shipping_info(log, countries, transfers),
        shipping.shipping_status(log),
        countries,
        agreements,
        transfers,
    )
    return publish_view(mart, "shipping_datamart")


@query
def vendor_quality(spark, root):
    # Every delivery has its country and transfer in the dimensions made of the same log, so
    # joining them would remove none.
    log = adapters.shipping_log(spark, root)
    deliveries = log.select("shippingid", "vendorid", "shipping_plan_datetime").distinct()
    return shipping.vendor_quality(deliveries, shipping.shipping_status(log))


# --- retail -------------------------------------------------------------------


def _two_generations(spark, root, since: dt.date) -> tuple[DataFrame, DataFrame]:
    """The order log as files looked before and after the status column came."""
    log = adapters.order_log(spark, root)
    is_old = F.to_date("date_time") < F.lit(since)
    new = log.filter(~is_old).select(F.col("id").alias("Unnamed: 0"), "*")
    return log.filter(is_old).drop("status"), new


def _land_orders(spark, root) -> str:
    """Export the order log as a feed: one history folder, then a folder per day."""
    feed = fresh_path(spark, "landing")
    history, daily = _two_generations(spark, root, INCREMENTS_SINCE)
    exported_on = INCREMENTS_SINCE - dt.timedelta(days=1)
    daily = daily.withColumn(DAY, F.to_date("date_time"))
    in_parallel(
        lambda: write_csv(history, day_folder(f"{feed}/history", exported_on)),
        lambda: write_csv_days(daily, f"{feed}/increments", "id"),
    )
    return feed


def _cleaned(spark, root, dedupe: bool) -> DataFrame:
    old, new = _two_generations(spark, root, STATUS_SINCE)
    files = in_parallel(
        lambda: write_csv(old, fresh_path(spark, "landing")),
        lambda: write_csv(new, fresh_path(spark, "landing")),
    )
    cleaned = [clean_log(read_csv(spark, [f]), dedupe=dedupe) for f in files]
    return schemas.conform(union_generations(cleaned), schemas.USER_ORDER_LOG)


@query
def clean_order_log(spark, root):
    return _cleaned(spark, root, dedupe=False)


@query
def clean_order_log_deduped(spark, root):
    return _cleaned(spark, root, dedupe=True)


@query
def daily_increment(spark, root):
    """All landed folders through the file stream, then the catch-up days once more."""
    feed = _land_orders(spark, root)
    staging = fresh_path(spark, "staging")
    target = schemas.USER_ORDER_LOG
    stream_arrivals(spark, feed, staging, target, fresh_path(spark, "ingest-state"))
    ingest_days(spark, feed, staging, target, catch_up_days(TODAY))
    return read_staged(spark, staging, target)


@query
def daily_increment_dated(spark, root):
    """The same feed as files named by their day, taken in by comparing file lists."""
    feed = _land_orders(spark, root)
    name_by_day(spark, f"{feed}/increments", "user_order_log_inc.csv")
    staging, state = fresh_path(spark, "staging"), fresh_path(spark, "ingest-state")
    ingest_arrivals(spark, feed, staging, schemas.USER_ORDER_LOG, state)
    return read_staged(spark, staging, schemas.USER_ORDER_LOG)


def _loaded(spark, root, weekly: bool = False) -> str:
    """A warehouse after the whole load: all files staged, dimensions appended, the days of the
    increments loaded, the history's days backfilled; ``weekly`` keeps the mart up to date."""
    feed, warehouse = _land_orders(spark, root), fresh_path(spark, "warehouse")
    calendar = write_shared(adapters.calendar(spark, root), "calendar")
    exported_on = INCREMENTS_SINCE - dt.timedelta(days=1)
    days = [exported_on + dt.timedelta(days=n) for n in range((FACT_LAST - exported_on).days + 1)]
    daily_load.load_days(spark, feed, warehouse, calendar, [d.isoformat() for d in days])
    if weekly:
        daily_load.rebuild_retention(spark, warehouse)
    daily_load.load_fact(spark, warehouse, calendar, FACT_FIRST, exported_on)
    if weekly:
        # Only the periods of the backfilled days.
        daily_load.rebuild_retention(spark, warehouse)
    return warehouse


@query
def retail_load_fact(spark, root):
    return read_staged(spark, f"{_loaded(spark, root)}/mart/f_sales", schemas.SALES_FACT)


@query
def retail_load_dims(spark, root):
    """The three dimensions one below the other."""
    mart = f"{_loaded(spark, root)}/mart"

    def dim(name: str, schema):
        return read_or_empty(spark, f"{mart}/{name}", schema)

    city = dim("d_city", schemas.DIM_CITY).select(
        F.lit("city").alias("dim"), F.col("city_id").cast("long").alias("id"), F.col("city_name").alias("name")
    )
    item = dim("d_item", schemas.DIM_ITEM).select(F.lit("item").alias("dim"), "item_id", "item_name")
    customer = dim("d_customer", schemas.DIM_CUSTOMER).select(
        F.lit("customer").alias("dim"), "customer_id", F.concat_ws("#", "first_name", "last_name", "city_id")
    )
    return city.union(item).union(customer)


@query
def retail_load_weekly(spark, root):
    return daily_load.read_retention(spark, _loaded(spark, root, weekly=True))


def _staged_feed(spark, feed: DataFrame, schema, ts: str) -> DataFrame:
    """Land a feed as a folder per day, stage all days and read them back."""
    daily = feed.select(F.xxhash64(*feed.columns).alias("id"), "*", F.to_date(ts).alias(DAY))
    landed, staging = fresh_path(spark, "landing"), fresh_path(spark, "staging")
    write_csv_days(daily, f"{landed}/increments", "id")
    ingest_days(spark, landed, staging, schema, ts=ts)
    return read_staged(spark, staging, schema).drop(DAY)


@query
def stage_customer_research(spark, root):
    feed = adapters.customer_research(spark, root)
    return _staged_feed(spark, feed, schemas.CUSTOMER_RESEARCH, "date_id")


@query
def stage_user_activity(spark, root):
    feed = adapters.user_activity_log(spark, root)
    return _staged_feed(spark, feed, schemas.USER_ACTIVITY_LOG, "date_time")


@query
def dim_city(spark, root):
    """New cities when those of one region are loaded already."""
    region = table(spark, root, "region").filter("r_name = 'AFRICA'")
    loaded = table(spark, root, "nation").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi"
    )
    dim = loaded.select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city_name"))
    return retail.dim_city(adapters.order_log(spark, root), dim)


@query
def dim_item(spark, root):
    """New items when those of one type are loaded already."""
    loaded = table(spark, root, "part").filter("p_type = 'ECONOMY'")
    dim = loaded.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"))
    return retail.dim_item(adapters.order_log(spark, root), dim)


@query
def dim_customer(spark, root):
    """New customers when those of one segment are loaded already."""
    loaded = table(spark, root, "customer").filter("c_mktsegment = 'HOUSEHOLD'")
    dim = loaded.select(F.col("c_custkey").alias("customer_id"))
    return retail.dim_customer(adapters.order_log(spark, root), dim)


def _fact(spark, root, first, last) -> DataFrame:
    log = clean_log(adapters.order_log(spark, root))
    calendar = write_shared(adapters.calendar(spark, root), "calendar")
    return retail.fact_sales(log, calendar, first, last)


@query
def fact_sales_daily(spark, root):
    return _fact(spark, root, FACT_DAY, FACT_DAY)


@query
def fact_sales_backfill(spark, root):
    return _fact(spark, root, FACT_FIRST, FACT_LAST)


@query
def customer_retention_weekly(spark, root):
    return retail.customer_retention_weekly(adapters.sales_fact(spark, root))


@query
def customer_retention_iso_weekly(spark, root):
    return retail.customer_retention_weekly(adapters.sales_fact(spark, root), iso_period=True)


@query
def retention_by_item(spark, root):
    return retail.retention_by_item(
        adapters.sales_fact(spark, root), adapters.item_groups(spark, root)
    )


# --- data quality -------------------------------------------------------------


@query
def dq_duplicates(spark, root):
    return quality.duplicate_counts(table(spark, root, "lineitem"))


@query
def dq_nulls(spark, root):
    return quality.null_counts(orders_current_status(spark, root))


@query
def dq_pk_violations(spark, root):
    return quality.pk_violations(table(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_orphans(spark, root):
    return quality.orphans(
        table(spark, root, "orders").select("o_orderkey", "o_custkey"),
        table(spark, root, "lineitem"),
        "o_orderkey",
        "l_orderkey",
    )


@query
def dq_rules(spark, root):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return quality.rule_violations(
        table(spark, root, "lineitem"),
        {
            "price_positive": price > 0,
            "discount_at_most_price": discount * price <= price,
            "discount_set": discount > 0,
            "flag_one_letter": F.length("l_returnflag") <= 1,
        },
    )


@query
def row_count(spark, root):
    return quality.row_count(rfm_segments(spark, root))
