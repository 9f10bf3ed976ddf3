"""Mart semantics on hand-written rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.operators import quality
from tidemart.operators.cleaning import clean_log
from tidemart.operators.cohorts import cohort_table
from tidemart.operators.dims import new_dim_rows
from tidemart.operators.pivot import periods_seen, pivot_matrix
from tidemart.plans import activity, retail, rfm, shipping

T, D, M = dt.datetime, dt.date, Decimal


def ordered(found):
    """Sorted with NULLs first."""
    return sorted(found, key=lambda r: [(v is not None, v if v is not None else 0) for v in r])


def rows(df, *columns):
    return ordered(tuple(r) for r in (df.select(*columns) if columns else df).collect())


# --- user activity ------------------------------------------------------------


@pytest.fixture
def site(spark):
    users = spark.createDataFrame(
        [(1, "Ann", T(2023, 1, 31, 10)), (2, "Ann", T(2023, 3, 1)), (3, "Bob", T(2023, 1, 1))],
        schemas.USERS,
    )
    posts = [
        (1, 1, T(2023, 1, 31, 10)), (2, 1, T(2023, 2, 28)), (3, 1, T(2023, 2, 28, 1)),
        (4, 2, T(2023, 3, 2)), (5, 3, T(2022, 12, 31)), (6, 3, T(2023, 1, 15)),
    ]
    frame = spark.createDataFrame([(*p, M(1), "a") for p in posts], schemas.POSTS)
    types = spark.createDataFrame([("a", "Answer"), ("q", "Question")], "id string, type string")
    return frame, users, types


def test_active_new_users_counts_by_name(site):
    # User 1 has two posts up to midnight of 28 February, user 2 one: three for the name.
    got = activity.active_new_users(*site, min_posts=2)
    assert rows(got) == [("Ann", 2)]
    alone = activity.active_new_users(*site, min_posts=1, per_user=True)
    assert rows(alone) == [("Ann", 1)]
    assert rows(activity.active_new_users(*site, min_posts=0, post_type="Question")) == []


def test_cohort_posts_registration_year(site):
    posts, users, _ = site
    span = dict(year=2023, reg_months=[1], active_first=D(2023, 2, 1), active_last=D(2023, 2, 28))
    want = [(D(2023, 1, 1), 1), (D(2023, 2, 1), 2)]
    assert rows(activity.cohort_posts_by_month(posts, users, **span)) == want
    assert rows(activity.cohort_posts_by_month(posts, users, **span, reg_year=2022)) == []


def test_golden_retention(spark):
    active = {1: [7, 8, 10, 12], 2: [7, 8, 9, 10, 12], 3: [7, 11]}
    log = [(u, T(2008, m, 5, 3)) for u, months in active.items() for m in months for _ in range(2)]
    table = cohort_table(spark.createDataFrame(log, "u bigint, ts timestamp_ntz"), "u", "ts")
    got = rows(table, "session_date", "users_cnt", "cohort_users_cnt", "retention_rate")
    assert [r[1] for r in got] == [3, 2, 1, 2, 1, 2]
    assert {r[2] for r in got} == {3}
    assert [r[3] for r in got] == [100.0, 66.67, 33.33, 66.67, 33.33, 66.67]
    months = [D(2008, m, 1) for m in range(7, 13)] + [D(2009, 1, 1)]
    wide = pivot_matrix(table, "cohort_dt", "session_date", "retention_rate", months)
    assert rows(wide) == [("2008-07-01", 100.0, 66.67, 33.33, 66.67, 33.33, 66.67, None)]
    with pytest.raises(Exception, match="without a column: 2008-08-01"):
        pivot_matrix(table, "cohort_dt", "session_date", "retention_rate", months[:1]).collect()
    args = ("cohort_dt", "session_date", "retention_rate")
    found = pivot_matrix(table, *args)
    assert found.columns == ["cohort_dt", *[m.isoformat() for m in months[:6]]]
    assert rows(found) == [("2008-07-01", 100.0, 66.67, 33.33, 66.67, 33.33, 66.67)]
    later = spark.createDataFrame([(D(2008, 7, 1), D(2031, 2, 1), 1.5), (D(2008, 7, 1), None, None)], table.select(*args).schema)
    late = pivot_matrix(table.select(*args).unionByName(later), *args)
    assert late.columns[-1] == "2031-02-01" and late.first()[-1] == 1.5
    assert pivot_matrix(table.limit(0), *args).columns == ["cohort_dt"]
    with pytest.raises(ValueError, match="more than 5 values"):
        periods_seen(table, "session_date", 5)


def test_month_over_month_excludes_last_day(spark):
    times = [T(2008, 9, 2)] * 4 + [T(2008, 10, 2)] * 5 + [T(2008, 10, 31, 5)]
    posts = spark.createDataFrame([(i, 1, t, M(1), "a") for i, t in enumerate(times)], schemas.POSTS)
    months = activity.month_over_month(posts, D(2008, 9, 1), D(2008, 10, 31))
    assert rows(months) == [(9, 4, None), (10, 5, 25.0)]
    assert rows(activity.posts_share(months), "share_pct") == [(44.4,), (55.6,)]


def test_sample_rows_ends(spark):
    df = spark.range(100)
    assert rows(activity.sample_rows(df, ["id"], 2)) == [(0,), (1,)]
    assert rows(activity.sample_rows(df, ["id"], 2, last=True)) == [(98,), (99,)]


# --- customer segments --------------------------------------------------------


@pytest.fixture
def shop(spark):
    users = spark.createDataFrame([(i,) for i in range(1, 6)], "id bigint")
    orders = spark.createDataFrame(
        [
            (1, 10, T(2021, 1, 5), M(50), 4),
            (2, 20, T(2021, 1, 9), M(10), 4),
            (2, 21, T(2021, 2, 9), M(10), 4),
            (3, 30, T(2021, 1, 5), M(900), 5),
            (4, 40, T(2021, 3, 1), M(70), 4),
        ],
        schemas.ORDERS,
    )
    statuses = spark.createDataFrame([(4, "Closed"), (5, "Cancelled")], "id int, key string")
    return users, orders, statuses


def test_rfm_keeps_everyone_and_both_recency_readings(shop):
    coded = rows(rfm.rfm_segments(*shop))
    # Never ordered first (3, 5), then newest to oldest: 4, 2, 1.
    assert [(u, r) for u, r, *_ in coded] == [(1, 5), (2, 4), (3, 1), (4, 3), (5, 2)]
    worded = rows(rfm.rfm_segments(*shop, newest_first=False))
    assert [(u, r) for u, r, *_ in worded] == [(1, 3), (2, 4), (3, 1), (4, 5), (5, 2)]
    assert [(u, f, m) for u, _, f, m in coded] == [
        (1, 3, 4), (2, 5, 3), (3, 1, 1), (4, 4, 5), (5, 2, 2),
    ]


def test_rfm_over_status_log_view(spark, shop):
    users, orders, statuses = shop
    log = orders.select(
        F.col("order_id").alias("id"), "order_id", F.lit(5).alias("status_id"), F.col("order_ts").alias("dttm")
    ).unionByName(
        orders.select(
            (F.col("order_id") + 1000).alias("id"), "order_id",
            F.col("status").alias("status_id"), F.col("order_ts").alias("dttm"),
        )
    )
    view = rfm.orders_current_status(orders.drop("status"), log, T(2021, 1, 1))
    assert rows(view.select(*orders.columns)) == rows(orders)
    assert rows(rfm.rfm_segments(users, view, statuses)) == rows(rfm.rfm_segments(*shop))
    none = rfm.orders_current_status(orders.drop("status"), log.filter("order_id <> 10"), T(2021, 1, 1))
    assert rows(none.filter("status is null"), "order_id") == [(10,)]


def test_orders_since_is_inclusive(shop):
    assert rfm.orders_since(shop[1], T(2021, 2, 9)).count() == 2


def test_segment_balance(spark):
    even = spark.createDataFrame([(1,), (2,), (2,)], "s int")
    assert rows(quality.segment_balance(even, ["s"])) == [("s", 1, 1, True), ("s", 2, 2, True)]
    odd = spark.createDataFrame([(1,), (2,), (2,), (2,)], "s int")
    assert {r[3] for r in rows(quality.segment_balance(odd, ["s"]))} == {False}


# --- deliveries ---------------------------------------------------------------


def delivery(spark, steps, **fixed):
    base = dict(
        shippingid=1, vendorid=3, payment_amount=M("100.00"), plan=T(2024, 1, 5),
        transfer="1p:car", rate=M("0.025"), country="X", base=M("0.010"),
        agreement="12:vsp-34:0.02:0.023",
    ) | fixed
    data = [
        (
            n, base["shippingid"], base["vendorid"], base["payment_amount"], at, status, state,
            base["plan"], base["transfer"], base["rate"], base["country"], base["base"],
            base["agreement"],
        )
        for n, (state, status, at) in enumerate(steps, base["shippingid"] * 10)
    ]
    return spark.createDataFrame(data, schemas.SHIPPING_LOG)


def mart(log):
    countries, transfers = shipping.dim_country_rates(log), shipping.dim_transfer(log)
    return shipping.shipping_datamart(
        shipping.shipping_info(log, countries, transfers), shipping.shipping_status(log),
        countries, shipping.dim_agreement(log), transfers,
    )


def test_delivery_marts(spark):
    booked = ("booked", "in_progress", T(2024, 1, 1, 12))
    late = delivery(spark, [booked, ("recieved", "finished", T(2024, 1, 7, 11))])
    worded = delivery(spark, [booked, ("received", "finished", T(2024, 1, 4, 12))], shippingid=2)
    never = delivery(spark, [booked, ("pending", "in_progress", T(2024, 1, 3))], shippingid=3)
    back = delivery(
        spark,
        [booked, ("recieved", "finished", T(2024, 1, 3)), ("returned", "finished", T(2024, 1, 9))],
        shippingid=4,
    )
    log = late.unionByName(worded).unionByName(never).unionByName(back)
    got = rows(
        mart(log), "shippingid", "full_day_at_shipping", "is_delay", "is_shipping_finish",
        "delay_day_at_shipping", "vat", "profit",
    )
    vat, profit = M("5.50000"), M("2.30000")
    assert got == [
        (1, 5, 1, 1, 2, vat, profit), (2, 3, 0, 1, 0, vat, profit),
        (3, None, 0, 0, 0, vat, profit), (4, 1, 0, 1, 0, vat, profit),
    ]
    as_spelled = shipping.shipping_status(log, received_states=["recieved"])
    assert rows(as_spelled.filter("shipping_end_fact_datetime is null"), "shippingid") == [(2,), (3,)]
    info = shipping.shipping_info(log, shipping.dim_country_rates(log), shipping.dim_transfer(log))
    quality_of = shipping.vendor_quality(info, shipping.shipping_status(log))
    assert rows(quality_of) == [(3, 4, 25.0, 25.0, 25.0)]


def test_last_state_ties(spark):
    at = T(2024, 1, 2)
    log = delivery(spark, [("queued", "in_progress", at), ("pending", "finished", at)])
    assert rows(shipping.shipping_status(log), "state") == [("pending",)]
    both = shipping.shipping_status(log, keep_ties=True)
    assert rows(both, "state") == [("pending",), ("queued",)]


def test_country_with_two_rates_fans_out(spark):
    steps = [("booked", "in_progress", T(2024, 1, 1))]
    log = delivery(spark, steps).unionByName(delivery(spark, steps, shippingid=2, base=M("0.02")))
    countries = shipping.dim_country_rates(log)
    assert rows(countries) == [(1, "X", M("0.010")), (2, "X", M("0.020"))]
    assert shipping.shipping_info(log, countries, shipping.dim_transfer(log)).count() == 4
    assert rows(quality.pk_violations(countries, ["shipping_country"])) == [("X", 2)]


def test_transfer_texts_with_repeated_separators(spark):
    steps = [("booked", "in_progress", T(2024, 1, 1))]
    log = delivery(spark, steps).unionByName(
        delivery(spark, steps, shippingid=2, transfer="1p::car", rate=M("0.030"))
    )
    assert rows(shipping.dim_transfer(log)) == [(1, "1p", "car", M("0.028"))]
    assert shipping.shipping_info(log, shipping.dim_country_rates(log), shipping.dim_transfer(log)).count() == 2


def test_dims_from_description_counts_equal_dims_from_log(spark):
    steps = [("booked", "in_progress", T(2024, 1, 1)), ("queued", "in_progress", T(2024, 1, 2))]
    log = delivery(spark, steps).unionByName(
        delivery(spark, steps[:1], shippingid=2, transfer="1p::car", rate=M("0.030"), base=M("0.02"))
    )
    countries, agreements, transfers = shipping.shipping_dims(log)
    assert rows(countries) == rows(shipping.dim_country_rates(log))
    assert rows(agreements) == rows(shipping.dim_agreement(log))
    assert rows(transfers) == rows(shipping.dim_transfer(log)) == [(1, "1p", "car", M("0.027"))]


def test_agreement_rate_scale(spark):
    steps = [("booked", "in_progress", T(2024, 1, 1))]
    log = delivery(spark, steps, agreement="12:vsp-34:0.025:0.023")
    assert rows(shipping.dim_agreement(log), "agreement_rate") == [(M("0.03"),)]
    assert rows(shipping.dim_agreement(log, rate_scale=3), "agreement_rate") == [(M("0.025"),)]


# --- retail -------------------------------------------------------------------


def test_cleaning_rules(spark):
    df = spark.createDataFrame(
        [("1", "0", "5.00", "refunded"), ("1", "1", "7.00", None), ("2", "2", None, "refunded"), ("2", "2", "3.00", "shipped")],
        "id string, `Unnamed: 0` string, payment_amount string, status string",
    ).withColumn("payment_amount", F.col("payment_amount").cast("decimal(14,2)"))
    got = clean_log(df)
    assert got.columns == ["payment_amount"]
    assert rows(got) == [(None,), (M("-5.00"),), (M("3.00"),), (M("7.00"),)]
    assert clean_log(df, dedupe=True).count() == 2
    plain = df.drop("status", "Unnamed: 0")
    assert rows(clean_log(plain)) == [(None,), (M("3.00"),), (M("5.00"),), (M("7.00"),)]


def test_new_dim_rows_and_nulls(spark):
    log = spark.createDataFrame(
        [(1, "A"), (1, "A"), (2, "B"), (2, "Bee"), (None, "N")], "city_id int, city_name string"
    )
    held = spark.createDataFrame([(1, "A"), (None, None)], "city_id int, city_name string")
    got = retail.dim_city(log, held)
    # A name change within one load gives one row per name; the NULL in the dimension blocks nothing.
    assert rows(got) == [(2, "B"), (2, "Bee")]
    assert rows(quality.pk_violations(got, ["city_id"])) == [(2, 2)]
    empty = spark.createDataFrame([], "city_id int, city_name string")
    assert rows(retail.dim_city(log, empty), "city_id") == [(1,), (2,), (2,)]


def test_anti_join_equals_not_in_without_nulls(spark):
    log = spark.createDataFrame([(i % 50, f"c{i % 50}") for i in range(500)], "city_id int, city_name string")
    held = spark.createDataFrame([(i, "x") for i in range(0, 50, 3)], "city_id int, city_name string")
    log.createOrReplaceTempView("l")
    held.createOrReplaceTempView("h")
    want = spark.sql("SELECT DISTINCT city_id, city_name FROM l WHERE city_id NOT IN (SELECT city_id FROM h)")
    assert rows(new_dim_rows(log, held, "city_id", ["city_name"])) == rows(want)


def test_dim_customer_takes_highest_city(spark):
    log = spark.createDataFrame(
        [(1, "A", "B", 3), (1, "A", "B", 9), (1, "A", "C", 4)],
        "customer_id bigint, first_name string, last_name string, city_id int",
    )
    held = spark.createDataFrame([], "customer_id bigint")
    assert rows(retail.dim_customer(log, held)) == [(1, "A", "B", 9), (1, "A", "C", 4)]


def sales_log(spark, days):
    return spark.createDataFrame(
        [(d, 1, "c", 7, "f", "l", 2, "i", 1, M("5.00")) for d in days], schemas.USER_ORDER_LOG
    )


def test_fact_day_backfill_and_missing_calendar_day(spark):
    log = sales_log(spark, [T(2024, 1, 1, 23), T(2024, 1, 2), T(2024, 1, 3, 4)])
    calendar = spark.createDataFrame([(20240101, D(2024, 1, 1)), (20240102, D(2024, 1, 2))], "date_id int, date_actual date")
    assert rows(retail.fact_sales_daily(log, calendar, D(2024, 1, 1)), "date_id") == [(20240101,)]
    full = retail.fact_sales(log, calendar, D(2024, 1, 1), D(2024, 1, 3))
    assert rows(full, "date_id") == [(None,), (20240101,), (20240102,)]


def test_retention_buckets(spark):
    def sale(day, customer, amount):
        return (day, 1, customer, 1, 1, None if amount is None else M(amount))

    fact = spark.createDataFrame(
        [
            sale(20240103, 1, "10.00"),  # one sale: new
            sale(20240103, 2, "10.00"), sale(20240104, 2, "5.50"),  # returning
            sale(20240103, 3, "8.00"), sale(20240104, 3, "-8.00"),  # new and refunded
            sale(20240103, 4, None), sale(20240103, 5, "0.00"),  # no amount, zero: shipped
            sale(20240104, 6, "-0.50"),
        ],
        schemas.SALES_FACT,
    )
    got = rows(
        retail.customer_retention_weekly(fact), "period_id", "new_customers_count",
        "returning_customers_count", "refunded_customer_count", "new_customers_revenue",
        "returning_customers_revenue", "customers_refunded",
    )
    # The refunds of -8.50 are rounded half away from zero.
    assert got == [(20241, 4, 1, 2, M("18.00"), M("15.50"), -9)]
    groups = spark.createDataFrame([(1, "g")], "item_id bigint, item_group string")
    assert rows(retail.retention_by_item(fact, groups), "item_group", "new_customers_count") == [("g", 4)]


# --- data quality -------------------------------------------------------------


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "b")], "id int, s string")
    assert rows(quality.duplicate_counts(df)) == [(4, 3, 1)]
    assert rows(quality.null_counts(df)) == [("id", 1), ("s", 1)]
    assert rows(quality.pk_violations(df, ["id"])) == [(1, 2)]
    parent = spark.createDataFrame([(1,), (1,)], "key int")
    assert rows(quality.orphans(df, parent, "id", "key")) == [(2, None)]
    assert rows(quality.rule_violations(df, {"small": F.col("id") < 2})) == [("small", 1)]
    assert rows(quality.row_count(df)) == [(4,)]
    assert rows(quality.duplicate_counts(df.limit(0))) == [(0, 0, 0)]
