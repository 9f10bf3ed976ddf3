"""The marts' source tables, derived from the available commerce tables.

Each adapter is a plain projection or join; the marts take the resulting frames
and never look behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart import constants as C
from tidemart.functions.temporal import date_key
from tidemart.schemas import (
    CUSTOMER_RESEARCH,
    ORDERS,
    POSTS,
    SALES_FACT,
    SHIPPING_LOG,
    USER_ACTIVITY_LOG,
    USERS,
    conform,
)
from tidemart.sources.tables import table


def _lookup(code: Column, values: dict) -> Column:
    """A code's value from a short fixed mapping."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*pairs)[code]


# --- user activity ------------------------------------------------------------


def posts_from_orders(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("creation_date"),
        F.col("o_totalprice").alias("views_count"),
        F.col("o_orderstatus").alias("post_type_id"),
    )
    return conform(orders, POSTS)


def posts_from_events(spark: SparkSession, root: str) -> DataFrame:
    events = table(spark, root, "events").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.col("ts").alias("creation_date"),
        F.col("value").alias("views_count"),
        F.col("event_type").alias("post_type_id"),
    )
    return conform(events, POSTS)


def post_types(spark: SparkSession) -> DataFrame:
    return spark.sql(
        f"SELECT * FROM VALUES ('F', '{C.ANSWER}'), ('O', '{C.QUESTION}'), ('P', 'Other') "
        "AS t(id, type)"
    )


# Event types as action ids.
ACTIONS = {"view": 1, "click": 2, "signup": 3, "purchase": 4, "error": 5}


def event_types(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"('{name}', '{name}')" for name in ACTIONS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(id, type)")


def users(spark: SparkSession, root: str) -> DataFrame:
    """Customers who ordered; sign-up is the first order, the (shared) display name the nation."""
    signups = (
        table(spark, root, "orders")
        .groupBy(F.col("o_custkey").alias("id"))
        .agg(F.min("o_orderdate").alias("creation_date"))
    )
    customers = table(spark, root, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, root, "nation").select(
        "n_nationkey", F.col("n_name").alias("display_name")
    )
    return conform(signups.join(customers, "id").join(nations, "n_nationkey"), USERS)


# --- food orders --------------------------------------------------------------

# Order status letters as status ids.
STATUS_IDS = {"O": 1, "P": 2, "F": C.CLOSED_STATUS_ID}


def order_statuses(spark: SparkSession) -> DataFrame:
    return spark.sql(
        f"SELECT * FROM VALUES (1, 'Open'), (2, 'Processing'), "
        f"({C.CLOSED_STATUS_ID}, '{C.CLOSED}') AS t(id, key)"
    )


def customers_as_users(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "customer").select(F.col("c_custkey").alias("id"))


def orders(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_totalprice").alias("cost"),
        _lookup(F.col("o_orderstatus"), STATUS_IDS).alias("status"),
    )
    return conform(rows, ORDERS)


def order_status_log(spark: SparkSession, root: str) -> DataFrame:
    """Line shipments as status changes; ``LOG_ORDER`` is a total order within an order."""
    return table(spark, root, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        _lookup(F.col("l_linestatus"), STATUS_IDS).alias("status_id"),
        F.col("l_shipdate").alias("dttm"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )


LOG_ORDER = ("dttm", "l_linenumber", "l_partkey", "l_suppkey", "status_id")


# --- deliveries ---------------------------------------------------------------

# Transfer description by the digit of the order priority.
TRANSFERS = {"1": "1p:car", "2": "1p:train", "3": "1p:ship", "4": "3p:airplane", "5": "3p:multiple"}


def shipping_log(spark: SparkSession, root: str) -> DataFrame:
    """Up to four state changes per order, exploded from one scan of the orders.

    1 booked, 2 in transition an hour later, 3 received unless the order is still
    processing, 4 returned for part of the finished orders.
    """
    key, status, placed = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate")
    vendor = F.col("o_custkey") % 25
    digit = F.substring("o_orderpriority", 1, 1)
    step = F.col("_step")
    states = {1: C.BOOKED, 2: "transition", 3: C.RECEIVED_STATES[0], 4: C.RETURNED}
    happened = (
        (step <= 2)
        | ((step == 3) & (status != "P"))
        | ((step == 4) & (status == "F") & (key % 13 == 0))
    )
    hours_after = (
        F.when(step == 1, 0)
        .when(step == 2, 1)
        .when(step == 3, key % 9 * 24 + 2 + key % 22)
        .otherwise(12 * 24)
    )
    customers = table(spark, root, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, root, "nation").select("n_nationkey", "n_name", "n_regionkey")
    orders = table(spark, root, "orders").join(customers, "o_custkey").join(nations, "n_nationkey")
    # What is constant per order is computed before the explode.
    per_order = orders.select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderdate",
        key.alias("shippingid"),
        vendor.alias("vendorid"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("payment_amount"),
        (placed + F.make_dt_interval(days=F.lit(7))).alias("shipping_plan_datetime"),
        _lookup(digit, TRANSFERS).alias("shipping_transfer_description"),
        ((digit.cast("int") * 10 + 15 + key % 3).cast("decimal(14,3)") / 1000)
        .cast("decimal(14,3)")
        .alias("shipping_transfer_rate"),
        F.col("n_name").alias("shipping_country"),
        ((F.col("n_regionkey") + 1).cast("decimal(14,3)") / 100)
        .cast("decimal(14,3)")
        .alias("shipping_country_base_rate"),
        F.concat_ws(
            ":",
            vendor.cast("string"),
            F.concat(F.lit("vsp-"), vendor.cast("string")),
            F.concat(F.lit("0.0"), (vendor % 9).cast("string")),
            F.concat(F.lit("0.02"), (vendor % 5).cast("string")),
        ).alias("vendor_agreement_description"),
    )
    log = (
        per_order.withColumn("_step", F.explode(F.array(*[F.lit(n) for n in states])))
        .filter(happened)
        .withColumns(
            {
                "id": key * 10 + step,
                "state_datetime": placed + F.make_dt_interval(hours=hours_after.cast("int")),
                "status": F.when(step <= 2, C.IN_PROGRESS).otherwise(C.FINISHED),
                "state": _lookup(step, states),
            }
        )
    )
    return conform(log, SHIPPING_LOG)


# --- retail sales -------------------------------------------------------------


def sales_fact(spark: SparkSession, root: str) -> DataFrame:
    """Lines with their order's day, customer and city; returned lines count negative."""
    amount = F.col("l_extendedprice").cast("decimal(14,2)")
    rows = _order_lines(spark, root).select(
        date_key(F.col("o_orderdate")).alias("date_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("c_nationkey").alias("city_id"),
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") == "R", -amount).otherwise(amount).alias("payment_amount"),
    )
    return conform(rows, SALES_FACT)


def item_groups(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("item_group")
    )


def _order_lines(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, root, "customer").select("c_custkey", "c_name", "c_nationkey")
    lines = table(spark, root, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return lines.join(orders.join(customers, F.col("o_custkey") == F.col("c_custkey")), "o_orderkey")


def order_log(spark: SparkSession, root: str) -> DataFrame:
    """Sales lines as the operational system exports them, before cleaning.

    ``id`` is the line's key (repeated where the source repeats it); ``status``
    is NULL for part of the rows.
    """
    nations = table(spark, root, "nation").select("n_nationkey", "n_name")
    parts = table(spark, root, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    flag = F.col("l_returnflag")
    name = F.split("c_name", "#")
    rows = (
        _order_lines(spark, root)
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(parts, "l_partkey")
    )
    return rows.select(
        (F.col("o_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("o_orderdate").alias("date_time"),
        F.col("c_nationkey").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("o_custkey").alias("customer_id"),
        F.get(name, F.lit(0)).alias("first_name"),
        F.get(name, F.lit(1)).alias("last_name"),
        F.col("l_partkey").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("payment_amount"),
        F.when(flag == "R", C.REFUNDED).when(flag == "N", None).otherwise(C.SHIPPED).alias("status"),
    )


def calendar(spark: SparkSession, root: str) -> DataFrame:
    """One row per day between the first and last order."""
    span = table(spark, root, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    days = span.select(F.explode(F.sequence("first", "last")).alias("date_actual"))
    return days.select(date_key(F.col("date_actual")).alias("date_id"), "date_actual")


def customer_research(spark: SparkSession, root: str) -> DataFrame:
    """Orders per day, priority and nation."""
    customers = table(spark, root, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("geo_id")
    )
    rows = (
        table(spark, root, "orders")
        .join(customers, "o_custkey")
        .groupBy(
            F.col("o_orderdate").alias("date_id"),
            F.substring("o_orderpriority", 1, 1).alias("category_id"),
            "geo_id",
        )
        .agg(
            F.count(F.lit(1)).alias("sales_qty"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("sales_amt"),
        )
    )
    return conform(rows, CUSTOMER_RESEARCH)


def user_activity_log(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "events").select(
        F.col("ts").alias("date_time"),
        _lookup(F.col("event_type"), ACTIONS).alias("action_id"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").alias("quantity"),
    )
    return conform(rows, USER_ACTIVITY_LOG)
