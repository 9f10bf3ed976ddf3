"""Recency / frequency / monetary-value segmentation of customers.

``rfm_segments`` takes any frame with the columns of ``schemas.ORDERS``; it does
not care whether the status is a column of the order table or was taken from a
status log by ``orders_current_status``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.constants import CLOSED
from tidemart.functions.temporal import since
from tidemart.operators.ordering import SortKey, ntiles
from tidemart.operators.windows import latest_per_key
from tidemart.schemas import RFM_SEGMENTS, conform
from tidemart.session import write_shared

SCORES = ("recency", "frequency", "monetary_value")


def orders_since(orders: DataFrame, start: dt.datetime) -> DataFrame:
    """Orders from ``start`` on, all columns."""
    return orders.filter(since(F.col("order_ts"), start))


def orders_current_status(
    orders: DataFrame, log: DataFrame, start: dt.datetime, log_order: Sequence[str] = ("dttm", "id")
) -> DataFrame:
    """Orders from ``start`` on with their latest status from the log, NULL if it has none."""
    latest = latest_per_key(
        log.select("order_id", "status_id", *[c for c in log_order if c != "status_id"]),
        ["order_id"],
        log_order,
    ).select("order_id", F.col("status_id").alias("status"))
    kept = orders_since(orders, start).select("user_id", "order_id", "order_ts", "cost")
    return kept.join(latest, "order_id", "left").select(
        "user_id", "order_id", "order_ts", "cost", "status"
    )


def rfm_segments(
    users: DataFrame,
    orders: DataFrame,
    statuses: DataFrame,
    closed: str = CLOSED,
    tiles: int = 5,
    newest_first: bool = True,
) -> DataFrame:
    """Three scores from 1 to ``tiles`` for every user, whether or not they ordered.

    With ``newest_first`` recency 1 is the newest order; otherwise (as the
    requirement words it) 1 is the oldest or none. Ties fall by user id.

    The measures are one row per user and written once, since each score reads
    them again.
    """
    closed_id = statuses.filter(F.col("key") == closed).select(F.col("id").alias("status"))
    spent = (
        orders.join(closed_id, "status", "left_semi")
        .groupBy("user_id")
        .agg(
            F.max("order_ts").alias("last_order"),
            F.count("order_id").alias("order_count"),
            F.sum("cost").cast("decimal(18,2)").alias("spent"),
        )
    )
    measures = (
        users.select(F.col("id").alias("user_id"))
        .join(spent, "user_id", "left")
        .withColumn("order_count", F.coalesce("order_count", F.lit(0)))
    )
    measures = write_shared(measures, "rfm-measures")
    keys = (
        SortKey("last_order", descending=newest_first),
        SortKey("order_count"),
        SortKey("spent"),
    )
    orders_by = {out: [key, SortKey("user_id")] for out, key in zip(SCORES, keys)}
    return conform(ntiles(measures, orders_by, tiles), RFM_SEGMENTS)
