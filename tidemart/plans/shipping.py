"""A delivery log broken into dimensions, facts and a tariff and lateness mart.

Build order: the three dimensions, then ``shipping_info`` and
``shipping_status``, then ``shipping_datamart`` on top. Pass the dimensions on as
loaded tables (``shipping_dims`` does): Spark then knows their size and
broadcasts them if they are small, and joins by shuffle if not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart import constants as C
from tidemart.functions.numeric import percent
from tidemart.functions.temporal import full_days
from tidemart.functions.text import split_fields
from tidemart.operators.keys import surrogate_key
from tidemart.operators.skew import HOT_ROWS, join_back
from tidemart.schemas import (
    SHIPPING_AGREEMENT,
    SHIPPING_COUNTRY_RATES,
    SHIPPING_INFO,
    SHIPPING_TRANSFER,
    conform,
)
from tidemart.session import in_parallel, write_shared


# The columns dimensions are made of.
DESCRIPTIONS = (
    "shipping_country",
    "shipping_country_base_rate",
    "shipping_transfer_description",
    "shipping_transfer_rate",
    "vendor_agreement_description",
)
LOG_ROWS = "log_rows"


def description_counts(log: DataFrame) -> DataFrame:
    """The distinct descriptions of the log with their row counts.

    Any dimension can be made from this frame instead of the log.
    """
    return log.groupBy(*DESCRIPTIONS).agg(F.count(F.lit(1)).alias(LOG_ROWS))


def shipping_dims(log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Countries, agreements and transfers as written tables, from one pass over the log."""
    texts = write_shared(description_counts(log), "descriptions")
    return tuple(
        in_parallel(
            lambda: write_shared(dim_country_rates(texts), "countries"),
            lambda: write_shared(dim_agreement(texts), "agreements"),
            lambda: write_shared(dim_transfer(texts), "transfers"),
        )
    )


def dim_country_rates(log: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct (country, base rate) pairs with an id."""
    natural = ["shipping_country", "shipping_country_base_rate"]
    pairs = log.select(*natural).distinct()
    numbered = surrogate_key(pairs, natural, "shipping_country_id", existing)
    return conform(numbered, SHIPPING_COUNTRY_RATES)


def dim_agreement(log: DataFrame, rate_scale: int = 2) -> DataFrame:
    """Agreements parsed from their description.

    The descriptions are made distinct as text first, so few are ever split.
    ``rate_scale`` is the number of decimals the rate keeps.
    """
    fields = {
        "agreementid": "bigint",
        "agreement_number": "string",
        "agreement_rate": f"decimal(14,{rate_scale})",
        "agreement_commission": "decimal(14,3)",
    }
    texts = log.select("vendor_agreement_description").distinct()
    parsed = texts.select(*split_fields(F.col("vendor_agreement_description"), fields)).distinct()
    return conform(parsed, SHIPPING_AGREEMENT) if rate_scale == 2 else parsed


TRANSFER_FIELDS = {"transfer_type": "string", "transfer_model": "string"}


def dim_transfer(log: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Transfer type and model parsed from their description, with the mean rate and an id.

    Sums and counts are taken per text before parsing; texts that split into the
    same fields are then added up.
    """
    rate = F.col("shipping_transfer_rate")
    weight = F.col(LOG_ROWS) if LOG_ROWS in log.columns else F.lit(1)
    per_text = log.groupBy("shipping_transfer_description").agg(
        F.sum(rate * weight).alias("_sum"), F.sum(F.when(rate.isNotNull(), weight)).alias("_count")
    )
    fields = split_fields(F.col("shipping_transfer_description"), TRANSFER_FIELDS)
    rates = (
        per_text.select(*fields, "_sum", "_count")
        .groupBy(*TRANSFER_FIELDS)
        .agg((F.sum("_sum") / F.sum("_count")).cast("decimal(14,3)").alias("shipping_transfer_rate"))
    )
    numbered = surrogate_key(
        rates, list(TRANSFER_FIELDS), "transfer_type_id", existing
    )
    return conform(numbered, SHIPPING_TRANSFER)


def shipping_info(log: DataFrame, countries: DataFrame, transfers: DataFrame) -> DataFrame:
    """The constant facts of each delivery with its dimension ids.

    The country is looked up by name alone: a country with two rates yields one
    row per rate (``pk_violations`` on the country name shows such cases).
    """
    constant = ["shippingid", "vendorid", "payment_amount", "shipping_plan_datetime", "shipping_country"]
    # One row per delivery is left when the texts are split; different texts may hold equal fields.
    texts = log.select(
        *constant, "vendor_agreement_description", "shipping_transfer_description"
    ).distinct()
    facts = texts.select(
        *constant,
        *split_fields(F.col("vendor_agreement_description"), {"agreementid": "bigint"}),
        *split_fields(F.col("shipping_transfer_description"), TRANSFER_FIELDS),
    ).distinct()
    transfer_ids = transfers.select("transfer_type_id", *TRANSFER_FIELDS)
    country_ids = countries.select("shipping_country_id", "shipping_country")
    linked = facts.join(transfer_ids, list(TRANSFER_FIELDS)).join(country_ids, "shipping_country")
    return conform(linked, SHIPPING_INFO)


def shipping_status(
    log: DataFrame,
    received_states: Sequence[str] = C.RECEIVED_STATES,
    keep_ties: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Last status and state of each delivery, with its booked and received times.

    One combined aggregation of the log. Of several rows at the last instant the
    highest log id counts; ``keep_ties`` returns them all, and then does not shuffle the rows
    of deliveries with more than ``hot_rows``.
    """
    at, state = F.col("state_datetime"), F.col("state")
    times = {
        "shipping_start_fact_datetime": F.max(F.when(state == C.BOOKED, at)),
        "shipping_end_fact_datetime": F.max(F.when(state.isin(list(received_states)), at)),
    }
    marks = [column.alias(name) for name, column in times.items()]
    if keep_ties:
        # A NULL time is the last one only where there is no other.
        last = log.groupBy("shippingid").agg(
            F.max("state_datetime").alias("_last"), *marks, F.count(F.lit(1)).alias("_rows")
        )
        rows = log.select("shippingid", "status", "state", "state_datetime")
        tied = join_back(rows, last, ["shippingid"], "_rows", hot_rows)
        return tied.filter(F.col("state_datetime").eqNullSafe(F.col("_last"))).select(
            "shippingid", "status", "state", *times
        )
    last = F.max(F.struct("state_datetime", "id", "status", "state")).alias("_last")
    return (
        log.groupBy("shippingid")
        .agg(last, *marks)
        .select("shippingid", "_last.status", "_last.state", *times)
    )


def shipping_datamart(
    info: DataFrame,
    status: DataFrame,
    countries: DataFrame,
    agreements: DataFrame,
    transfers: DataFrame,
) -> DataFrame:
    """Delivery days, lateness, tax and profit of each delivery."""
    rates = transfers.select("transfer_type_id", "transfer_type", "shipping_transfer_rate")
    tariffs = (
        info.join(status, "shippingid")
        .join(rates, "transfer_type_id")
        .join(countries.drop("shipping_country"), "shipping_country_id")
        .join(agreements.drop("agreement_number"), "agreementid")
    )
    start, end = F.col("shipping_start_fact_datetime"), F.col("shipping_end_fact_datetime")
    plan, paid = F.col("shipping_plan_datetime"), F.col("payment_amount")
    late = end > plan
    rate = (
        F.col("shipping_country_base_rate")
        + F.col("agreement_rate")
        + F.col("shipping_transfer_rate")
    )
    return tariffs.select(
        "shippingid",
        "vendorid",
        "transfer_type",
        full_days(end, start).alias("full_day_at_shipping"),
        F.when(late, 1).otherwise(0).alias("is_delay"),
        F.when(F.col("status") == C.FINISHED, 1).otherwise(0).alias("is_shipping_finish"),
        F.when(late, full_days(end, plan)).otherwise(0).alias("delay_day_at_shipping"),
        "payment_amount",
        (paid * rate).cast("decimal(18,5)").alias("vat"),
        (paid * F.col("agreement_commission")).cast("decimal(18,5)").alias("profit"),
    )


def vendor_quality(info: DataFrame, status: DataFrame) -> DataFrame:
    """Per vendor the share of late, undelivered and returned deliveries in percent."""
    end = F.col("shipping_end_fact_datetime")
    flags = {
        "late": end > F.col("shipping_plan_datetime"),
        "undelivered": end.isNull(),
        "returned": F.col("state") == C.RETURNED,
    }
    counts = (
        info.select("shippingid", "vendorid", "shipping_plan_datetime")
        .join(status, "shippingid")
        .groupBy("vendorid")
        .agg(
            F.count(F.lit(1)).alias("deliveries"),
            *[F.count(F.when(flag, 1)).alias(name) for name, flag in flags.items()],
        )
    )
    return counts.select(
        "vendorid",
        "deliveries",
        *[percent(F.col(n), F.col("deliveries")).alias(f"{n}_pct") for n in flags],
    )
