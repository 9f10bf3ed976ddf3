"""Cleaning rules of the sales feed. Files differ by generation, so columns are optional."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.constants import LANDING_EXTRAS, REFUNDED, SHIPPED


def drop_extras(df: DataFrame) -> DataFrame:
    """Drop bookkeeping columns some file generations carry."""
    return df.drop(*LANDING_EXTRAS)


def one_per_id(df: DataFrame, key: str = "id") -> DataFrame:
    """One row per id: the smallest over all columns, so reruns agree.

    The minimum is combined before the shuffle. Rows without an id are kept.
    """
    others = [c for c in df.columns if c != key]
    kept = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*others)).alias("_row"))
        .select(key, "_row.*")
        .select(*df.columns)
    )
    return kept.unionByName(df.filter(F.col(key).isNull()))


def signed_amount(df: DataFrame, amount: str = "payment_amount") -> DataFrame:
    """Turn the amounts of refunded rows negative and drop the status.

    A missing status, as value or as a whole column, means shipped.
    """
    if "status" not in df.columns:
        return df
    status = F.coalesce(F.col("status"), F.lit(SHIPPED))
    value = F.when(status == REFUNDED, -F.col(amount)).otherwise(F.col(amount))
    return df.withColumn(amount, value).drop("status")


def clean_log(df: DataFrame, amount: str = "payment_amount", dedupe: bool = False) -> DataFrame:
    """A landing frame made ready for staging.

    Repeated ids stay unless ``dedupe`` is set.
    """
    if dedupe and "id" in df.columns:
        df = one_per_id(df)
    return signed_amount(drop_extras(df), amount)
