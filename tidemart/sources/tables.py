"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemart.schemas import conform
from tidemart.sources import versions


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of a data folder; Spark prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` under a name for SQL readers; it is evaluated per read."""
    df.createOrReplaceTempView(name)
    return df


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that may not have been loaded yet."""
    return versions.read_table(spark, path, schema)


def save_mart(df: DataFrame, path: str, schema: StructType) -> None:
    """Rebuild a mart table in full, in its declared schema; the old one stays readable until then."""
    versions.replace_all(conform(df, schema), path)


def append_rows(df: DataFrame, path: str, schema: StructType) -> None:
    """Insert rows into a table. Only for rows known to be new, such as ``new_dim_rows``."""
    versions.append(conform(df, schema), path)
