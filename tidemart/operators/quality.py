"""Data-quality checks, each a single pass, one combined aggregate, or marks first and rows where they repeat."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.operators.skew import fits_broadcast
from tidemart.session import write_shared


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def duplicate_counts(df: DataFrame) -> DataFrame:
    """Total rows, distinct rows and the difference.

    Rows are counted by a 64-bit mark first, so marks are shuffled instead of rows. Equal rows
    have equal marks: a mark seen once is one distinct row. Rows of the marks seen several times are
    compared as a whole, so marks of different rows may meet without harm. A list of repeated
    marks too long to broadcast means that many rows are to be compared anyway; then all are.
    """
    mark = F.xxhash64(*df.columns).alias("_mark")
    marks = df.groupBy(mark).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = write_shared(marks.filter("_rows > 1"), "repeated-marks")
    rows, n = df.agg(F.count(F.lit(1)).alias("total")), F.count(F.lit(1))
    if fits_broadcast(repeated):
        listed = F.broadcast(repeated.select("_mark"))
        compared = df.withColumn("_mark", mark).join(listed, "_mark", "left_semi").select(*df.columns)
        single = rows.select("total", F.col("total").alias("different")).unionByName(
            repeated.select(F.lit(0).alias("total"), (-F.col("_rows")).alias("different"))
        )
    else:
        compared, single = df, rows.withColumn("different", F.lit(0))
    counted = compared.distinct().agg(n.alias("different")).withColumn("total", F.lit(0))
    total, different = F.sum("total"), F.sum("different")
    return single.unionByName(counted).agg(
        total.alias("total_rows"), different.alias("distinct_rows"), (total - different).alias("duplicate_rows")
    )


def _stack(counts: Mapping[str, Column], df: DataFrame, name: str, value: str) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(n).alias(name), F.col(f"_{i}").alias(value)) for i, n in enumerate(counts)]
    )
    totals = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts.values())])
    return totals.select(F.inline(pairs))


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column."""
    counts = {c: F.count(F.when(F.col(c).isNull(), 1)) for c in df.columns}
    return _stack(counts, df, "column_name", "null_count")


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    held = parent.select(F.col(parent_key).alias(key)).distinct()
    return child.filter(F.col(key).isNotNull()).join(held, key, "left_anti").select(*child.columns)


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule. As with a CHECK constraint, NULL passes."""
    counts = {name: F.count(F.when(~rule, 1)) for name, rule in rules.items()}
    return _stack(counts, df, "rule", "violations")


def segment_balance(df: DataFrame, scores: Sequence[str]) -> DataFrame:
    """Size of every score value, and whether the sizes of a score differ by at most one."""
    pairs = F.array(
        *[F.struct(F.lit(s).alias("score"), F.col(s).cast("int").alias("value")) for s in scores]
    )
    sizes = df.select(F.inline(pairs)).groupBy("score", "value").agg(F.count("*").alias("users"))
    w = Window.partitionBy("score")
    spread = F.max("users").over(w) - F.min("users").over(w)
    return sizes.withColumn("balanced", spread <= 1)
