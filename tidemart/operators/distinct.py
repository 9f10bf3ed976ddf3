"""Distinct counts that add up: kept per day, merged over any range of days.

Counting distinct users of a week again for every day reads each row seven times. What is
kept per day and group here is merged instead, and a day written anew replaces only its own
rows. Two kinds of states:

* **Bitmaps**, exact, for whole-number ids that lie close together, such as surrogate keys.
  Ids are cut into buckets of 32,768 with 4 kB each, so a few ids far apart cost 4 kB each.
* **Sketches** (HyperLogLog), of 2^lg_k cells whatever the ids. An estimate's relative
  standard error is at most 1.04 / 2^(lg_k / 2): 0.8 % for 14, the default.

NULL ids are not counted; a group without any has no row. NULL groups and days are values of
their own in states, but a row without a day lies in no range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
BITMAP, BUCKET, SKETCH = "bitmap", "bucket", "sketch"


def error_bound(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error that a sketch's estimate keeps within so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def daily_bitmaps(df: DataFrame, day: Column, groups: Sequence[str], ids: str) -> DataFrame:
    """day, the groups, bucket and bitmap of the ids seen on each day."""
    # Ids are made distinct as numbers, which are combined as hash rows before the shuffle.
    once = df.filter(F.col(ids).isNotNull()).select(day.alias("day"), *groups, F.col(ids).alias("_id")).distinct()
    return once.groupBy("day", *groups, F.bitmap_bucket_number("_id").alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias(BITMAP)
    )


def daily_sketches(df: DataFrame, day: Column, groups: Sequence[str], ids: str, lg_k: int = LG_K) -> DataFrame:
    """day, the groups and a sketch of the ids seen on each day."""
    seen = df.filter(F.col(ids).isNotNull()).select(day.alias("day"), *groups, F.col(ids).alias("_id"))
    return seen.groupBy("day", *groups).agg(F.hll_sketch_agg("_id", lg_k).alias(SKETCH))


def in_range(states: DataFrame, first, last) -> DataFrame:
    """States of the days ``first`` to ``last``."""
    return states.filter(F.col("day").between(F.lit(first), F.lit(last)))


def distinct_of(states: DataFrame, groups: Sequence[str], out: str) -> DataFrame:
    """Distinct ids per group over all days of ``states``: exact from bitmaps, else estimated."""
    if BITMAP in states.columns:
        whole = states.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))
        return whole.groupBy(*groups).agg(F.sum(F.bitmap_count(BITMAP)).alias(out))
    return states.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias(out))


def trailing_distinct(states: DataFrame, groups: Sequence[str], days: int, out: str) -> DataFrame:
    """For each day with rows of a group, the distinct ids of the ``days`` days that end with it.

    Every state is dealt to the days it counts for, at most ``days`` of them; days on which
    the group has no rows are not reported.
    """
    ends = F.sequence(F.lit(0), F.lit(days - 1))
    dealt = states.withColumn("_ahead", F.explode(ends)).withColumn("day", F.date_add("day", F.col("_ahead")))
    # Each state is also its own day's, which tells the days that are reported.
    own = dealt.groupBy("day", *groups).agg(F.min("_ahead").alias("_ahead")).filter("_ahead = 0").drop("_ahead")
    counts = distinct_of(dealt.drop("_ahead"), ["day", *groups], out)
    keys = ["day", *groups]
    match = [F.col(f"c.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    return counts.alias("c").join(own.alias("o"), match, "left_semi").select(*keys, out)
