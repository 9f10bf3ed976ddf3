"""Active months of each user as bitmaps, kept as a table that increments are merged into.

A row holds a user, a word and its bits: a word is a span of five calendar years, its bit
12 y + m says whether the user was active in month m of the span's year y. Equal rows and
reruns change nothing, since bits are only ever OR-ed. The table is cut by word, so an increment
reads and replaces the words it falls into, not the users' whole past, and never the log.

Rows without a user or a time count nowhere. An increment can only add months. Where
rows of the log were taken away, pass all rows of the words concerned with
``replace=True``. One writer at a time: two that merge into the same word at once would
lose one of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.cohorts import with_rates
from tidemart.schemas import LONG, columns
from tidemart.session import write_shared
from tidemart.sources import versions

USER, WORD, BITS = "user_id", "word", "bits"
YEARS = 5
MONTHS = 12 * YEARS

_STATE = columns(user_id=LONG, bits=LONG)


def month_bits(df: DataFrame, user: str, ts: str) -> DataFrame:
    """user_id, word and bits of a log: one row per user and word, combined before the shuffle."""
    year = F.year(ts)
    bit = F.pmod(year, F.lit(YEARS)) * 12 + F.month(ts) - 1
    seen = df.filter(F.col(user).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(user).cast("long").alias(USER),
        F.floor(year / YEARS).cast("int").alias(WORD),
        F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias(BITS),
    )
    return merged(seen)


def merged(bits: DataFrame) -> DataFrame:
    """One row per user and word from any rows of bits."""
    return bits.groupBy(USER, WORD).agg(F.bit_or(BITS).alias(BITS))


def update(
    spark: SparkSession, path: str, log: DataFrame, user: str, ts: str, replace: bool = False
) -> list[int]:
    """Merge a log's months into the table at ``path``; returns the words written.

    With ``replace`` the log is taken to hold all rows of its words, which then start anew.
    """
    added = write_shared(month_bits(log, user, ts), "month-bits")
    # A row per five years.
    words = sorted(r[WORD] for r in added.select(WORD).distinct().collect())
    if not words:
        return []
    if not replace:
        added = merged(added.unionByName(read(spark, path, words)))
    versions.replace_parts(added.withColumn(WORD, F.col(WORD).cast("string")), path, WORD)
    return words


def read(spark: SparkSession, path: str, words: list[int] | None = None) -> DataFrame:
    """The table, or only some words of it."""
    parts = None if words is None else [str(w) for w in words]
    held = versions.read_table(spark, path, _STATE, WORD, parts)
    return held.withColumn(WORD, F.col(WORD).cast("int"))


def _month(word: Column, bit: Column) -> Column:
    month = word * MONTHS + bit
    return F.make_date(F.floor(month / 12).cast("int"), F.pmod(month, F.lit(12)) + 1, F.lit(1))


def retention(bits: DataFrame) -> DataFrame:
    """Monthly cohort retention from the bitmaps, as ``cohort_table`` gives it from the log.

    Users with the same first month and the same bits are counted together before any
    bit is looked at, so months are unfolded per pattern and not per user.
    """
    bits = bits.filter(F.col(BITS) != 0)
    # The number of zeros below the lowest bit that is set.
    lowest = F.bit_count(F.col(BITS).bitwiseAND(-F.col(BITS)) - 1)
    firsts = bits.groupBy(USER).agg(F.min(F.col(WORD) * MONTHS + lowest).alias("_first"))
    patterns = bits.join(firsts, USER).groupBy("_first", WORD, BITS).agg(F.count(F.lit(1)).alias("_users"))
    each = patterns.select(
        _month(F.lit(0), F.col("_first")).alias("cohort_dt"),
        WORD,
        BITS,
        "_users",
        F.explode(F.sequence(F.lit(0), F.lit(MONTHS - 1))).alias("_bit"),
    ).filter(F.call_function("shiftright", F.col(BITS), F.col("_bit")).bitwiseAND(F.lit(1)) == 1)
    cells = each.groupBy("cohort_dt", _month(F.col(WORD), F.col("_bit")).alias("session_date")).agg(
        F.sum("_users").alias("users_cnt")
    )
    return with_rates(cells)
