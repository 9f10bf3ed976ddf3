"""Column expressions and small joins shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of characters other than space, tab, line feed, vertical tab,
# form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

# Rows a broadcast side may have. The sides broadcast behind this check have a few
# fixed-width columns, so the bound is a bound of bytes too (under 64 MB).
BROADCAST_ROWS = 1_000_000


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written in decimal, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether a row is kept out of training; a row without id is, too."""
    return F.coalesce(id_remainder(doc_id, modulus) == remainder, F.lit(True))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a narrow, written side after counting it; a larger one is joined by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def read(spark, root: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}.parquet").select(*columns)
