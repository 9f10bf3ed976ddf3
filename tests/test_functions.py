"""Expressions on hand-written edge rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.functions import temporal as t
from tidemart.functions.numeric import percent, percent_change
from tidemart.functions.text import split_fields

D, T = dt.date, dt.datetime


def value(spark, column, **inputs):
    """Evaluate one expression over one row."""
    kinds = {T: "timestamp_ntz", D: "date", int: "int", str: "string", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in inputs.items()) or "x int"
    row = tuple(inputs.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "day, coded, iso",
    [
        (D(2021, 1, 1), 202153, 202053),
        (D(2024, 12, 30), 20241, 202501),
        (D(2024, 1, 3), 20241, 202401),
        (D(2023, 6, 15), 202324, 202324),
    ],
)
def test_period_key(spark, day, coded, iso):
    assert value(spark, t.period_key(F.col("d")), d=day) == coded
    assert value(spark, t.period_key(F.col("d"), iso=True), d=day) == iso


def test_full_days_round_toward_zero(spark):
    days = t.full_days(F.col("a"), F.col("b"))
    assert value(spark, days, a=T(2024, 1, 4, 23), b=T(2024, 1, 1, 1)) == 3
    assert value(spark, days, a=T(2024, 1, 1, 1), b=T(2024, 1, 4, 23)) == -3
    assert value(spark, days, a=T(2024, 1, 2, 0), b=T(2024, 1, 1, 23)) == 0


def test_month_end_clamps(spark):
    later = t.months_later(F.col("a"), 1)
    assert value(spark, later, a=T(2023, 1, 31, 10)) == D(2023, 2, 28)
    assert value(spark, later, a=T(2024, 1, 31, 10)) == D(2024, 2, 29)


def test_range_ends(spark):
    late = T(2008, 12, 31, 5)
    first, last = D(2008, 12, 1), D(2008, 12, 31)
    assert value(spark, t.in_days(F.col("a"), first, last), a=late) is True
    assert value(spark, t.between_instants(F.col("a"), first, last), a=late) is False
    assert value(spark, t.in_year(F.col("a"), 2008), a=late) is True
    assert value(spark, t.in_year(F.col("a"), 2008), a=T(2009, 1, 1)) is False


def test_buckets(spark):
    at = T(2024, 2, 29, 13, 5)
    want = {"day": D(2024, 2, 29), "week": D(2024, 2, 26), "month": D(2024, 2, 1), "year": D(2024, 1, 1)}
    for grain, day in want.items():
        assert value(spark, t.bucket(F.col("a"), grain), a=at) == day


def test_date_keys(spark):
    assert value(spark, t.date_key(F.col("d")), d=D(2021, 1, 5)) == 20210105
    assert value(spark, t.date_of_key(F.col("k")), k=20210105) == D(2021, 1, 5)


def test_month_starts():
    assert t.month_starts(D(2023, 11, 1), D(2024, 2, 1)) == [
        D(2023, 11, 1), D(2023, 12, 1), D(2024, 1, 1), D(2024, 2, 1),
    ]


def test_split_fields(spark):
    kinds = {"id": "bigint", "number": "string", "rate": "decimal(14,2)", "fee": "decimal(14,3)"}
    rows = [("12:vsp-34:0.02:0.023",), ("7::vsp-1:::0.025:0.5",), ("9:x",)]
    df = spark.createDataFrame(rows, "s string").select(*split_fields(F.col("s"), kinds))
    assert [tuple(r) for r in df.collect()] == [
        (12, "vsp-34", Decimal("0.02"), Decimal("0.023")),
        (7, "vsp-1", Decimal("0.03"), Decimal("0.500")),
        (9, "x", None, None),
    ]


def test_percentages(spark):
    one = F.lit(1)
    assert [
        spark.range(1).select(percent(F.lit(n), F.lit(3))).first()[0] for n in (3, 2, 1)
    ] == [100.0, 66.67, 33.33]
    assert spark.range(1).select(percent(one, F.lit(32))).first()[0] == 3.13
    assert spark.range(1).select(percent_change(F.lit(63102), F.lit(70731))).first()[0] == -10.79
    assert spark.range(1).select(percent_change(one, F.lit(None).cast("int"))).first()[0] is None
