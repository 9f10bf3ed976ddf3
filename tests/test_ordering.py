"""Distributed order operators against the plain window functions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.operators import ordering
from tidemart.operators.keys import surrogate_key
from tidemart.operators.ordering import (
    SortKey,
    global_row_number,
    ntile,
    ntile_starts,
    ntiles,
    place_in_order,
)


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, 1, 1, 1, 1, 2, 3, rng.randint(0, 50)])) for i in range(1500)]
    return spark.createDataFrame(rows, "id bigint, value int").cache()


@pytest.mark.parametrize("tiles", [1, 5, 50])
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("nulls_first", [False, True])
def test_ntile_equals_window(scored, tiles, descending, nulls_first):
    key = SortKey("value", descending, nulls_first)
    w = Window.orderBy(key.column(), "id")
    want = scored.withColumn("want", F.ntile(tiles).over(w))
    got = ntile(want, [key, "id"], tiles, "got")
    assert got.filter("want <> got").count() == 0


@pytest.mark.parametrize("guess_rows", [1, 40])
@pytest.mark.parametrize("tiles", [2, 23])
def test_tiles_by_selection_equal_windows(scored, tiles, guess_rows):
    orders = {"up": [SortKey("value"), "id"], "down": [SortKey("value", True, False), SortKey("id", True)]}
    want = scored
    for out, keys in orders.items():
        w = Window.orderBy(*[k.column() for k in ordering.as_keys(keys)])
        want = want.withColumn(f"want_{out}", F.ntile(tiles).over(w))
    got = ntiles(want, orders, tiles, 10, guess_rows)
    assert got.filter("want_up <> up or want_down <> down").count() == 0 and got.count() == 1500


def test_only_ranges_around_the_tiles_are_sorted(spark, monkeypatch):
    df = spark.range(60_000).select(F.xxhash64("id").alias("value"), "id")
    sorted_rows = []

    def spy(rows, *args):
        placed = place_in_order(rows, *args)
        sorted_rows.append(placed.total)
        return placed

    monkeypatch.setattr(ordering, "place_in_order", spy)
    got = ntiles(df, {"tile": ["value", "id"]}, 5, direct_rows=1000)
    assert [r["count"] for r in got.groupBy("tile").count().collect()] == [12_000] * 5
    assert sum(sorted_rows) < 12_000


def test_a_frame_that_changes_between_reads_raises(spark, monkeypatch):
    df = spark.range(5000)
    smaller = place_in_order(spark.range(3), ["id"], "other")
    monkeypatch.setattr(ordering, "place_in_order", lambda *_: smaller)
    with pytest.raises(RuntimeError, match="other rows"):
        ntiles(df, {"t": ["id"]}, 5, 100, 50)


def test_ntile_with_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "id bigint")
    assert sorted(map(tuple, ntile(df, ["id"], 5, "t").collect())) == [(1, 1), (2, 2), (3, 3)]


def test_ntile_of_nothing(spark):
    assert ntile(spark.createDataFrame([], "id bigint"), ["id"], 5, "t").count() == 0


@pytest.mark.parametrize("total", range(0, 24))
@pytest.mark.parametrize("tiles", [1, 2, 5, 7])
def test_tile_starts(total, tiles):
    sizes = [total // tiles + (1 if i < total % tiles else 0) for i in range(tiles)]
    starts = [sum(sizes[:i]) for i in range(1, tiles)]
    assert ntile_starts(total, tiles) == [s for s in starts if s < total]


def test_row_number_equals_window(scored):
    w = Window.orderBy(F.col("value").asc_nulls_first(), "id")
    want = scored.withColumn("want", F.row_number().over(w))
    got = global_row_number(want, ["value", "id"], "got")
    assert got.filter("want <> got").count() == 0 and got.count() == 1500


def test_row_number_is_that_of_one_window(scored):
    w = Window.orderBy(F.col("value").asc_nulls_first(), "id")
    by_window = scored.withColumn("n", F.row_number().over(w).cast("bigint") + 6)
    placed = global_row_number(scored, ["value", "id"], "n", 7)
    assert by_window.dtypes == placed.dtypes
    assert by_window.exceptAll(placed).count() == 0


def test_row_number_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint")
    assert global_row_number(df, ["id"], "n").columns == ["id", "n"]


def test_heavy_key_is_spread_over_chunks(spark):
    df = spark.range(9000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("k"), "id")
    placed = place_in_order(df, ["k", "id"], "spread")
    assert placed.total == 9000
    assert max(n for _, n in placed.counts) < 3000


def test_surrogate_key_keeps_given_ids(spark):
    first = surrogate_key(spark.createDataFrame([("b",), ("a",)], "name string"), ["name"], "key")
    assert sorted(map(tuple, first.collect())) == [("a", 1), ("b", 2)]
    later = spark.createDataFrame([("a",), ("0",), ("b",), (None,)], "name string")
    added = surrogate_key(later, ["name"], "key", existing=first)
    assert sorted(map(tuple, added.collect()), key=repr) == [("0", 4), (None, 3)]
    again = surrogate_key(later, ["name"], "key", existing=first.unionByName(added))
    assert again.count() == 0
