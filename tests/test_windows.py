"""Per-key measures; the paths for hot keys must give what the plain window gives."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions.temporal import month_name
from tidemart.operators.skew import broadcast_if_small, hot_keys, skew_join, split_hot
from tidemart.operators.windows import lag_n, latest_per_key, running_total
from tidemart.plans import activity
from tidemart.sources import adapters

T = dt.datetime


@pytest.fixture(scope="module")
def posts(spark):
    """A third of the rows belongs to user 1, another lot has no user; many ties in time."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        user = 1 if i % 3 == 0 else None if i % 7 == 0 else rng.randint(2, 40)
        when = T(2024, 1, 1) + dt.timedelta(hours=rng.randint(0, 400))
        views = None if rng.random() < 0.1 else Decimal(rng.randint(0, 9999)) / 100
        rows.append((i, user, when, views))
    return spark.createDataFrame(
        rows, "id bigint, user_id bigint, ts timestamp_ntz, views decimal(14,2)"
    ).cache()


def _same(a, b):
    columns = sorted(a.columns)
    left, right = a.select(*columns), b.select(*columns)
    assert left.dtypes == right.dtypes
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_running_total_of_hot_keys(posts):
    w = Window.partitionBy("user_id").orderBy("ts")
    want = posts.withColumn("total", F.sum("views").over(w))
    _same(running_total(posts, ["user_id"], "ts", "views", "total"), want)
    _same(running_total(posts, ["user_id"], "ts", "views", "total", hot_rows=100), want)
    _same(running_total(posts, ["user_id"], "ts", "views", "total", hot_rows=0), want)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_lag_of_hot_keys(posts, n):
    w = Window.partitionBy("user_id").orderBy("ts", "id")
    want = posts.withColumn("before", F.lag("ts", n).over(w))
    for hot in (10_000, 100, 0):
        _same(lag_n(posts, ["user_id"], ["ts", "id"], "ts", n, "before", hot_rows=hot), want)


def test_lag_longer_than_a_chunk(spark):
    df = spark.createDataFrame([(1, i) for i in range(12)], "k int, id bigint")
    w = Window.partitionBy("k").orderBy("id")
    want = df.withColumn("b", F.lag("id", 5).over(w))
    _same(lag_n(df, ["k"], ["id"], "id", 5, "b", hot_rows=1), want)


def test_golden_running_total(spark):
    rows = [
        (1, T(2008, 7, 31, 23, 41), 480476),
        (1, T(2008, 7, 31, 23, 55, 38), 136033),
        (1, T(2008, 7, 31, 23, 56, 41), 0),
        (2, T(2008, 7, 31, 23, 56, 41), 79087),
        (2, T(2008, 8, 1, 5, 9, 56), 65443),
    ]
    df = spark.createDataFrame(rows, "u bigint, ts timestamp_ntz, v bigint")
    for hot in (100, 0):
        got = running_total(df, ["u"], "ts", "v", "c", hot).orderBy("u", "ts").collect()
        assert [r["c"] for r in got] == [480476, 616509, 616509, 79087, 144530]


def test_golden_second_last_month(spark):
    days = [T(2008, 7, 31, 23, m) for m in (41, 55, 56)] + [T(2008, 8, 4, h) for h in (2, 4, 8)]
    df = spark.createDataFrame([(1, d) for d in days], "u bigint, ts timestamp_ntz")
    lagged = lag_n(df, ["u"], ["ts"], "ts", 2, "b").orderBy("ts")
    names = [r[0] for r in lagged.select(month_name(F.col("b"))).collect()]
    assert names == [None, None, "July", "July", "July", "August"]
    padded = [r[0] for r in lagged.select(month_name(F.col("b"), 9)).collect()]
    assert padded[2] == "July     "


def test_latest_per_key_and_ties(spark):
    rows = [(1, T(2024, 1, 1), 1, "a"), (1, T(2024, 1, 2), 2, "b"), (1, T(2024, 1, 2), 3, "c")]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id int, state string")
    assert [r.state for r in latest_per_key(df, ["k"], ["ts", "id"]).collect()] == ["c"]
    ties = latest_per_key(df, ["k"], ["ts"], keep_ties=True)
    assert sorted(r.state for r in ties.collect()) == ["b", "c"]


def test_null_key_counts_with_and_without_ties(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), (None, 2, 3), (4, 1, 4)], "k int, ts int, id int")
    assert {r.id for r in latest_per_key(df, ["k"], ["ts", "id"]).collect()} == {3, 4}
    assert {r.id for r in latest_per_key(df, ["k"], ["ts"], keep_ties=True).collect()} == {2, 3, 4}


def test_latest_per_key_equals_self_join(posts):
    last = latest_per_key(posts.filter("user_id is not null"), ["user_id"], ["ts", "id"])
    top = posts.groupBy("user_id").agg(F.max("ts").alias("ts"))
    ties = posts.join(top, ["user_id", "ts"])
    want = ties.groupBy("user_id").agg(F.max("id").alias("id"))
    _same(last.select("user_id", "id"), want)


def test_hot_keys_include_null(posts):
    keys, rows = hot_keys(posts, ["user_id"], 200)
    assert {r.user_id for r in keys.collect()} == {1, None}
    assert rows == posts.filter("user_id = 1 or user_id is null").count()
    assert hot_keys(posts, ["user_id"], 5000) == (None, 0)
    split = split_hot(posts, ["user_id"], 200)
    assert split.rest.count() + split.hot.count() == posts.count() and split.hot.count() == split.rows


def test_every_hot_key_is_split(spark):
    """No cap on how many keys may be hot."""
    df = spark.range(50_000).selectExpr("id % 25000 AS k", "id", "id AS v")
    assert hot_keys(df, ["k"], 1)[0].count() == 25_000
    got = running_total(df, ["k"], "id", "v", "t", hot_rows=1)
    assert got.filter("t != CASE WHEN id < 25000 THEN id ELSE 2 * id - 25000 END").count() == 0


def test_chunks_follow_the_hot_rows(spark):
    from tidemart.operators.windows import _chunks

    df = spark.range(20_000).selectExpr("1 AS k", "id")
    assert _chunks(split_hot(df, ["k"], 1000), 1000) == 20


def test_skew_join_rejects_what_it_cannot_do(spark):
    many = spark.createDataFrame([(1,)] * 5 + [(2,)], "k int")
    one = spark.createDataFrame([(1, "a"), (3, "b")], "k int, v string")
    for how in ("right", "full", "outer"):
        with pytest.raises(ValueError):
            skew_join(many, one, ["k"], how, 2)
    with pytest.raises(ValueError, match="unique"):
        skew_join(many, one.union(one), ["k"], "inner", 2)
    for how in ("left_semi", "left_anti"):
        _same(skew_join(many, one, ["k"], how, 2), many.join(one, ["k"], how))


def test_broadcast_is_bounded_in_bytes(spark):
    from tidemart.operators.skew import fits_broadcast

    wide = spark.range(10).selectExpr("repeat('x', 1000) AS t")
    assert fits_broadcast(wide, max_bytes=20_000) and not fits_broadcast(wide, max_bytes=5_000)


def test_reports_shuffle_the_log_once(spark, plan_of):
    posts = adapters.posts_from_orders(spark, "/root/testdata/sf0.001")
    for report in (activity.running_views, activity.second_last_month):
        plan = plan_of(report(posts))
        assert plan.split("== Initial Plan")[-1].count("Exchange\n") <= 2 and "hashpartitioning" not in plan


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_join(spark, posts, how):
    names = spark.createDataFrame([(i, f"n{i % 5}") for i in range(0, 30)], "user_id bigint, name string")
    want = posts.join(names, ["user_id"], how)
    for hot in (10_000, 100, 0):
        _same(skew_join(posts, names, ["user_id"], how, hot), want)


def test_broadcast_needs_a_small_side(spark, plan_of):
    big, small = spark.range(1000), spark.range(10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(big.join(broadcast_if_small(small, 10), "id"))
        assert "BroadcastHashJoin" not in plan_of(big.join(broadcast_if_small(small, 9), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reports_agree_when_every_user_is_hot(spark):
    posts = adapters.posts_from_orders(spark, "/root/testdata/sf0.001")
    for report in (activity.running_views, activity.second_last_month):
        _same(report(posts, hot_rows=5), report(posts))


def test_top_author_tie_goes_to_the_smallest_id(spark):
    posts = spark.createDataFrame(
        [(n, user, T(2024, 1, n), Decimal(1), "a") for n, user in enumerate([9, 4, 9, 4], 1)],
        schemas.POSTS,
    )
    weekly = activity.top_author_weekly(posts, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert [tuple(r) for r in weekly.collect()] == [(1, T(2024, 1, 4))]
