"""What the physical plans must and must not contain."""

import re

import pytest

from tidemart import registry

ROOT = "/root/testdata/sf0.001"
LARGE = [
    "running_views", "second_last_month", "cohort_retention", "cohort_posts_by_month",
    "active_new_users", "avg_daily_posts", "rfm_segments", "orders_current_status",
    "shipping_info", "shipping_status", "shipping_datamart", "dim_customer", "fact_sales_daily",
    "customer_retention_weekly", "retention_by_item", "dq_pk_violations", "dq_orphans",
]


@pytest.fixture(scope="module")
def plans(spark):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    found: dict[str, str] = {}

    def plan(name: str) -> str:
        if name not in found:
            df = registry.registered()[name](spark, ROOT)
            found[name] = df._jdf.queryExecution().explainString(mode)
        return found[name]

    return plan


@pytest.mark.parametrize("name", LARGE)
def test_no_single_task_cross_join_or_python(plans, name):
    plan = plans(name)
    for bad in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas"):
        assert bad not in plan
    assert "SinglePartition" not in plan


@pytest.mark.parametrize(
    "name, filters, columns",
    [
        ("monthly_views_total", ["GreaterThanOrEqual(o_orderdate", "LessThan(o_orderdate"], "o_totalprice,o_orderdate"),
        ("orders_since", ["GreaterThanOrEqual(o_orderdate"], "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate"),
        ("avg_daily_posts", ["GreaterThanOrEqual(ts", "LessThan(ts"], "ts,user_id"),
        ("fact_sales_daily", ["GreaterThanOrEqual(o_orderdate", "LessThan(o_orderdate"], "o_orderkey,o_custkey,o_orderdate"),
        ("user_activity", ["EqualTo(o_custkey,14)"], "o_custkey,o_totalprice,o_orderdate"),
    ],
)
def test_filters_and_columns_reach_the_scan(plans, name, filters, columns):
    plan = plans(name)
    for pushed in filters:
        assert re.search(r"PushedFilters: \[.*" + re.escape(pushed), plan)
    read = [re.sub(r":[^,>]+(?=,|>)", "", s) for s in re.findall(r"ReadSchema: struct<(.*?)>\n", plan)]
    names = {tuple(sorted(c.split(":")[0] for c in s.split(","))) for s in read}
    assert tuple(sorted(columns.split(","))) in names


def test_latest_status_is_combined_before_the_shuffle(plans):
    assert plans("orders_current_status").count("partial_max") >= 1


def test_segments_are_scored_without_shuffle(plans):
    # The scores compare each row of the written measures with a few literals.
    assert "Exchange" not in plans("rfm_segments")
