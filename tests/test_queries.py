"""Every registered query against its SQL, and the shape of its plan."""

import re

import pytest

import __spark_entry__ as entry_point
from checks import registry
from checks.compare import difference, duckdb_tables

TABLES = "/root/testdata/sf0.001"
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def connection():
    return duckdb_tables(TABLES)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_point.queries()) & set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert difference(spark, connection, name, TABLES) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, TABLES))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan


def test_unused_discount_costs_no_line_items(spark):
    plan = plan_of(QUERIES["ltv_segments"](spark, TABLES))
    assert "lineitem.parquet" not in plan and "orders.parquet" in plan


def test_scans_read_only_the_columns_they_need(spark):
    plan = plan_of(QUERIES["user_monthly_spend"](spark, TABLES))
    (columns,) = set(re.findall(r"FileScan parquet \[([^\]]*)\]", plan))
    assert re.sub(r"#\d+L?", "", columns).split(",") == [
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
    ]


def test_newest_per_user_are_cut_before_the_shuffle(spark):
    plan = plan_of(QUERIES["recent_sessions"](spark, TABLES))
    assert "WindowGroupLimit" in plan


def test_events_are_grouped_before_they_are_ordered_by_user(spark):
    """The sessions' window sees a row per user and time slice, not the events."""
    plan = plan_of(QUERIES["engagement_features"](spark, TABLES))
    window, below = plan.split("Window [", 1)
    assert "HashAggregate(keys=[user_id" in below


def test_totals_agree_across_reports(spark):
    """The same completed revenue and the same buyers, whichever way they are summed."""

    def total(name, column):
        return QUERIES[name](spark, TABLES).selectExpr(f"round(sum({column}), 2)").first()[0]

    revenue = total("daily_revenue", "daily_revenue")
    for name, column in [
        ("cohort_revenue", "cohort_revenue"),
        ("referrer_revenue", "total_rev"),
        ("user_monthly_spend", "monthly_spend"),
        ("kpi_summary", "total_revenue"),
    ]:
        assert total(name, column) == revenue
    buyers = total("ltv_segments", "user_count")
    for name in ("clv_segment_summary", "referrer_revenue"):
        assert total(name, "user_count") == buyers
    per_line = total("revenue_by_category", "total_discount")
    assert per_line > total("daily_revenue", "daily_discount")
    funnel = QUERIES["funnel_by_referrer"](spark, TABLES)
    assert funnel.filter("converted + abandoned + browsed != total_sessions").count() == 0


def scans(plan: str, table: str) -> int:
    return sum(
        "FileScan parquet" in line and f"{table}.parquet" in line for line in plan.splitlines()
    )


@pytest.mark.parametrize(
    ("name", "most"),
    [("user_session_rows", 1), ("cart_adds_daily", 1), ("recent_sessions", 1),
     ("product_performance_table", 2)],
)
def test_events_are_scanned_once_for_sessions_and_carts(spark, name, most):
    assert scans(plan_of(QUERIES[name](spark, TABLES)), "events") == most


def test_status_and_event_filters_reach_the_scan(spark):
    assert "EqualNullSafe(o_orderstatus,F)" in plan_of(QUERIES["daily_revenue"](spark, TABLES))
    assert "EqualNullSafe(event_type,view)" in plan_of(QUERIES["product_performance_daily"](spark, TABLES))
