import pytest

from basketry.operators import customers, revenue
from basketry.operators import sessions as funnels
from basketry.plans.sqlapi import FUNCTIONS, register_functions
from tests.build import sessions, transactions, txn


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def tables(spark):
    orders = [
        txn(i, timestamp=f"2024-0{1 + i % 3}-{1 + i % 17:02d}T10:00:00", user_id=f"u{i % 9}",
            total=[None, 0.005, 19.99, 700.0, 2500.5][i % 5], discount=0.25 * (i % 4),
            status="completed" if i % 7 else "shipped")
        for i in range(120)
    ] + [txn(900, timestamp=None), txn(901, user_id=None)]
    visits = [dict(referrer=r, conversion_status=s, duration_seconds=d)
              for r, s, d in (("a", "converted", 5), ("a", "browsed", None), ("b", "abandoned", 7), (None, None, 3))]
    found = {"transactions": transactions(spark, *orders), "sessions": sessions(spark, *visits)}
    assert register_functions(spark, found) == list(FUNCTIONS)
    return found


@pytest.mark.parametrize("days", [1, 2, 7, 500])
def test_daily_revenue_with_any_window(spark, tables, days):
    ours = spark.sql(f"SELECT * FROM daily_revenue({days})")
    assert rows(ours) == rows(revenue.daily_revenue(tables["transactions"], window_rows=days))
    assert days != 7 or rows(spark.sql("SELECT * FROM daily_revenue()")) == rows(ours)


@pytest.mark.parametrize("edges", [(500.0, 2000.0), (0.0, 100.0), (1e9, 2e9)])
def test_segments_with_any_edges(spark, tables, edges):
    ours = spark.sql(f"SELECT * FROM ltv_segments(high => {edges[1]}D, mid => {edges[0]}D)")
    theirs = customers.ltv_segments(tables["transactions"], *edges)
    assert ours.columns == theirs.columns and rows(ours) == rows(theirs)


def test_funnel_and_spend(spark, tables):
    theirs = funnels.funnel_by_referrer(tables["sessions"])
    ours = spark.sql("SELECT * FROM funnel_by_referrer()")
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours.select(theirs.columns)) == rows(theirs)
    assert [r["referrer"] for r in spark.sql("SELECT referrer FROM funnel_by_referrer(2)").collect()] == ["a"]
    spent = {}
    for r in customers.user_monthly_spend(tables["transactions"]).collect():
        if r["monthly_spend"] is not None and "2024-01" <= (r["txn_month"] or "") <= "2024-02":
            spent[r["user_id"]] = round(spent.get(r["user_id"], 0) + r["monthly_spend"], 2)
    found = spark.sql("SELECT * FROM user_spend('2024-01', '2024-02') WHERE spend IS NOT NULL")
    assert {r["user_id"]: r["spend"] for r in found.collect()} == spent


def test_functions_are_inlined_and_join_with_tables(spark, tables):
    tables["transactions"].createOrReplaceTempView("orders_here")
    joined = spark.sql(
        "SELECT d.date, count(*) AS n FROM daily_revenue(3) d JOIN orders_here o ON o.date = d.date "
        "WHERE d.daily_orders > 1 AND o.status = 'completed' GROUP BY d.date"
    )
    told = {r["date"]: r["daily_orders"] for r in spark.sql("SELECT * FROM daily_revenue(3)").collect()}
    assert {r["date"]: r["n"] for r in joined.collect()} == {d: n for d, n in told.items() if n > 1}
    plan = spark.sql("SELECT date FROM daily_revenue(3)")._jdf.queryExecution().optimizedPlan().toString()
    assert "discount_cents" not in plan  # columns that nobody asks for are not computed
