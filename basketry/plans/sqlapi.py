"""The reports as SQL table functions with parameters.

    register_functions(spark, tables)
    spark.sql("SELECT * FROM daily_revenue(window_rows => 30) WHERE daily_orders > 10")

What does not depend on a parameter, the sums of money per day, user or product, is a view made by the
operators; a function's body is SQL over that view, which Spark inlines into the query that
calls it, so filters and columns are pushed through it as through any view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.operators import customers, revenue
from basketry.operators import sessions as funnels

PREFIX = "basketry_"


def _dollars(cents: str) -> str:
    return f"CAST(round({cents}, 0) AS DOUBLE) / 100"


def _ratio(numerator: str, denominator: str, digits: int) -> str:
    """As `functions.numeric.ratio`: exact decimals, rounded half up, null for 0."""
    exact = f"try_divide(CAST({numerator} AS DECIMAL(28,4)), CAST({denominator} AS DECIMAL(20,0)))"
    return f"CAST(round({exact}, {digits}) AS DOUBLE)"


def _money_mean(cents: str, count: str) -> str:
    return _ratio(cents, f"({count}) * 100", 2)


#: Name, parameters, returned columns and body of each function; a parameter goes by its function's name,
#: as a column of the same name would come first.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "daily_revenue": (
        "window_rows INT DEFAULT 7",
        "date DATE, daily_orders BIGINT, daily_revenue DOUBLE, rolling_avg DOUBLE, daily_discount DOUBLE",
        f"""
        WITH numbered AS (
            SELECT *, row_number() OVER (ORDER BY date) AS r FROM {PREFIX}daily_totals
        ), spread AS (  -- each day counts for itself and the following days of the window
            SELECT revenue_cents, explode(sequence(r, r + daily_revenue.window_rows - 1)) AS r FROM numbered
        ), recent AS (
            SELECT r, sum(revenue_cents) AS cents, count(revenue_cents) AS days FROM spread GROUP BY r
        )
        SELECT date, daily_orders, {_dollars("revenue_cents")}, {_money_mean("cents", "days")},
               {_dollars("discount_cents")}
        FROM numbered JOIN recent USING (r)""",
    ),
    "ltv_segments": (
        "mid DOUBLE DEFAULT 500, high DOUBLE DEFAULT 2000",
        "ltv_segment STRING, user_count BIGINT, avg_ltv DOUBLE, avg_orders DOUBLE, "
        "avg_order_value DOUBLE, avg_lifespan_days DOUBLE",
        f"""
        WITH segmented AS (
            SELECT *, CASE WHEN {_dollars("spend_cents")} > ltv_segments.high THEN 'High Value'
                           WHEN {_dollars("spend_cents")} > ltv_segments.mid THEN 'Mid Value'
                           ELSE 'Low Value' END AS segment
            FROM {PREFIX}customer_totals
        )
        SELECT segment, count(*), {_money_mean("sum(spend_cents)", "count(spend_cents)")},
               {_ratio("sum(order_count)", "count(order_count)", 1)},
               {_money_mean("sum(order_value_cents)", "count(order_value_cents)")},
               {_ratio("sum(lifespan_days)", "count(lifespan_days)", 0)}
        FROM segmented GROUP BY segment""",
    ),
    "funnel_by_referrer": (
        "min_sessions BIGINT DEFAULT 0",
        "referrer STRING, total_sessions BIGINT, converted BIGINT, abandoned BIGINT, browsed BIGINT, "
        "conversion_rate_pct DOUBLE, avg_session_dur_sec DOUBLE",
        f"""
        SELECT referrer, total_sessions, converted, abandoned, browsed, conversion_rate_pct,
               avg_session_dur_sec
        FROM {PREFIX}funnel WHERE total_sessions >= funnel_by_referrer.min_sessions""",
    ),
    "user_spend": (
        "first_month STRING DEFAULT '0000-00', last_month STRING DEFAULT '9999-99'",
        "user_id STRING, spend DOUBLE",
        f"""
        SELECT CAST(user_id AS STRING),
               CAST(sum(CAST(monthly_spend AS DECIMAL(30,2))) AS DOUBLE)
        FROM {PREFIX}monthly_spend
        WHERE txn_month BETWEEN user_spend.first_month AND user_spend.last_month GROUP BY user_id""",
    ),
}


def register_functions(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Create the functions over cleaned ``transactions`` and ``sessions``; their names.

    Functions and views are temporary and replaced when this is called again.  It starts no job.
    """
    views = {
        "daily_totals": revenue.daily_totals(tables["transactions"]),
        "customer_totals": customers.customer_totals(tables["transactions"]),
        "funnel": funnels.funnel_by_referrer(tables["sessions"]),
        "monthly_spend": customers.user_monthly_spend(tables["transactions"]),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(f"{PREFIX}{name}")
    for name, (parameters, columns, body) in FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) RETURN {body}"
        )
    return list(FUNCTIONS)
