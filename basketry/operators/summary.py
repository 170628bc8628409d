"""The headline figures of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.numeric import dollars, money_mean, rounded, total
from basketry.operators.revenue import category_revenue_allocated, completed
from basketry.operators.sessions import referrer_conversion


def kpi_summary(
    transactions: DataFrame,
    sessions: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    digits: int | None = None,
) -> DataFrame:
    """One row: total revenue, mean order value, best converting referrer with its
    conversion %, and the top category by net revenue.

    The last three come in as scalar subqueries over grouped rows.
    """
    best = referrer_conversion(sessions).limit(1).select(F.struct("referrer", "conversion_pct"))
    top = category_revenue_allocated(lines, products, n=1)
    return (
        completed(transactions)
        .agg(
            dollars(total(F.col("total"))).alias("total_revenue"),
            money_mean(total(F.col("total")), F.count("total"), digits).alias("avg_order_value"),
        )
        .withColumn("best", best.scalar())
        .select(
            "total_revenue",
            "avg_order_value",
            F.col("best.referrer").alias("best_referrer"),
            rounded(F.col("best.conversion_pct"), digits).alias("best_conversion_pct"),
            top.select("category_name").scalar().alias("top_category"),
        )
    )
