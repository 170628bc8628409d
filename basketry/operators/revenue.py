"""Revenue by day, product and category.

Line-level operators take flat order lines (see ``order_lines``): one row per item with
its transaction's id, user, date, status, whole discount and number of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.numeric import dollars, money_mean, rounded, total


def completed(df: DataFrame) -> DataFrame:
    """Rows of completed transactions."""
    return df.filter(F.col("status") == "completed")


def order_lines(transactions: DataFrame) -> DataFrame:
    """Nested transactions -> one row per item; transactions without items give none."""
    return transactions.select(
        "transaction_id",
        "user_id",
        "timestamp",
        "date",
        "status",
        "discount",
        F.size("items").alias("n_lines"),
        F.explode("items").alias("item"),
    ).select(
        "transaction_id",
        "user_id",
        "timestamp",
        "date",
        "status",
        "discount",
        "n_lines",
        "item.product_id",
        "item.quantity",
        "item.unit_price",
        "item.subtotal",
    )


def daily_totals(transactions: DataFrame) -> DataFrame:
    """Per day with completed orders: orders, and revenue and discount in cents."""
    return (
        completed(transactions)
        .filter(F.col("date").isNotNull())
        .groupBy("date")
        .agg(
            F.count("*").alias("daily_orders"),
            total(F.col("total")).alias("revenue_cents"),
            total(F.col("discount")).alias("discount_cents"),
        )
    )


def daily_revenue(
    transactions: DataFrame, digits: int | None = 2, window_rows: int = 7
) -> DataFrame:
    """Per day with completed orders: orders, revenue, discount, and mean revenue over
    this and the previous six day *rows* (days without orders are not counted).

    The window runs on one row per day, never on transactions.
    """
    daily = daily_totals(transactions)
    recent = Window.orderBy("date").rowsBetween(1 - window_rows, Window.currentRow)
    return daily.select(
        "date",
        "daily_orders",
        dollars(F.col("revenue_cents")).alias("daily_revenue"),
        money_mean(
            F.sum("revenue_cents").over(recent), F.count("revenue_cents").over(recent), digits
        ).alias("rolling_7d_avg"),
        dollars(F.col("discount_cents")).alias("daily_discount"),
    ).orderBy("date")


def daily_revenue_series(transactions: DataFrame) -> DataFrame:
    """The unrounded series behind a daily revenue chart."""
    return daily_revenue(transactions, digits=None).select(
        "date",
        F.col("daily_revenue").alias("revenue"),
        F.col("daily_orders").alias("orders"),
        F.col("daily_discount").alias("discount"),
        F.col("rolling_7d_avg").alias("rolling7"),
    )


def _per_product(lines: DataFrame, *extra: Column) -> DataFrame:
    """Completed lines summed per product: the one large shuffle of these reports,
    after map-side partial sums, so the later catalog join only sees one row each."""
    return (
        completed(lines)
        .groupBy("product_id")
        .agg(
            F.coalesce(total(F.col("subtotal")), F.lit(0)).alias("gross_cents"),
            F.count("*").alias("line_count"),
            F.coalesce(F.sum(F.col("quantity").cast("bigint")), F.lit(0)).alias("units"),
            *extra,
        )
    )


def product_popularity(
    lines: DataFrame, products: DataFrame, n: int = 15, digits: int | None = 2
) -> DataFrame:
    """Top ``n`` products by revenue with units, number of lines, mean unit price, and
    name and category from the enriched catalog ('Unknown' when not in it)."""
    price = F.col("unit_price")
    top = (
        _per_product(lines, total(price).alias("price_cents"), F.count(price).alias("priced"))
        .orderBy(F.desc("gross_cents"), "product_id")
        .limit(n)
    )
    catalog = products.select("product_id", "name", "category_name")
    return (
        top.join(catalog, "product_id", "left")
        .select(
            "product_id",
            F.coalesce("name", F.lit("Unknown")).alias("product_name"),
            F.coalesce("category_name", F.lit("Unknown")).alias("category_name"),
            F.col("units").alias("total_units"),
            dollars(F.col("gross_cents")).alias("total_revenue"),
            F.col("line_count").alias("order_count"),
            money_mean(F.col("price_cents"), F.col("priced"), digits).alias("avg_unit_price"),
        )
        .orderBy(F.desc("total_revenue"), "product_id")
    )


def revenue_by_category(
    lines: DataFrame, products: DataFrame, digits: int | None = 2
) -> DataFrame:
    """Gross revenue, lines, units, distinct products and discount per category.

    The transaction's whole discount counts once per *line*, so a basket of three adds
    it three times; ``category_revenue_allocated`` splits it instead.  Products outside
    the catalog form the null category.
    """
    discount = total(F.col("discount")).alias("discount_cents")
    catalog = products.select("product_id", "category_name")
    per_category = (
        _per_product(lines, discount)
        .join(catalog, "product_id", "left")
        .groupBy(F.col("category_name").alias("category"))
        .agg(
            F.sum("gross_cents").alias("gross_cents"),
            F.sum("line_count").alias("total_orders"),
            F.sum("units").alias("total_units_sold"),
            F.sum("discount_cents").alias("discount_cents"),
            F.count("*").alias("unique_products"),
        )
    )
    gross, total_discount = dollars(F.col("gross_cents")), dollars(F.col("discount_cents"))
    share = total_discount / (gross + F.lit(0.01)) * F.lit(100.0)
    return per_category.select(
        "category",
        gross.alias("gross_revenue"),
        "total_orders",
        "total_units_sold",
        total_discount.alias("total_discount"),
        "unique_products",
        rounded(share, digits).alias("discount_pct"),
    ).orderBy(F.desc("gross_revenue"), "category")


def category_revenue_allocated(
    lines: DataFrame, products: DataFrame, n: int | None = 12, digits: int | None = None
) -> DataFrame:
    """Gross and net revenue, units and discount rate per category, the discount split
    evenly over the basket's lines; top ``n`` by net (None: all).  Lines whose product
    has no category are left out, as they belong to no bar of this report."""
    # 12 decimals: exact sums of thirds and sevenths of a cent, whatever the row order.
    share = (
        (F.col("discount").cast("decimal(16,6)") * 100)
        / F.greatest(F.col("n_lines"), F.lit(1)).cast("decimal(10,0)")
    ).cast("decimal(28,12)")
    catalog = products.select("product_id", "category_name")
    per_category = (
        _per_product(lines, F.sum(share).alias("share_cents"))
        .join(catalog.filter(F.col("category_name").isNotNull()), "product_id")
        .groupBy("category_name")
        .agg(
            F.sum("gross_cents").alias("gross_cents"),
            F.sum("share_cents").alias("share_cents"),
            F.sum("units").alias("units_sold"),
        )
    )
    gross = dollars(F.col("gross_cents"))
    discount = F.col("share_cents").cast("double") / F.lit(100.0)
    report = per_category.select(
        "category_name",
        gross.alias("gross_revenue"),
        rounded(discount, digits).alias("total_discount"),
        "units_sold",
        rounded(gross - discount, digits).alias("net_revenue"),
        rounded(F.lit(100.0) * discount / (gross + F.lit(0.01)), digits).alias("discount_rate"),
    ).orderBy(F.desc("net_revenue"), "category_name")
    return report if n is None else report.limit(n)


def product_sales_daily(lines: DataFrame) -> DataFrame:
    """Completed units, revenue and distinct orders per product and day."""
    return (
        completed(lines)
        .filter(F.col("product_id").isNotNull() & F.col("date").isNotNull())
        .groupBy("product_id", F.date_format("date", "yyyyMMdd").alias("day"))
        .agg(
            F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
            dollars(total(F.col("subtotal"))).alias("revenue"),
            F.count_distinct("transaction_id").alias("order_count"),
        )
    )
