"""Cleaning, enrichment and quality checks of the raw entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.numeric import ratio
from basketry.functions.times import parsed
from basketry.functions.typed import typed
from basketry.sources import schemas


def clean_transactions(raw: DataFrame, tidy_status: bool = False) -> DataFrame:
    """Typed transactions: parsed time, zero for no discount (null for one that is no number),
    normalised status, a flag (not a filter) for totals that are not positive, and derived
    date and month.

    ``tidy_status`` says that the source's status is lower case without spaces already, so
    that filters on it can reach the source.
    """
    no_discount = F.col("discount").isNull()
    cast = typed(raw.withColumn("_none", no_discount), schemas.TRANSACTIONS)
    status = F.col("status") if tidy_status else F.lower(F.trim("status"))
    whole = cast.withColumns(
        {
            "timestamp": parsed(cast, "timestamp"),
            "discount": F.when(F.col("_none"), 0.0).otherwise(F.col("discount").cast("double")),
            "total": F.col("total").cast("double"),
            "subtotal": F.col("subtotal").cast("double"),
            "status": status,
        }
    ).drop("_none")
    return whole.withColumns(
        {
            "is_suspicious": F.coalesce(F.col("total") <= 0, F.lit(False)),
            "date": F.to_date("timestamp"),
            "year_month": F.date_format("timestamp", "yyyy-MM"),
        }
    )


def clean_users(raw: DataFrame, as_of: Column) -> DataFrame:
    """Typed users with country (default 'Unknown'), registration month and tenure in
    days at ``as_of`` (pass ``F.current_date()`` for today)."""
    dated = raw.withColumns(
        {
            "registration_date": parsed(raw, "registration_date"),
            "last_active": parsed(raw, "last_active"),
            "country": F.coalesce(F.col("geo_data.country"), F.lit("Unknown")),
        }
    )
    return dated.withColumns(
        {
            "reg_year_month": F.date_format("registration_date", "yyyy-MM"),
            "tenure_days": F.datediff(as_of, F.to_date("registration_date")),
        }
    )


def clean_products(raw: DataFrame) -> DataFrame:
    """Typed products: zero for no stock, boolean activity, length of the price history
    and whether the price ever changed."""
    cast = typed(raw.withColumn("_none", F.col("current_stock").isNull()), schemas.PRODUCTS)
    stock = F.when(F.col("_none"), 0).otherwise(F.col("current_stock"))
    changes = F.coalesce(F.size("price_history"), F.lit(0))
    return cast.withColumns(
        {
            "current_stock": stock.cast("int"),
            "price_history_len": F.greatest(changes, F.lit(0)),
            "is_price_volatile": changes > 1,
        }
    ).drop("_none")


def clean_sessions(raw: DataFrame) -> DataFrame:
    """Typed sessions: numbers in durations, page views and carts."""
    return typed(raw, schemas.SESSIONS)


def clean_categories(raw: DataFrame) -> DataFrame:
    """Typed categories."""
    return typed(raw, schemas.CATEGORIES)


def enrich_products(
    products: DataFrame, categories: DataFrame, missing: str | None = "Unknown"
) -> DataFrame:
    """Products with ``category_name`` and ``subcategory_name``; ``missing`` stands in
    where the catalog has no such id (None leaves null).

    The lookups are grouped by id first, so a repeated id cannot multiply products.
    """
    category = categories.groupBy("category_id").agg(F.max("name").alias("category_name"))
    subcategory = (
        categories.select(F.explode("subcategories").alias("sub"))
        .groupBy(F.col("sub.subcategory_id").alias("subcategory_id"))
        .agg(F.max("sub.name").alias("subcategory_name"))
    )
    named = products.join(category, "category_id", "left").join(
        subcategory, "subcategory_id", "left"
    )
    if missing is None:
        return named
    return named.fillna(missing, ["category_name", "subcategory_name"])


def transaction_quality_profile(transactions: DataFrame, digits: int | None = 1) -> DataFrame:
    """One row: transactions, those outside any session (count and %), suspicious ones."""
    return with_percent(transactions.agg(*quality_counts()), digits)


def quality_counts() -> list[Column]:
    """What is counted of cleaned transactions, by a query or by the job that writes them."""
    return [
        F.count("*").alias("total_transactions"),
        F.count_if(F.col("session_id").isNull()).alias("standalone"),
        F.count_if("is_suspicious").alias("suspicious"),
    ]


def with_percent(counted: DataFrame, digits: int | None = 1) -> DataFrame:
    """The profile of one row of `quality_counts`."""
    return counted.withColumn(
        "standalone_pct", ratio(F.col("standalone") * 100, F.col("total_transactions"), digits)
    )
