"""Customer value: spend per user, value segments, engagement, profiles and cohorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.numeric import cents, dollars, money_mean, ratio, rounded, total
from basketry.functions.times import whole_days_between
from basketry.operators.quantiles import approximate_quantiles, exact_quantiles
from basketry.operators.revenue import completed
from basketry.operators.sessions import CONVERSION_STATUSES


def user_monthly_spend(transactions: DataFrame) -> DataFrame:
    """Completed spend per user and month."""
    return (
        completed(transactions)
        .groupBy("user_id", F.col("year_month").alias("txn_month"))
        .agg(dollars(total(F.col("total"))).alias("monthly_spend"))
    )


def cohort_revenue(
    users: DataFrame, transactions: DataFrame, digits: int | None = 2
) -> DataFrame:
    """Registration month x transaction month: buying users, revenue, revenue per buyer.

    Spend is summed per user and month before the join, so a busy user is one row.
    """
    cohorts = users.select("user_id", F.col("reg_year_month").alias("cohort_month"))
    spend = F.col("monthly_spend")
    return (
        user_monthly_spend(transactions)
        .join(cohorts, "user_id")
        .groupBy("cohort_month", "txn_month")
        .agg(
            F.count("user_id").alias("active_users"),
            dollars(total(spend)).alias("cohort_revenue"),
            money_mean(total(spend), F.count(spend), digits).alias("arpu"),
        )
        .orderBy("cohort_month", "txn_month")
    )


def customer_totals(transactions: DataFrame) -> DataFrame:
    """Per user completed orders, spend and mean order value in cents, and days from first to last."""
    spent = F.col("total")
    return (
        completed(transactions)
        .groupBy("user_id")
        .agg(
            F.count("*").alias("order_count"),
            total(spent).alias("spend_cents"),
            cents(money_mean(total(spent), F.count(spent), 2)).alias("order_value_cents"),
            F.datediff(F.max("date"), F.min("date")).alias("lifespan_days"),
        )
    )


def ltv_segments(
    transactions: DataFrame, mid: float = 500.0, high: float = 2000.0
) -> DataFrame:
    """Users by fixed spend thresholds: count, mean spend, orders, order value and days
    between first and last purchase.  Averages are over per-user values rounded to cents."""
    per_user = customer_totals(transactions)
    spend = dollars(F.col("spend_cents"))
    segment = (
        F.when(spend > high, "High Value").when(spend > mid, "Mid Value").otherwise("Low Value")
    )

    def mean_of(column: str, digits: int) -> Column:
        return ratio(F.sum(column), F.count(column), digits)

    return (
        per_user.groupBy(segment.alias("ltv_segment"))
        .agg(
            F.count("*").alias("user_count"),
            money_mean(F.sum("spend_cents"), F.count("spend_cents"), 2).alias("avg_ltv"),
            mean_of("order_count", 1).alias("avg_orders"),
            money_mean(F.sum("order_value_cents"), F.count("order_value_cents"), 2).alias(
                "avg_order_value"
            ),
            mean_of("lifespan_days", 0).alias("avg_lifespan_days"),
        )
        .orderBy(F.desc("avg_ltv"), "ltv_segment")
    )


def clv_features(transactions: DataFrame, digits: int | None = 2) -> DataFrame:
    """Per user over completed transactions: orders, spend, mean order value, discount,
    first and last purchase, lifetime value, full days between them, discount rate %.

    Amounts that are missing count as 0, also in the mean.
    """
    spent = F.coalesce("total", F.lit(0.0))
    discount = F.coalesce("discount", F.lit(0.0))
    per_user = (
        completed(transactions)
        .filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("order_count"),
            dollars(total(spent)).alias("total_spend"),
            money_mean(total(spent), F.count("*"), None).alias("avg_order_val"),
            dollars(total(discount)).alias("total_discount"),
            F.min("timestamp").alias("first_purchase"),
            F.max("timestamp").alias("last_purchase"),
        )
    )
    spend, off = F.col("total_spend"), F.col("total_discount")
    lifespan = whole_days_between(F.col("first_purchase"), F.col("last_purchase"))
    return per_user.withColumns(
        {
            "clv": spend,
            "lifespan_days": F.coalesce(lifespan, F.lit(0)),
            "discount_rate_pct": rounded(
                F.lit(100.0) * off / (spend + off + F.lit(0.01)), digits
            ),
        }
    )


def clv_tier(
    clv: DataFrame, qs: Sequence[float] = (0.33, 0.66), exact: bool = True
) -> DataFrame:
    """``clv`` with ``clv_tier``: Low up to the first quantile, Mid up to the second,
    High above.  ``exact=False`` takes the quantiles from Spark's sketch.

    The two edges reach the rows as one scalar subquery, not as a join.
    """
    find = exact_quantiles if exact else approximate_quantiles
    edges = find(clv, "clv", qs).select(F.struct("q0", "q1").alias("edges"))
    return (
        clv.withColumn("_edges", edges.scalar())
        .withColumn(
            "clv_tier",
            F.when(F.col("clv") <= F.col("_edges.q0"), "Low")
            .when(F.col("clv") <= F.col("_edges.q1"), "Mid")
            .when(F.col("clv") > F.col("_edges.q1"), "High"),
        )
        .drop("_edges")
    )


def engagement_features(sessions: DataFrame, digits: int | None = 2) -> DataFrame:
    """Per user: sessions, mean and total duration, outcomes, conversion %, most frequent
    device and referrer (the alphabetically first of equals).

    One aggregation and one shuffle; the two modes keep a count per device type and
    referrer, which are short lists.
    """
    duration = F.coalesce(F.col("duration_seconds").cast("bigint"), F.lit(0))
    per_user = (
        sessions.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count("session_id").alias("total_sessions"),
            ratio(F.sum(duration), F.count("*"), 1).alias("avg_session_dur"),
            F.sum(duration).alias("total_session_dur"),
            *[
                F.count_if(F.col("conversion_status") == status).alias(status)
                for status in CONVERSION_STATUSES
            ],
            F.count("conversion_status").alias("with_status"),
            F.mode(F.coalesce("device_profile.type", F.lit("unknown")), True).alias(
                "preferred_device"
            ),
            F.mode("referrer", True).alias("primary_referrer"),
        )
    )
    outcomes = F.col("converted") + F.col("abandoned") + F.col("browsed")
    rate = F.lit(100.0) * F.col("converted") / (outcomes + F.lit(0.001))
    known = F.col("with_status") > 0
    return per_user.select(
        "user_id",
        "total_sessions",
        "avg_session_dur",
        "total_session_dur",
        F.when(known, F.col("converted")).alias("converted"),
        F.when(known, F.col("abandoned")).alias("abandoned"),
        F.when(known, rounded(rate, digits)).alias("user_conversion_rate"),
        "preferred_device",
        "primary_referrer",
    )


def unified_profile(clv: DataFrame, engagement: DataFrame, users: DataFrame) -> DataFrame:
    """One row per buyer: value, engagement, registration date and country.  Buyers
    without sessions get 0 sessions and 'unknown' device and referrer.

    All inputs are one row per user and hash-partitioned by it after their own
    grouping, so the two joins add no shuffle of their own on those sides.
    """
    people = users.select("user_id", "registration_date", "country")
    return (
        clv.join(engagement, "user_id", "left")
        .join(people, "user_id", "left")
        .fillna(
            {
                "total_sessions": 0,
                "avg_session_dur": 0.0,
                "user_conversion_rate": 0.0,
                "preferred_device": "unknown",
                "primary_referrer": "unknown",
            }
        )
    )


def _mean_clv(digits: int | None) -> Column:
    return money_mean(total(F.col("clv")), F.count("clv"), digits)


def _mean_count(column: str, digits: int | None) -> Column:
    return ratio(F.sum(column), F.count(column), digits)


def _mean_hundredths(column: str, digits: int | None) -> Column:
    """Mean of a column that was rounded to at most two decimals per user."""
    return money_mean(total(F.col(column)), F.count(column), digits)


def _tier_order() -> Column:
    return F.expr("array_position(array('Low', 'Mid', 'High'), clv_tier)")


def clv_segment_summary(unified: DataFrame, digits: int | None = 2) -> DataFrame:
    """Per value tier: users, and mean value, orders, sessions, session duration,
    conversion and discount rate; Low, Mid, High."""
    return (
        unified.filter(F.col("clv_tier").isNotNull())
        .groupBy("clv_tier")
        .agg(
            F.count("user_id").alias("user_count"),
            _mean_clv(digits).alias("avg_clv"),
            _mean_count("order_count", digits).alias("avg_order_count"),
            _mean_count("total_sessions", digits).alias("avg_sessions"),
            _mean_hundredths("avg_session_dur", digits).alias("avg_session_dur_sec"),
            _mean_hundredths("user_conversion_rate", digits).alias("avg_conversion_rate"),
            _mean_hundredths("discount_rate_pct", digits).alias("avg_discount_rate_pct"),
        )
        .orderBy(_tier_order())
    )


def clv_segment_behaviour(
    unified: DataFrame, digits: int | None = 2, exact: bool = True
) -> DataFrame:
    """The chart behind the tiers: quantile tiers worked out again on the saved profile,
    with mean value, orders, sessions, conversion, and users."""
    return clv_segment_summary(clv_tier(unified, exact=exact), digits).select(
        "clv_tier",
        "avg_clv",
        F.col("avg_order_count").alias("avg_orders"),
        "avg_sessions",
        F.col("avg_conversion_rate").alias("avg_conv_rate"),
        "user_count",
    )


def top_clv_users(unified: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most valuable users; equals in user_id order."""
    return (
        unified.orderBy(F.desc("clv"), "user_id")
        .limit(n)
        .select(
            "user_id",
            "clv",
            "order_count",
            "total_sessions",
            "avg_session_dur",
            "user_conversion_rate",
            "preferred_device",
        )
    )


def referrer_revenue(unified: DataFrame, digits: int | None = 2) -> DataFrame:
    """Users, revenue, mean value and mean conversion per primary referrer, by revenue."""
    return (
        unified.groupBy("primary_referrer")
        .agg(
            F.count("user_id").alias("user_count"),
            dollars(total(F.col("clv"))).alias("total_rev"),
            _mean_clv(digits).alias("avg_clv"),
            _mean_hundredths("user_conversion_rate", digits).alias("avg_conv_rate"),
        )
        .orderBy(F.desc("total_rev"), "primary_referrer")
    )


def clv_segments_fixed(
    transactions: DataFrame,
    sessions: DataFrame,
    mid: float = 500.0,
    high: float = 2000.0,
    digits: int | None = 2,
) -> DataFrame:
    """Value tiers by fixed thresholds with users and mean value, orders and sessions;
    the short form of the profile, from transactions and sessions alone."""
    clv = (
        completed(transactions)
        .groupBy("user_id")
        .agg(
            F.count("*").alias("order_count"),
            dollars(total(F.col("total"))).alias("clv"),
        )
    )
    engagement = sessions.groupBy("user_id").agg(F.count("*").alias("total_sessions"))
    tier = (
        F.when(F.col("clv") > high, "High").when(F.col("clv") > mid, "Mid").otherwise("Low")
    )
    return (
        clv.join(engagement, "user_id", "left")
        .groupBy(tier.alias("clv_tier"))
        .agg(
            F.count("user_id").alias("users"),
            _mean_clv(digits).alias("avg_clv"),
            _mean_count("order_count", 1).alias("avg_orders"),
            _mean_count("total_sessions", 1).alias("avg_sessions"),
        )
        .orderBy(F.desc("avg_clv"), "clv_tier")
    )
