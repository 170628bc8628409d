"""Session funnels, and revenue by the device a session came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.numeric import dollars, money_mean, ratio, total
from basketry.operators.revenue import completed

# The outcomes of a session.
CONVERSION_STATUSES = ("converted", "abandoned", "browsed")

# Operating systems that get a column of their own.
OPERATING_SYSTEMS = ("iOS", "Android", "Windows", "macOS", "Linux")


def _status_counts() -> list:
    return [
        F.count_if(F.col("conversion_status") == status).alias(status)
        for status in CONVERSION_STATUSES
    ]


def funnel_by_referrer(
    sessions: DataFrame, digits: int | None = 2, duration_digits: int | None = 0
) -> DataFrame:
    """Per referrer: sessions by outcome, conversion % and mean duration, best first."""
    duration = F.col("duration_seconds").cast("bigint")
    counted = sessions.groupBy("referrer").agg(
        F.count("*").alias("total_sessions"),
        *_status_counts(),
        F.sum(duration).alias("duration_sum"),
        F.count(duration).alias("duration_count"),
    )
    return counted.select(
        "referrer",
        "total_sessions",
        *CONVERSION_STATUSES,
        ratio(F.col("converted") * 100, F.col("total_sessions"), digits).alias(
            "conversion_rate_pct"
        ),
        ratio(F.col("duration_sum"), F.col("duration_count"), duration_digits).alias(
            "avg_session_dur_sec"
        ),
    ).orderBy(F.desc("conversion_rate_pct"), "referrer")


def funnel_composition(sessions: DataFrame) -> DataFrame:
    """Per referrer: outcome counts, their total, unrounded conversion %, and whether it
    lies above the median of all referrers; lowest first.

    The median is taken over one row per referrer, a closed list of channels.
    """
    counted = (
        sessions.filter(F.col("referrer").isNotNull() & F.col("conversion_status").isNotNull())
        .groupBy("referrer")
        .agg(*_status_counts(), F.count("*").alias("total"))
        .withColumn("conversion_rate", ratio(F.col("converted") * 100, F.col("total"), None))
    )
    median = counted.agg(F.percentile("conversion_rate", F.lit(0.5))).scalar()
    return counted.withColumn("above_median", F.col("conversion_rate") > median).orderBy(
        "conversion_rate", "referrer"
    )


def referrer_conversion(sessions: DataFrame) -> DataFrame:
    """Share of converted sessions per referrer in %, unrounded, best first; a session
    without outcome counts as not converted."""
    converted = F.count_if(F.col("conversion_status") == "converted")
    return (
        sessions.filter(F.col("referrer").isNotNull())
        .groupBy("referrer")
        .agg((ratio(converted, F.count("*"), None) * F.lit(100.0)).alias("conversion_pct"))
        .orderBy(F.desc("conversion_pct"), "referrer")
    )


def revenue_by_device_os(
    transactions: DataFrame, sessions: DataFrame, digits: int | None = 2
) -> DataFrame:
    """Completed transactions, revenue and mean order value per device type and OS of
    the session they were made in; transactions outside sessions do not count."""
    devices = sessions.select(
        "session_id",
        F.col("device_profile.type").alias("device_type"),
        F.col("device_profile.os").alias("os"),
    )
    return (
        completed(transactions)
        .select("session_id", "transaction_id", "total")
        .join(devices, "session_id")
        .groupBy("device_type", "os")
        .agg(
            F.count_distinct("transaction_id").alias("transactions"),
            dollars(total(F.col("total"))).alias("revenue"),
            money_mean(total(F.col("total")), F.count("total"), digits).alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue"), "device_type", "os")
    )


def device_os_matrix(
    transactions: DataFrame,
    sessions: DataFrame,
    os_values: Sequence[str] = OPERATING_SYSTEMS,
) -> DataFrame:
    """Completed revenue in thousands (1 decimal): a row per device type, a column per
    OS in ``os_values``, 'other' for any other, 'unknown' where the session does not say.

    All revenue is in one of the columns, and no job runs to find their names.
    """
    unknown, listed = F.lit("unknown"), [name for name in os_values if name != "unknown"]
    devices = sessions.select(
        "session_id",
        F.coalesce("device_profile.type", unknown).alias("device_type"),
        F.coalesce("device_profile.os", unknown).alias("os"),
    )
    name = F.when(F.col("os").isin(*listed, "unknown"), F.col("os")).otherwise("other")
    columns = [*listed, "other", "unknown"]
    matrix = (
        completed(transactions)
        .select("session_id", "total")
        .join(devices, "session_id")
        .groupBy("device_type", name.alias("os"))
        .agg(total(F.col("total")).alias("cents"))
        .groupBy("device_type")
        .pivot("os", columns)
        .agg(F.sum("cents"))
        .fillna(0)
    )
    return matrix.select(
        "device_type",
        *[ratio(F.col(f"`{c}`"), F.lit(100_000), 1).alias(c) for c in columns],
    ).orderBy("device_type")
