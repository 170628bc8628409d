"""Distinct users of a product over any range of days, from stored daily rows.

Daily distinct counts cannot be added: a user who comes on two days counts twice.  Two
kinds of rows can be put together instead:

* Gaps, exact: users per product, day and the day before on which they came.  In a range
  each user has one first visit, the one whose day before lies before the range, so a range
  is a sum over gap rows.  There are no user ids in them, and as many rows for a product and
  day as there are earlier days its users last came on.
* Sketches: a theta sketch for each product and day, of bounded size.  Their union over a
  range is exact up to ``2 ** lg_entries`` users and has a relative standard error of about
  ``1 / sqrt(2 ** lg_entries)`` beyond, 1.6 % for 12.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.keys import compact_day

LG_ENTRIES = 12


def daily_visitors(views: DataFrame) -> DataFrame:
    """Each product, user and day with a product page view once, as `keyed.product_performance_daily`
    counts them.  A null user is no visitor but keeps the product and day."""
    product = F.col("product_id")
    counted = views.filter(
        (F.col("page_type") == "product_detail")
        & product.isNotNull()
        & (product.cast("string") != "")
        & F.col("timestamp").isNotNull()
    )
    return counted.select("product_id", "user_id", compact_day(F.col("timestamp")).alias("day")).distinct()


def visitor_gaps(visitors: DataFrame, last_seen: DataFrame | None = None) -> DataFrame:
    """``product_id``, ``day``, ``last_day`` (null for a first visit) and the ``users`` whose visits are so
    far apart.

    ``last_seen`` is what `extended` gave for all days before; days of ``visitors`` come after its days.
    The largest window is one user's days with one product.
    """
    days = visitors.select("product_id", "user_id", "day", F.lit(True).alias("new"))
    if last_seen is not None:
        days = days.unionByName(last_seen.withColumn("new", F.lit(False)))
    before = Window.partitionBy("product_id", "user_id").orderBy("day")
    gaps = days.withColumn("last_day", F.lag("day").over(before)).filter("new")
    return gaps.groupBy("product_id", "day", "last_day").agg(F.count("user_id").alias("users"))


def extended(visitors: DataFrame, last_seen: DataFrame | None = None) -> DataFrame:
    """The last day of each product and user, after the days of ``visitors``: what the next days need."""
    days = visitors.select("product_id", "user_id", "day")
    if last_seen is not None:
        days = days.unionByName(last_seen.select(days.columns))
    return days.groupBy("product_id", "user_id").agg(F.max("day").alias("day"))


def reach_in_range(gaps: DataFrame, start: str, end: str) -> DataFrame:
    """Per product the distinct users from day ``start`` up to but not including ``end``."""
    first = F.col("last_day").isNull() | (F.col("last_day") < start)
    chosen = gaps.filter((F.col("day") >= start) & (F.col("day") < end) & first)
    return chosen.groupBy("product_id").agg(F.sum("users").alias("unique_users"))


def daily_sketches(visitors: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """A theta sketch of the users of each product and day."""
    sketch = F.theta_sketch_agg("user_id", lg_entries)
    return visitors.groupBy("product_id", "day").agg(sketch.alias("users"))


def sketched_reach(
    sketches: DataFrame, start: str, end: str, lg_entries: int = LG_ENTRIES
) -> DataFrame:
    """`reach_in_range` from `daily_sketches`, exact for up to ``2 ** lg_entries`` users."""
    chosen = sketches.filter((F.col("day") >= start) & (F.col("day") < end))
    union = F.theta_sketch_estimate(F.theta_union_agg("users", lg_entries))
    return chosen.groupBy("product_id").agg(union.alias("unique_users"))
