"""Quantiles of a money column over any period, from sketches that are stored once a day.

A KLL sketch of a day's values has bounded size and can be merged with others, so the
quantiles of a month or a year, or the edges of value tiers, read a row per day and no orders.
A sketch keeps all values while there are few and is then off in rank by at most
`RANK_ERROR` of all values, for any number of merges (99 % confidence, k = 4096).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.revenue import completed

K = 4096
#: Of all values, by which the rank of a quantile may be off.
RANK_ERROR = 0.001


def daily_value_sketches(transactions: DataFrame, k: int = K) -> DataFrame:
    """Per day of completed orders the sketch of their totals; null totals do not count."""
    return value_sketches(completed(transactions).filter("date is not null"), "total", ["date"], k)


def value_sketches(df: DataFrame, column: str, by: Sequence[str], k: int = K) -> DataFrame:
    """``by``, the sketch of ``column``, and the number ``n`` of its values."""
    known = df.filter(F.col(column).isNotNull())
    return known.groupBy(*by).agg(
        F.kll_sketch_agg_double(F.col(column).cast("double"), k).alias("sketch"),
        F.count("*").alias("n"),
    )


def merged_quantiles(
    sketches: DataFrame, qs: Sequence[float], by: Sequence[Column | str] = (), k: int = K
) -> DataFrame:
    """Quantiles ``q0``, ``q1``, ... of all values of the sketches, in each group of ``by``, and ``n``.

    A quantile is the smallest value that at least this share of the values does not pass.
    """
    merged = sketches.groupBy(*by).agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n")
    )
    found = [
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(f"q{i}")
        for i, q in enumerate(qs)
    ]
    return merged.select(*[c for c in merged.columns if c not in ("sketch", "n")], *found, "n")


def value_tier(
    values: DataFrame, column: str, sketches: DataFrame, qs: Sequence[float] = (0.33, 0.66)
) -> DataFrame:
    """``values`` with ``tier``: Low up to the first quantile of the sketched values, Mid up to the
    second, High above; null values have none.  The edges reach the rows as a scalar subquery."""
    edges = merged_quantiles(sketches, qs).select(F.struct("q0", "q1").alias("edges"))
    value = F.col(column)
    tier = (
        F.when(value <= F.col("_edges.q0"), "Low")
        .when(value <= F.col("_edges.q1"), "Mid")
        .when(value > F.col("_edges.q1"), "High")
    )
    return values.withColumn("_edges", edges.scalar()).withColumn("tier", tier).drop("_edges")
