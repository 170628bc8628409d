"""Quantiles of money columns that stay exact without gathering the values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.numeric import cents, dollars

# A bigint of cents is narrowed by about 21 bits at a time, so that no histogram holds
# more than 2^22 rows.
SHIFTS = (42, 21, 0)


def exact_quantiles(df: DataFrame, column: str, qs: Sequence[float]) -> DataFrame:
    """One row with columns ``q0``, ``q1``, ...: the quantiles of a dollar column, with
    linear interpolation between neighbouring ranks, as pandas and numpy define them.

    The values are grouped into (value, count) first, so one value on a third of the rows
    costs nothing.  Each pass then counts the values per bucket, finds the bucket that
    holds the wanted rank and goes on inside it.  Only bucket counts reach a single task;
    Spark's own ``percentile`` merges every distinct value there.
    """
    values = (
        df.select(cents(F.col(column)).alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count("*").alias("n"))
    )
    targets = _first_buckets(values, qs)
    for previous, shift in zip(SHIFTS, SHIFTS[1:]):
        targets = _narrowed(values, targets, previous, shift)
    return _interpolated(targets, len(qs))


def _first_buckets(values: DataFrame, qs: Sequence[float]) -> DataFrame:
    """Two rows per quantile, one for each rank around it: the bucket that holds the rank
    and the rank inside the bucket."""
    everything = Window.partitionBy()
    histogram = (
        values.groupBy(F.shiftright("value", SHIFTS[0]).alias("prefix"))
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(everything.orderBy("prefix")))
        .withColumn("last", F.sum("n").over(everything) - 1)
    )
    wanted = []
    for index, q in enumerate(qs):
        position = F.lit(float(q)) * F.col("last")
        low = F.floor(position).cast("bigint")
        for side, rank in ((0, low), (1, F.least(low + 1, F.col("last")))):
            wanted.append(
                F.struct(
                    F.lit(2 * index + side).alias("target"),
                    (position - low).alias("weight"),
                    (rank - F.col("upto") + F.col("n")).alias("rank"),
                )
            )
    return (
        histogram.select("prefix", "n", F.explode(F.array(*wanted)).alias("t"))
        .filter((F.col("t.rank") >= 0) & (F.col("t.rank") < F.col("n")))
        .select("t.*", "prefix")
    )


def _narrowed(values: DataFrame, targets: DataFrame, previous: int, shift: int) -> DataFrame:
    """Each target's bucket narrowed down, its rank now counted inside the new bucket."""
    # Two rows per quantile, whatever the data: small enough to broadcast.
    # Null-safe equality, as no key is null: an inferred null filter would make Spark
    # group the values once per pass instead of reusing the first shuffle.
    held = F.shiftright("value", previous).eqNullSafe(F.col("prefix"))
    histogram = (
        values.join(F.broadcast(targets), held)
        .groupBy("target", "weight", "rank", F.shiftright("value", shift).alias("bucket"))
        .agg(F.sum("n").alias("n"))
    )
    before = F.sum("n").over(Window.partitionBy("target").orderBy("bucket")) - F.col("n")
    return (
        histogram.withColumn("rank", F.col("rank") - before)
        .filter((F.col("rank") >= 0) & (F.col("rank") < F.col("n")))
        .select("target", "weight", "rank", F.col("bucket").alias("prefix"))
    )


def _interpolated(targets: DataFrame, count: int) -> DataFrame:
    def of(target: int, column: Column) -> Column:
        return F.max(F.when(F.col("target") == target, column))

    value = dollars(F.col("prefix"))
    quantiles = []
    for index in range(count):
        low, high = of(2 * index, value), of(2 * index + 1, value)
        weight = of(2 * index, F.col("weight"))
        quantiles.append((low + (high - low) * weight).alias(f"q{index}"))
    return targets.agg(*quantiles)


def approximate_quantiles(
    df: DataFrame, column: str, qs: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """The same row from Spark's one-pass sketch: an existing value whose rank is off by
    at most ``rows / accuracy``."""
    found = F.percentile_approx(column, [float(q) for q in qs], accuracy)
    return df.agg(found.alias("found")).select(
        *[F.col("found")[index].alias(f"q{index}") for index in range(len(qs))]
    )
