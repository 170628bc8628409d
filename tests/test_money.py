"""Sums of amounts that lose nothing."""

import pytest
from pyspark.sql import functions as F

from basketry.functions.numeric import cents, dollars, money_mean, total
from basketry.operators import customers, revenue
from tests.build import by, transactions, txn


def sums(spark, *amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "x double").repartition(3)
    return df.agg(dollars(total(F.col("x"))).alias("sum"), money_mean(
        total(F.col("x")), F.count("x"), 2).alias("mean")).first()


def test_parts_of_a_cent_add_up_before_rounding(spark):
    assert sums(spark, 0.004, 0.004).sum == 0.01
    assert sums(spark, *[0.001] * 1000).sum == 1.0
    assert sums(spark, -0.004, -0.004, 5.0).sum == 4.99
    assert sums(spark, 0.005, 0.005, 0.005).mean == 0.01


def test_large_amounts_count_and_larger_ones_raise(spark):
    assert sums(spark, 1e17, 5.0, None).sum == 1e17 + 5.0
    assert sums(spark, -1e17, 1e17, 0.25).sum == 0.25
    for amount in (1e19, float("nan"), float("inf"), -1e30):
        with pytest.raises(Exception, match="amount out of range"):
            sums(spark, amount, 1.0)
    with pytest.raises(Exception, match="amount out of range"):
        spark.range(1).select(cents(F.lit(1e17))).collect()


def test_no_amounts_have_no_sum(spark):
    assert sums(spark, None).sum is None and sums(spark).sum is None


def test_reports_count_a_large_order(spark):
    orders = transactions(spark, txn(1, total=1e17), txn(2, total=5.0), txn(3, total=0.004), txn(4, total=0.004))
    (day,) = revenue.daily_revenue(orders).collect()
    assert (day.daily_orders, day.daily_revenue) == (4, 1e17 + 5.01)
    assert by(customers.clv_features(orders), "user_id")["u1"].total_spend == 1e17 + 5.01
