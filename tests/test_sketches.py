import bisect

import pytest
from pyspark.sql import functions as F

from basketry.operators import customers, sketches
from checks import registry
from tests.build import transactions, txn

LARGE = "/root/testdata/sf0.1"


def off_by(values: list[float], value: float, q: float) -> float:
    """How far the ranks of ``value`` among sorted ``values`` are from ``q``, of all values."""
    low, high = bisect.bisect_left(values, value) / len(values), bisect.bisect_right(values, value) / len(values)
    return max(0.0, low - q, q - high)


def test_few_values_are_exact_over_any_days(spark):
    rows = [txn(i, timestamp=f"2024-03-{1 + i % 9:02d}T10:00:00", total=float(i * i % 101)) for i in range(200)]
    rows += [txn(900, status="shipped", total=1e9), txn(901, total=None), txn(902, timestamp=None, total=5e9)]
    daily = sketches.daily_value_sketches(transactions(spark, *rows))
    assert daily.count() == 9
    for first, last in ((1, 9), (3, 5), (9, 9)):
        chosen = daily.filter(F.col("date").between(f"2024-03-{first:02d}", f"2024-03-{last:02d}"))
        values = sorted(r["total"] for r in rows[:200] if first <= int(r["timestamp"][8:10]) <= last)
        found = sketches.merged_quantiles(chosen, (0.0, 0.5, 1.0)).first()
        assert found["n"] == len(values) and (found["q0"], found["q2"]) == (values[0], values[-1])
        assert off_by(values, found["q1"], 0.5) <= 1 / len(values)
    assert sketches.merged_quantiles(daily.limit(0), (0.5,), ["date"]).count() == 0


@pytest.mark.parametrize("k", [1024, sketches.K])
def test_rank_error_on_the_large_tables(spark, k):
    """Daily sketches of all orders, merged, against the orders themselves."""
    orders = spark.read.parquet(f"{LARGE}/orders.parquet").select(
        F.col("o_totalprice").alias("total"), F.to_date("o_orderdate").alias("date")
    )
    values = sorted(r["total"] for r in orders.select("total").collect())
    daily = sketches.value_sketches(orders, "total", ["date"], k)
    qs = [i / 20 for i in range(1, 20)]
    found = sketches.merged_quantiles(daily, qs, k=k).first()
    worst = max(off_by(values, found[f"q{i}"], q) for i, q in enumerate(qs))
    assert found["n"] == len(values) > 100_000
    assert worst <= sketches.RANK_ERROR * sketches.K / k


def test_tiers_agree_with_exact_ones_but_near_the_edges(spark):
    entities = registry.Entities(registry.prepare(spark), "/root/testdata/sf0.01")
    clv = customers.clv_features(entities.transactions()).select("user_id", "clv").persist()
    parts = clv.withColumn("part", F.pmod("user_id", F.lit(16)))
    by_part = sketches.value_sketches(parts, "clv", ["part"])
    ours = sketches.value_tier(clv, "clv", by_part)
    both = ours.join(customers.clv_tier(clv).select("user_id", "clv_tier"), "user_id")
    n, same = both.agg(F.count("*"), F.count_if(F.col("tier") == F.col("clv_tier"))).first()
    assert n > 1000 and n - same <= 2 + 2 * sketches.RANK_ERROR * n
    clv.unpersist()
