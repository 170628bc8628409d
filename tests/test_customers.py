import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import customers
from basketry.operators.clean import clean_users
from basketry.operators.quantiles import approximate_quantiles, exact_quantiles
from basketry.plans.profile import customer_profile
from tests.build import by, dicts, frame, sessions, transactions, txn


def test_cohorts_count_buyers_per_month_and_drop_unknown_users(spark):
    users = clean_users(
        frame(
            spark,
            "users",
            [
                {"user_id": "a", "registration_date": "2024-01-05T00:00:00"},
                {"user_id": "b", "registration_date": "2024-01-25T00:00:00"},
                {"user_id": "c", "registration_date": None},
            ],
        ),
        F.lit("2024-12-31").cast("date"),
    )
    df = transactions(
        spark,
        txn(1, user_id="a", total=0.01),
        txn(2, user_id="a", total=0.01),
        txn(3, user_id="b", total=0.01),
        txn(4, user_id="b", total=9.0, timestamp="2024-04-01T00:00:00"),
        txn(5, user_id="c", total=1.0),
        txn(6, user_id="ghost", total=5.0),
        txn(7, user_id="a", total=5.0, status="shipped"),
    )
    rows = by(customers.cohort_revenue(users, df), "cohort_month", "txn_month")
    assert set(rows) == {("2024-01", "2024-03"), ("2024-01", "2024-04"), (None, "2024-03")}
    march = rows[("2024-01", "2024-03")]
    assert (march.active_users, march.cohort_revenue, march.arpu) == (2, 0.03, 0.02)


def test_ltv_segments_average_rounded_user_values(spark):
    df = transactions(
        spark,
        txn(1, user_id="a", total=1000.0, timestamp="2024-03-01T23:00:00"),
        txn(2, user_id="a", total=1000.01, timestamp="2024-03-03T01:00:00"),
        txn(3, user_id="b", total=500.0),
        txn(4, user_id="c", total=500.01),
        txn(5, user_id="d", total=None),
        txn(6, user_id="e", total=0.01),
        txn(7, user_id="e", total=0.02),
    )
    rows = by(customers.ltv_segments(df), "ltv_segment")
    assert rows["High Value"].avg_lifespan_days == 2.0  # calendar days, not full days
    assert rows["High Value"].avg_order_value == 1000.01  # 1000.005 rounded up per user
    assert rows["Mid Value"].user_count == 1
    low = rows["Low Value"]
    assert low.user_count == 3 and low.avg_ltv == 250.02 and low.avg_orders == 1.3
    assert [r["ltv_segment"] for r in dicts(customers.ltv_segments(df))] == [
        "High Value",
        "Mid Value",
        "Low Value",
    ]


def test_clv_features_count_missing_amounts_as_zero(spark):
    df = transactions(
        spark,
        txn(1, total=10.0, discount=None, timestamp="2024-03-01T12:00:00"),
        txn(2, total=None, discount=2.0, timestamp="2024-03-03T11:59:59"),
        txn(3, total=5.0, timestamp=None, transaction_id=None),
        txn(4, user_id=None),
        txn(5, user_id="u2", timestamp="junk", total=-3.0),
    )
    rows = by(customers.clv_features(df), "user_id")
    one = rows["u1"]
    assert one.order_count == 2 and one.clv == 15.0 and one.avg_order_val == 5.0
    assert one.lifespan_days == 1 and one.total_discount == 2.0
    assert one.discount_rate_pct == round(200 / 17.01, 2)
    assert rows["u2"].lifespan_days == 0 and rows["u2"].clv == -3.0
    assert set(rows) == {"u1", "u2"}


@pytest.mark.parametrize("seed", range(4))
def test_exact_quantiles_agree_with_numpy(spark, seed):
    rng = random.Random(seed)
    values = [
        [7.25],
        [round(rng.uniform(-5000, 5000), 2) for _ in range(1001)],
        [12.34] * 300 + [round(rng.lognormvariate(8, 3), 2) for _ in range(500)],
        [-1e12, 1e12, 0.0, 0.01, -0.01] + [round(rng.uniform(0, 1e11), 2) for _ in range(95)],
    ][seed]
    qs = [0.0, 0.33, 0.5, 0.66, 1.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "clv double")
    found = exact_quantiles(df, "clv", qs).first()
    assert list(found) == pytest.approx(list(np.quantile(values, qs)), rel=1e-12, abs=1e-9)


def test_quantiles_of_nothing_are_null(spark):
    df = spark.createDataFrame([], "clv double")
    assert list(exact_quantiles(df, "clv", [0.5]).first()) == [None]


def test_tiers_are_closed_on_the_right_and_equal_values_stay_low(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 101)], "user_id int, clv double")
    rows = by(customers.clv_tier(df), "user_id")
    # p33 = 33.67 and p66 = 66.34
    assert (rows[33].clv_tier, rows[34].clv_tier) == ("Low", "Mid")
    assert (rows[66].clv_tier, rows[67].clv_tier) == ("Mid", "High")
    edge = spark.createDataFrame([(i, float(i)) for i in range(101)], "user_id int, clv double")
    rows = by(customers.clv_tier(edge), "user_id")
    assert rows[33].clv_tier == "Low" and rows[66].clv_tier == "Mid"
    equal = spark.createDataFrame([(i, 5.0) for i in range(9)], "user_id int, clv double")
    assert {r.clv_tier for r in customers.clv_tier(equal).collect()} == {"Low"}


def test_approximate_tiers_are_near_the_exact_ones(spark):
    df = spark.range(10_000).select("id", F.col("id").cast("double").alias("clv"))
    low, high = approximate_quantiles(df, "clv", [0.33, 0.66]).first()
    assert abs(low - 3300) <= 2 and abs(high - 6600) <= 2
    counts = by(customers.clv_tier(df, exact=False).groupBy("clv_tier").count(), "clv_tier")
    assert abs(counts["Low"]["count"] - 3300) <= 3


def test_engagement_modes_rates_and_missing_parts(spark):
    def device(kind):
        return (kind, "iOS", "Safari")

    df = sessions(
        spark,
        dict(device_profile=device("tablet"), referrer="social", conversion_status="converted",
             duration_seconds=10),
        dict(device_profile=device("mobile"), referrer="email", conversion_status="abandoned",
             duration_seconds=None),
        dict(device_profile=None, referrer=None, conversion_status="odd", duration_seconds=5),
        dict(user_id="u2", device_profile=None, referrer=None, conversion_status=None),
        dict(user_id="u2", device_profile=None, referrer=None, conversion_status=None),
        dict(user_id="u2", device_profile=device("mobile"), conversion_status=None),
    )
    rows = by(customers.engagement_features(df), "user_id")
    one, two = rows["u1"], rows["u2"]
    assert one.preferred_device == "mobile" and one.primary_referrer == "email"
    assert (one.total_sessions, one.avg_session_dur, one.total_session_dur) == (3, 5.0, 15)
    assert one.user_conversion_rate == round(100 / 2.001, 2)
    assert two.preferred_device == "unknown" and two.primary_referrer is None
    assert two.user_conversion_rate is None and two.converted is None


def profile_inputs(spark):
    users = clean_users(
        frame(
            spark,
            "users",
            [
                {"user_id": f"u{i}", "registration_date": "2024-01-01T00:00:00"}
                for i in range(1, 6)
            ],
        ),
        F.lit("2024-12-31").cast("date"),
    )
    df = transactions(
        spark,
        *[txn(i, user_id=f"u{i}", total=100.0 * i) for i in range(1, 5)],
        txn(9, user_id="ghost", total=100.0),
    )
    visits = sessions(
        spark,
        dict(user_id="u1", referrer="email", conversion_status="converted", duration_seconds=7),
        dict(user_id="u5", referrer="email", conversion_status="converted", duration_seconds=7),
    )
    return df, visits, users


def test_profile_has_every_buyer_once_with_defaults(spark):
    rows = by(customer_profile(*profile_inputs(spark)), "user_id")
    assert set(rows) == {"u1", "u2", "u3", "u4", "ghost"}
    assert rows["u1"].total_sessions == 1 and rows["u1"].country == "Unknown"
    assert rows["u2"].total_sessions == 0 and rows["u2"].preferred_device == "unknown"
    assert rows["u2"].converted is None and rows["ghost"].country is None
    assert rows["u1"].registration_date == dt.datetime(2024, 1, 1)


def test_reports_on_the_profile(spark):
    profile = customer_profile(*profile_inputs(spark)).cache()
    summary = dicts(customers.clv_segment_summary(profile))
    assert [r["clv_tier"] for r in summary] == ["Low", "Mid", "High"]
    assert sum(r["user_count"] for r in summary) == 5
    behaviour = by(customers.clv_segment_behaviour(profile), "clv_tier")
    assert {t: r.user_count for t, r in behaviour.items()} == {
        r["clv_tier"]: r["user_count"] for r in summary
    }
    top = dicts(customers.top_clv_users(profile, n=4))
    assert [r["user_id"] for r in top] == ["u4", "u3", "u2", "ghost"]  # ghost and u1 tie
    referrers = by(customers.referrer_revenue(profile), "primary_referrer")
    assert referrers["unknown"].total_rev == 1000.0 and referrers["email"].user_count == 1
    profile.unpersist()


def test_fixed_segments_skip_users_without_sessions_in_the_session_mean(spark):
    df, visits, _ = profile_inputs(spark)
    rows = by(customers.clv_segments_fixed(df, visits, mid=150, high=350), "clv_tier")
    assert rows["High"].users == 1 and rows["High"].avg_sessions is None
    assert rows["Low"].users == 2 and rows["Low"].avg_sessions == 1.0
