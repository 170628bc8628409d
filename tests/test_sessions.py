from basketry.operators import sessions as funnels
from tests.build import by, dicts, frame, sessions, transactions, txn


def visit(referrer, status, seconds=None, device=None, **more):
    return {
        "referrer": referrer,
        "conversion_status": status,
        "duration_seconds": seconds,
        "device_profile": device,
    } | more


def visits(spark):
    return sessions(
        spark,
        visit("email", "converted", 10),
        visit("email", "abandoned", 21),
        visit("email", "browsed", None),
        visit("direct", "browsed", 5),
        visit("social", "converted", 7),
        visit("social", "odd", 8),
        visit(None, "converted", 1),
        visit("email", None, 2),
    )


def test_funnel_keeps_the_null_referrer_and_skips_null_durations(spark):
    rows = by(funnels.funnel_by_referrer(visits(spark)), "referrer")
    email = rows["email"]
    assert (email.total_sessions, email.converted, email.abandoned, email.browsed) == (4, 1, 1, 1)
    assert email.conversion_rate_pct == 25.0 and email.avg_session_dur_sec == 11.0
    assert rows[None].conversion_rate_pct == 100.0
    assert rows["social"].avg_session_dur_sec == 8.0  # 7.5 rounds up


def test_composition_counts_every_status_and_flags_above_median(spark):
    rows = dicts(funnels.funnel_composition(visits(spark)))
    assert [r["referrer"] for r in rows] == ["direct", "email", "social"]
    assert [r["total"] for r in rows] == [1, 3, 2]
    assert [r["above_median"] for r in rows] == [False, False, True]


def test_referrer_conversion_counts_a_missing_status_as_not_converted(spark):
    rows = by(funnels.referrer_conversion(visits(spark)), "referrer")
    assert rows["email"].conversion_pct == 25.0 and None not in rows


def linked(spark):
    mobile = ("mobile", "iOS", "Safari")
    visited = frame(
        spark,
        "sessions",
        [
            {"session_id": "s1", "device_profile": mobile},
            {"session_id": "s2", "device_profile": mobile},
            {"session_id": "s2", "device_profile": mobile},
            {"session_id": "s3", "device_profile": None},
            {"session_id": None, "device_profile": mobile},
        ],
    )
    bought = transactions(
        spark,
        txn(1, session_id="s1", total=1000.0),
        txn(2, session_id="s2", total=50.0),
        txn(3, session_id="s3", total=2149.99),
        txn(4, session_id=None, total=7.0),
        txn(5, session_id="s1", total=7.0, status="shipped"),
        txn(6, session_id="s1", total=None),
    )
    return bought, visited


def test_revenue_by_device_multiplies_by_repeated_sessions_but_not_distinct_orders(spark):
    rows = by(funnels.revenue_by_device_os(*linked(spark)), "device_type", "os")
    mobile = rows[("mobile", "iOS")]
    assert (mobile.transactions, mobile.revenue) == (3, 1100.0)
    assert mobile.avg_order_value == 366.67
    assert rows[(None, None)].transactions == 1


def test_device_matrix_fills_zero_and_names_unknown(spark):
    for values in (funnels.OPERATING_SYSTEMS, ["iOS", "unknown"]):
        rows = by(funnels.device_os_matrix(*linked(spark), values), "device_type")
        assert rows["mobile"].iOS == 1.1 and rows["mobile"].unknown == 0.0
        assert rows["unknown"].unknown == 2.1 and rows["unknown"].iOS == 0.0


def test_device_matrix_keeps_the_revenue_of_systems_without_a_column(spark):
    bought, visited = linked(spark)
    matrix = by(funnels.device_os_matrix(bought, visited, ["Windows"]), "device_type")
    whole = funnels.revenue_by_device_os(bought, visited).collect()
    for device, row in matrix.items():
        revenue = sum(r.revenue for r in whole if (r.device_type or "unknown") == device)
        held = row.Windows + row.other + row.unknown
        assert abs(held - revenue / 1000) <= 0.15
    assert matrix["mobile"].other == 1.1
