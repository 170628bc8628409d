"""The batch from raw JSON to reports, on a small shop made up from a seed."""

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from basketry.plans import reports

# Columns of the published report files.
COLUMNS = {
    "daily_revenue": "date daily_orders daily_revenue rolling_7d_avg daily_discount",
    "cohort_analysis": "cohort_month txn_month active_users cohort_revenue arpu",
    "funnel_by_referrer": "referrer total_sessions converted abandoned browsed "
    "conversion_rate_pct avg_session_dur_sec",
    "ltv_segments": "ltv_segment user_count avg_ltv avg_orders avg_order_value avg_lifespan_days",
    "clv_segment_summary": "clv_tier user_count avg_clv avg_order_count avg_sessions "
    "avg_session_dur_sec avg_conversion_rate avg_discount_rate_pct",
    "referrer_revenue": "primary_referrer user_count total_rev avg_clv avg_conv_rate",
    "product_popularity": "product_id product_name category_name total_units total_revenue "
    "order_count avg_unit_price",
    "revenue_by_category": "category gross_revenue total_orders total_units_sold total_discount "
    "unique_products discount_pct",
}


def shop(seed=3):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)

    def moment():
        return (start + timedelta(seconds=rng.randrange(90 * 86400))).isoformat()

    categories = [
        {"category_id": f"c{i}", "name": f"Category {i}",
         "subcategories": [{"subcategory_id": f"c{i}s", "name": "Sub", "profit_margin": 0.2}]}
        for i in range(4)
    ]
    products = [
        {"product_id": f"p{i}", "name": f"Product {i}", "category_id": f"c{i % 4}",
         "subcategory_id": f"c{i % 4}s", "base_price": 5 + i, "current_stock": i,
         "is_active": True, "price_history": [{"price": 5 + i, "date": "2024-01-01"}]}
        for i in range(12)
    ]
    users = [
        {"user_id": f"u{i}", "registration_date": moment(), "last_active": moment(),
         "geo_data": {"city": "x", "state": "y", "country": "NO"}}
        for i in range(25)
    ]
    sessions = [
        {"session_id": f"s{i}", "user_id": f"u{rng.randrange(25)}", "start_time": moment(),
         "duration_seconds": rng.randrange(3600),
         "device_profile": {"type": rng.choice(["mobile", "desktop"]), "os": "iOS", "browser": "x"},
         "page_views": [{"timestamp": moment(), "page_type": "product_detail",
                         "product_id": f"p{rng.randrange(12)}", "view_duration": 9}],
         "cart_contents": {f"p{rng.randrange(12)}": {"quantity": 2, "price": 3.5}},
         "conversion_status": rng.choice(["converted", "abandoned", "browsed"]),
         "referrer": rng.choice(["email", "direct"])}
        for i in range(120)
    ]
    transactions = []
    for i in range(200):
        items = []
        for product in rng.sample(products, rng.randint(1, 4)):
            quantity = rng.randint(1, 3)
            items.append(
                {"product_id": product["product_id"], "quantity": quantity,
                 "unit_price": product["base_price"], "subtotal": quantity * product["base_price"]}
            )
        subtotal = sum(item["subtotal"] for item in items)
        discount = round(subtotal * rng.choice([0, 0.05, 0.15]), 2)
        transactions.append(
            {"transaction_id": f"t{i}", "user_id": f"u{rng.randrange(25)}", "timestamp": moment(),
             "session_id": f"s{rng.randrange(120)}" if i % 2 else None, "items": items,
             "subtotal": subtotal, "discount": discount, "total": round(subtotal - discount, 2),
             "status": rng.choice(["completed", "Completed ", "shipped"])}
        )
    return dict(users=users, categories=categories, products=products,
                transactions=transactions), sessions


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    source, target = tmp_path_factory.mktemp("shop"), tmp_path_factory.mktemp("out")
    entities, sessions = shop()
    for name, records in entities.items():
        (source / f"{name}.json").write_text(json.dumps(records))
    for chunk in range(3):
        (source / f"sessions_{chunk}.json").write_text(json.dumps(sessions[chunk::3]))
    names = reports.run(spark, str(source), str(target), F.lit("2024-06-01").cast("date"))
    found = {
        name: [
            json.loads(line)
            for part in sorted((target / "reports" / name).glob("*.json"))
            for line in part.read_text().splitlines()
        ]
        for name in names
    }
    return entities, sessions, found, target


def completed(entities):
    return [t for t in entities["transactions"] if t["status"].strip().lower() == "completed"]


def total(rows, column):
    return round(sum(row[column] for row in rows), 2)


def test_reports_have_the_published_columns(outputs):
    found = outputs[2]
    for name, columns in COLUMNS.items():
        assert set().union(*found[name]) == set(columns.split()), name


def test_revenue_adds_up_in_every_report(outputs):
    entities, _, found, _ = outputs
    revenue = total(completed(entities), "total")
    assert total(found["daily_revenue"], "daily_revenue") == revenue
    assert total(found["cohort_analysis"], "cohort_revenue") == revenue
    assert total(found["referrer_revenue"], "total_rev") == revenue
    assert found["kpi_summary"][0]["total_revenue"] == revenue
    discount = total(found["daily_revenue"], "daily_discount")
    gross = total(found["revenue_by_category"], "gross_revenue")
    assert round(gross - discount, 2) == revenue
    assert total(found["category_revenue"], "total_discount") == pytest.approx(discount, abs=1e-6)
    assert total(found["revenue_by_category"], "total_discount") >= discount


def test_users_and_sessions_add_up(outputs):
    entities, sessions, found, _ = outputs
    buyers = len({t["user_id"] for t in completed(entities)})
    for name in ("ltv_segments", "clv_segment_summary", "referrer_revenue"):
        assert total(found[name], "user_count") == buyers
    assert total(found["funnel_by_referrer"], "total_sessions") == len(sessions)
    for row in found["funnel_by_referrer"]:
        assert row["converted"] + row["abandoned"] + row["browsed"] == row["total_sessions"]


def test_popularity_against_a_plain_count(outputs):
    entities, _, found, _ = outputs
    revenue = defaultdict(float)
    for txn in completed(entities):
        for item in txn["items"]:
            revenue[item["product_id"]] += item["subtotal"]
    expected = sorted(revenue.items(), key=lambda pair: (-pair[1], pair[0]))
    ranked = [(r["product_id"], r["total_revenue"]) for r in found["product_popularity"]]
    assert ranked == expected


def test_keyed_tables_are_counted(outputs):
    _, sessions, found, _ = outputs
    counts = {r["table_name"]: r["row_count"] for r in found["row_counts"]}
    keys = {(s["user_id"], s["start_time"]) for s in sessions}
    assert counts["user_sessions"] == len(keys) and counts["page_events"] == len(sessions)


def test_status_filter_reaches_the_written_table(spark, outputs):
    table = spark.read.parquet(str(outputs[3] / "tables" / "transactions"))
    plan = reports.reports({"transactions": table, "products": table.withColumn(
        "category_name", F.lit("x"))})["daily_revenue"]()._jdf.queryExecution().executedPlan()
    assert "EqualTo(status,completed)" in plan.toString()
