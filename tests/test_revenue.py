import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.operators import revenue, summary
from basketry.operators.baskets import product_purchase_counts
from basketry.session import SETTINGS, prepare
from tests.build import by, dicts, frame, item, sessions, transactions, txn


def catalog(spark, *rows):
    return spark.createDataFrame(rows, "product_id string, name string, category_name string")


def test_rolling_mean_counts_day_rows_not_calendar_days(spark):
    days = [1, 2, 3, 4, 5, 6, 7, 30]
    df = transactions(
        spark,
        *[txn(d, timestamp=f"2024-03-{d:02d}T00:00:00", total=float(d)) for d in days],
        txn(100, timestamp="2024-03-30T23:59:59", total=None, discount=2.5),
        txn(101, timestamp="junk", total=99.0),
        txn(102, status="shipped", total=99.0),
    )
    rows = by(revenue.daily_revenue(df), "date")
    assert len(rows) == 8
    last = rows[dt.date(2024, 3, 30)]
    assert last.daily_orders == 2 and last.daily_revenue == 30.0 and last.daily_discount == 2.5
    assert last.rolling_7d_avg == round((2 + 3 + 4 + 5 + 6 + 7 + 30) / 7, 2)
    assert rows[dt.date(2024, 3, 2)].rolling_7d_avg == 1.5
    series = by(revenue.daily_revenue_series(df), "date")
    assert series[dt.date(2024, 3, 30)].rolling7 == pytest.approx(57 / 7, abs=1e-12)


def test_half_cents_round_up_exactly(spark):
    df = transactions(spark, txn(1, total=0.01), txn(2, timestamp="2024-03-02", total=0.02))
    rows = by(revenue.daily_revenue(df), "date")
    assert rows[dt.date(2024, 3, 2)].rolling_7d_avg == 0.02  # 0.015


def baskets(spark):
    return transactions(
        spark,
        txn(1, discount=3.0, items=[item("a", 2, 5.0), item("b", 1, 1.0), item("a", 1, 6.0)]),
        txn(2, discount=1.0, items=[item("z", 1, 7.0)]),
        txn(3, discount=9.0, items=None),
        txn(4, discount=9.0, items=[]),
        txn(5, status="shipped", items=[item("a", 50, 5.0)]),
    )


def test_order_lines_drop_empty_baskets_and_count_lines(spark):
    lines = revenue.order_lines(baskets(spark)).filter("status = 'completed'").collect()
    assert sorted((r.transaction_id, r.product_id, r.n_lines) for r in lines) == [
        ("t1", "a", 3),
        ("t1", "a", 3),
        ("t1", "b", 3),
        ("t2", "z", 1),
    ]


def test_popularity_counts_lines_and_names_unknown_products(spark):
    products = catalog(spark, ("a", "Apple", "Fruit"), ("b", None, None))
    lines = revenue.order_lines(baskets(spark))
    assert dicts(revenue.product_popularity(lines, products)) == [
        dict(product_id="a", product_name="Apple", category_name="Fruit", total_units=3,
             total_revenue=16.0, order_count=2, avg_unit_price=5.5),
        dict(product_id="z", product_name="Unknown", category_name="Unknown", total_units=1,
             total_revenue=7.0, order_count=1, avg_unit_price=7.0),
        dict(product_id="b", product_name="Unknown", category_name="Unknown", total_units=1,
             total_revenue=1.0, order_count=1, avg_unit_price=1.0),
    ]
    assert len(dicts(revenue.product_popularity(lines, products, n=2))) == 2


def test_discount_per_line_counts_a_basket_several_times(spark):
    products = catalog(spark, ("a", "Apple", "Fruit"), ("b", "Bread", "Fruit"))
    rows = by(
        revenue.revenue_by_category(revenue.order_lines(baskets(spark)), products), "category"
    )
    fruit = rows["Fruit"]
    assert fruit.gross_revenue == 17.0 and fruit.total_discount == 9.0
    assert fruit.total_orders == 3 and fruit.unique_products == 2 and fruit.total_units_sold == 4
    assert fruit.discount_pct == round(9 / 17.01 * 100, 2)
    assert rows[None].gross_revenue == 7.0 and rows[None].unique_products == 1


def test_allocated_discount_is_split_and_missing_categories_left_out(spark):
    products = catalog(
        spark, ("a", "Apple", "Fruit"), ("b", "Bread", "Bakery"), ("z", "Zip", None)
    )
    lines = revenue.order_lines(baskets(spark))
    rows = by(revenue.category_revenue_allocated(lines, products), "category_name")
    assert set(rows) == {"Fruit", "Bakery"}
    assert rows["Fruit"].total_discount == pytest.approx(2.0, abs=1e-9)
    assert rows["Bakery"].net_revenue == pytest.approx(0.0, abs=1e-9)
    assert rows["Fruit"].discount_rate == pytest.approx(100 * 2 / 16.01, abs=1e-9)
    # All of a basket's discount is allocated when all its products have a category.
    assert sum(r.total_discount for r in rows.values()) == pytest.approx(3.0, abs=1e-9)


def test_product_sales_daily_counts_distinct_orders(spark):
    rows = by(
        revenue.product_sales_daily(revenue.order_lines(baskets(spark))), "product_id", "day"
    )
    a = rows[("a", "20240301")]
    assert (a.units_sold, a.revenue, a.order_count) == (3, 16.0, 1)
    assert len(rows) == 3


def test_kpis_in_one_row(spark):
    products = catalog(spark, ("a", "Apple", "Fruit"), ("b", "Bread", "Bakery"))
    visits = sessions(
        spark,
        {"referrer": "email", "conversion_status": "converted"},
        {"referrer": "email", "conversion_status": None},
        {"referrer": "direct", "conversion_status": "browsed"},
    )
    df = baskets(spark)
    assert dicts(
        summary.kpi_summary(df, visits, revenue.order_lines(df), products, digits=2)
    ) == [
        {
            "total_revenue": 40.0,
            "avg_order_value": 10.0,
            "best_referrer": "email",
            "best_conversion_pct": 50.0,
            "top_category": "Fruit",
        }
    ]


def test_empty_input_gives_empty_reports(spark):
    df = transactions(spark, txn(1)).filter("false")
    lines = revenue.order_lines(df)
    products = catalog(spark, ("a", "Apple", "Fruit"))
    for report in (
        revenue.daily_revenue(df),
        revenue.product_popularity(lines, products),
        revenue.revenue_by_category(lines, products),
        revenue.category_revenue_allocated(lines, products),
        revenue.product_sales_daily(lines),
    ):
        assert report.collect() == []
    visits = frame(spark, "sessions", [])
    kpis = summary.kpi_summary(df, visits, lines, products).first()
    assert kpis.total_revenue is None and kpis.best_referrer is None


def test_nested_scan_reads_one_item_field_and_pushes_the_status(spark, tmp_path):
    path = str(tmp_path / "transactions")
    baskets(spark).write.parquet(path)
    lines = revenue.order_lines(spark.read.parquet(path))
    plan = product_purchase_counts(lines)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,completed)" in plan
    assert "ReadSchema: struct<items:array<struct<product_id:string>>,status:string>" in plan


def test_sales_of_many_lines_are_summed_in_small_tasks(spark):
    """A task's sorts and maps grow with the shuffled rows it is given, so it is given few."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    settings = {
        size: "64MB", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {name: spark.conf.get(name) for name in (*SETTINGS, *settings)}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        prepare(spark)
        n = 1_500_000
        orders = spark.range(n // 3).select(
            F.col("id").alias("transaction_id"),
            F.lit("completed").alias("status"),
            F.date_add(F.lit("2024-01-01"), (F.col("id") % 900).cast("int")).alias("date"),
        )
        lines = spark.range(n).select(
            (F.xxhash64("id") % (n // 6) + n // 6).alias("transaction_id"),
            F.xxhash64("id", F.lit(1)).alias("product_id"),
            F.lit(2).alias("quantity"),
            F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1_000_000)).cast("double").alias("subtotal"),
        )
        sales = revenue.product_sales_daily(lines.join(orders, "transaction_id"))
        tasks = sales.rdd.getNumPartitions()
        counted = sales.agg(F.count("*"), F.sum("units_sold"), F.sum("order_count")).first()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert tasks > 1
    inside = lines.filter((F.col("transaction_id") >= 0) & (F.col("transaction_id") < n // 3)).count()
    assert tuple(counted) == (inside, 2 * inside, inside)
