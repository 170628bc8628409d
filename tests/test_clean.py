import datetime as dt

from pyspark.sql import functions as F

from basketry.operators import clean
from tests.build import by, dicts, frame, transactions, txn


def test_transactions_are_typed_and_flagged_but_kept(spark):
    rows = by(
        transactions(
            spark,
            txn(1, status="  Completed ", discount=None, timestamp="2024-03-01T10:00:00"),
            txn(2, total=0.0, timestamp="2024-03-01T10:00:00.250"),
            txn(3, total=-5.0, timestamp="not a time"),
            txn(4, total=None, status=None),
        ),
        "transaction_id",
    )
    assert len(rows) == 4
    assert rows["t1"].status == "completed" and rows["t1"].discount == 0.0
    assert rows["t1"].date == dt.date(2024, 3, 1) and rows["t1"].year_month == "2024-03"
    assert rows["t2"].timestamp.microsecond == 250_000
    assert rows["t3"].timestamp is None and rows["t3"].date is None
    assert [rows[f"t{i}"].is_suspicious for i in (1, 2, 3, 4)] == [False, True, True, False]


def test_text_amounts_that_are_junk_become_null(spark):
    raw = spark.createDataFrame(
        [("t1", None, "2024-03-01", "junk", "abc", "1.5", "completed")],
        "transaction_id string, session_id string, timestamp string, total string, "
        "discount string, subtotal string, status string",
    )
    row = clean.clean_transactions(raw).first()
    assert row.total is None and row.discount is None and row.subtotal == 1.5
    assert row.is_suspicious is False


def test_users_get_country_month_and_tenure(spark):
    users = frame(
        spark,
        "users",
        [
            {"user_id": "a", "geo_data": ("x", "y", "FR"), "registration_date": "2024-01-31T23:00:00"},
            {"user_id": "b", "geo_data": ("x", "y", None), "registration_date": "bad"},
            {"user_id": "c", "registration_date": "2024-02-01T00:00:00.5"},
        ],
    )
    rows = by(clean.clean_users(users, F.lit("2024-02-10").cast("date")), "user_id")
    assert [rows[u].country for u in "abc"] == ["FR", "Unknown", "Unknown"]
    assert [rows[u].reg_year_month for u in "abc"] == ["2024-01", None, "2024-02"]
    assert [rows[u].tenure_days for u in "abc"] == [10, None, 9]


def test_products_stock_activity_and_price_history(spark):
    one, two = [(1.0, "d")], [(1.0, "d"), (2.0, "e")]
    products = frame(
        spark,
        "products",
        [
            {"product_id": "a", "price_history": None, "current_stock": None},
            {"product_id": "b", "price_history": [], "current_stock": 3, "is_active": True},
            {"product_id": "c", "price_history": one},
            {"product_id": "d", "price_history": two},
        ],
    )
    rows = by(clean.clean_products(products), "product_id")
    assert [rows[p].price_history_len for p in "abcd"] == [0, 0, 1, 2]
    assert [rows[p].is_price_volatile for p in "abcd"] == [False, False, False, True]
    assert rows["a"].current_stock == 0 and rows["b"].current_stock == 3
    text = products.withColumn("is_active", F.lit("false"))
    assert clean.clean_products(text).first().is_active is False


def test_enrichment_keeps_every_product_once(spark):
    products = frame(
        spark,
        "products",
        [
            {"product_id": "a", "category_id": "c1", "subcategory_id": "s1"},
            {"product_id": "b", "category_id": "c9", "subcategory_id": "s9"},
            {"product_id": "c"},
        ],
    )
    categories = frame(
        spark,
        "categories",
        [
            {"category_id": "c1", "name": "One", "subcategories": [("s1", "Sub", 0.1)]},
            {"category_id": "c2", "name": "Two", "subcategories": [("s1", "Sub", 0.1)]},
            {"category_id": "c1", "name": "One", "subcategories": None},
        ],
    )
    named = by(clean.enrich_products(products, categories), "product_id")
    assert [(named[p].category_name, named[p].subcategory_name) for p in "abc"] == [
        ("One", "Sub"),
        ("Unknown", "Unknown"),
        ("Unknown", "Unknown"),
    ]
    unnamed = by(clean.enrich_products(products, categories, missing=None), "product_id")
    assert unnamed["b"].category_name is None


def test_quality_profile_counts_once_and_survives_no_rows(spark):
    df = transactions(
        spark, txn(1), txn(2, session_id="s"), txn(3, total=-1.0), txn(4, total=None)
    )
    assert dicts(clean.transaction_quality_profile(df)) == [
        {"total_transactions": 4, "standalone": 3, "suspicious": 1, "standalone_pct": 75.0}
    ]
    empty = clean.transaction_quality_profile(df.filter("false")).first()
    assert empty.total_transactions == 0 and empty.standalone_pct is None
