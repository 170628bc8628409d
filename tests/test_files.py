import json

import pytest

from basketry.operators import clean, keyed
from basketry.sources import files
from tests.build import dicts, sessions


def visit(number):
    return {
        "session_id": f"s{number}",
        "user_id": "u1",
        "start_time": "2024-03-01T10:00:00",
        "duration_seconds": 5,
        "geo_data": {"city": "Oslo", "country": "NO"},
        "page_views": [{"timestamp": "2024-03-01T10:00:00", "page_type": "home"}],
        "cart_contents": {f"p{number}": {"quantity": 1, "price": 2}},
        "conversion_status": "browsed",
    }


def test_session_chunks_are_one_table_whatever_their_layout(spark, tmp_path):
    (tmp_path / "sessions_0.json").write_text(json.dumps([visit(0), visit(1)]))
    (tmp_path / "sessions_1.json").write_text("\n".join(json.dumps(visit(i)) for i in (2, 3)))
    (tmp_path / "sessions_2 b.json").write_text("\n " + json.dumps([visit(4), visit(5)], indent=2))
    (tmp_path / "sessions_3.json").write_text("")
    loaded = clean.clean_sessions(files.load_sessions(spark, f"{tmp_path}/sessions_*.json"))
    rows = {r["session_id"]: r for r in dicts(loaded)}
    assert set(rows) == {f"s{i}" for i in range(6)}
    assert rows["s2"]["cart_contents"] == {"p2": {"quantity": 1, "price": 2.0}}
    assert rows["s0"]["referrer"] is None and rows["s0"]["geo_data"]["state"] is None
    assert rows["s5"]["duration_seconds"] == 5
    paths = [str(tmp_path / "sessions_0.json"), str(tmp_path / "sessions_1.json")]
    assert files.load_sessions(spark, paths).count() == 4


def test_an_indented_array_is_read_whole(spark, tmp_path):
    categories = [
        {
            "category_id": "c1",
            "name": "One",
            "subcategories": [{"subcategory_id": "s", "name": "S", "profit_margin": 0.1}],
        },
        {"category_id": "c2", "name": "Two", "subcategories": []},
    ]
    path = tmp_path / "categories.json"
    path.write_text(json.dumps(categories, indent=2))
    assert dicts(clean.clean_categories(files.read_entity(spark, "categories", str(path)))) == categories


def test_amounts_as_text_count_and_junk_is_null(spark, tmp_path):
    path = tmp_path / "transactions.json"
    item = {"product_id": "p", "quantity": "2", "unit_price": "1.50", "subtotal": 3}
    path.write_text(
        json.dumps([{"transaction_id": "a", "discount": 0, "total": 5.5, "items": [item]},
                    {"transaction_id": "b", "discount": "1.5", "total": "12.50", "items": None},
                    {"transaction_id": "c", "discount": None, "total": "junk"}])
    )
    raw = files.read_entity(spark, "transactions", str(path))
    rows = {r["transaction_id"]: r for r in dicts(clean.clean_transactions(raw))}
    assert (rows["a"]["discount"], rows["a"]["total"]) == (0.0, 5.5)
    assert (rows["b"]["discount"], rows["b"]["total"]) == (1.5, 12.5)
    assert (rows["c"]["discount"], rows["c"]["total"]) == (0.0, None)
    assert rows["a"]["items"] == [{"product_id": "p", "quantity": 2, "unit_price": 1.5, "subtotal": 3.0}]


@pytest.mark.parametrize("cut", ['{"category_id": "c1", "na', '{"category_id": "c1"}\n{"cat', '[{"category_id": "c1"'])
def test_a_truncated_record_fails(spark, tmp_path, cut):
    path = tmp_path / "categories.json"
    path.write_text(cut)
    with pytest.raises(Exception, match="(?i)malformed|corrupt"):
        files.read_entity(spark, "categories", str(path)).collect()


def test_products_as_text(spark, tmp_path):
    path = tmp_path / "products.json"
    path.write_text(json.dumps([
        {"product_id": "a", "base_price": "9.99", "current_stock": "3", "is_active": "true",
         "price_history": [{"price": "1", "date": "d"}, {"price": 2, "date": "d"}]},
        {"product_id": "b", "base_price": 1, "current_stock": None, "is_active": False},
    ]))
    rows = {r["product_id"]: r for r in dicts(clean.clean_products(files.read_entity(spark, "products", str(path))))}
    assert (rows["a"]["base_price"], rows["a"]["current_stock"], rows["a"]["is_active"]) == (9.99, 3, True)
    assert rows["a"]["is_price_volatile"] and rows["a"]["price_history"][1]["price"] == 2.0
    assert (rows["b"]["current_stock"], rows["b"]["is_active"], rows["b"]["price_history_len"]) == (0, False, 0)


def test_optional_table(spark, tmp_path):
    path = str(tmp_path / "maybe")
    assert files.read_optional(spark, path) is None
    files.to_parquet(spark.range(2), path)
    files.to_parquet(spark.range(3), path)
    assert files.read_optional(spark, path).count() == 3


def test_json_records_have_iso_dates(spark, tmp_path):
    df = spark.sql("SELECT DATE'2024-03-01' AS day, TIMESTAMP'2024-03-01 10:00:00' AS at")
    files.to_json_records(df, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("*.json")
    assert json.loads(part.read_text()) == {"day": "2024-03-01", "at": "2024-03-01T10:00:00.000Z"}


def test_keyed_table_pushes_key_filters_down(spark, tmp_path):
    rows = keyed.user_session_rows(
        sessions(spark, *[dict(user_id=f"u{i % 7}", start_time=f"2024-03-01T10:{i:02d}:00") for i in range(50)])
    )
    path = str(tmp_path / "keyed")
    files.to_keyed_parquet(rows, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 50
    scan = keyed.key_range_scan(stored, start="u3#", stop="u3#~")
    assert scan.count() == 7
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,u3#)" in plan and "LessThan(row_key,u3#~)" in plan
