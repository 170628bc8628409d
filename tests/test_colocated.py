import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.sources.colocated import CHILDREN, PARENTS, Colocated
from basketry.sources.shared import unique_name
from checks.registry import Entities

TESTDATA = "/root/testdata/sf0.001"
ORDERS, LINES = "order bigint, user string, status string", "order bigint, product string, amount int"


def made(spark, tmp_path, orders, lines, heavy=50, buckets=4):
    store = Colocated(spark, str(tmp_path), unique_name("t"), "order", buckets)
    store.create(spark.createDataFrame(orders, ORDERS), spark.createDataFrame(lines, LINES), heavy)
    return store


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture()
def rows():
    pick = random.Random(5)
    orders = [(i, f"u{i % 7}", pick.choice(["completed", "open"])) for i in range(200)] + [(None, "u0", "open")]
    # Order 3 has a third of all lines; some lines have no order, some orders no lines.
    lines = [(3 if n % 3 == 0 else pick.randrange(40, 230), f"p{pick.randrange(9)}", n) for n in range(900)]
    return orders, lines + [(None, "p1", n) for n in range(60)]


def test_join_equals_plain_python_with_a_heavy_key(spark, tmp_path, rows):
    orders, lines = rows
    store = made(spark, tmp_path, orders, lines)
    status = {o: (u, s) for o, u, s in orders if o is not None}
    expected = Counter((o, p, a, *status[o]) for o, p, a in lines if o in status)
    found = store.joined(["user", "status"], ["product", "amount"])
    assert Counter(map(tuple, found.collect())) == expected
    done = store.joined(["user"], ["amount"], F.col("status") == "completed")
    assert Counter(r["order"] for r in done.collect()) == Counter(
        o for o, p, a in lines if o in status and status[o][1] == "completed"
    )
    assert Counter(map(tuple, store.read(PARENTS).collect())) == Counter(orders)
    assert Counter(map(tuple, store.read(CHILDREN).collect())) == Counter(lines)


def test_heavy_and_keyless_rows_are_in_no_bucket(spark, tmp_path, rows):
    store = made(spark, tmp_path, *rows)
    light, heavy = store._parts(CHILDREN)
    assert {r["order"] for r in heavy.select("order").distinct().collect()} == {3, None}
    assert light.filter("order = 3 or order is null").count() == 0
    assert len(list((tmp_path / CHILDREN / "light").glob("*.parquet"))) <= 4


def test_sums_by_key(spark, tmp_path, rows):
    store = made(spark, tmp_path, *rows)
    expected = Counter()
    for o, _, a in rows[1]:
        expected[o] += a
    found = store.per_key(F.sum("amount").alias("amount")).collect()
    assert {r["order"]: r["amount"] for r in found} == expected and len(found) == len(expected)


def test_buckets_join_and_add_without_a_shuffle(spark, tmp_path, rows, no_broadcast):
    store = made(spark, tmp_path, *rows)
    light = spark.table(f"{store.name}_{CHILDREN}")
    joined = light.join(spark.table(f"{store.name}_{PARENTS}"), "order")
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert "Exchange" not in plan(light.groupBy("order").agg(F.sum("amount")))
    # Of the whole join only the heavy part is shuffled: two sides.
    assert plan(store.joined(["user"], ["amount"])).count("Exchange hashpartitioning") == 2


def test_reports_read_the_stored_lines_once(spark, tmp_path, no_broadcast):
    e = Entities(spark, TESTDATA)
    store = Colocated(spark, str(tmp_path), unique_name("t"), "transaction_id", 4)
    store.create(e.transactions().select("transaction_id", "status", "discount"), e.items())
    found = store.joined(["status", "discount"], ["product_id", "subtotal"], F.col("status") == "completed")
    text = plan(found)
    assert text.count("FileScan parquet spark_catalog") == 2  # lines and orders
    assert "EqualTo(status,completed)" in text
    assert "unit_price" not in text


def test_registering_again_keeps_the_buckets(spark, tmp_path, rows, no_broadcast):
    store = made(spark, tmp_path, *rows)
    again = Colocated(spark, str(tmp_path), unique_name("t"), "order", 4)
    again.register(store.read(PARENTS).schema, store.read(CHILDREN).schema)
    joined = spark.table(f"{again.name}_{CHILDREN}").join(spark.table(f"{again.name}_{PARENTS}"), "order")
    assert "Exchange" not in plan(joined)
    columns = ["user"], ["product", "amount"]
    assert Counter(again.joined(*columns).collect()) == Counter(store.joined(*columns).collect())


def test_empty_tables_and_unlike_keys(spark, tmp_path):
    store = made(spark, tmp_path / "a", [], [])
    assert store.joined(["user"], ["amount"]).collect() == []
    other = Colocated(spark, str(tmp_path / "b"), unique_name("t"), "order", 4)
    lines = spark.createDataFrame([("1", 1)], "order string, amount int")
    with pytest.raises(ValueError, match="order is"):
        other.create(spark.createDataFrame([(1,)], "order bigint"), lines)
