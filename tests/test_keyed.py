import datetime as dt
import json

from pyspark.sql import functions as F

from basketry.functions.keys import MAX_LONG
from basketry.operators import keyed, revenue
from basketry.sources import files
from tests.build import by, dicts, frame, item, sessions, transactions, txn

START = "2024-03-01T10:00:00"
START_MS = 1_709_287_200_000


def test_session_rows_flatten_with_defaults(spark):
    df = sessions(
        spark,
        dict(start_time=START, end_time="2024-03-01T10:05:00", duration_seconds=300,
             geo_data=("Oslo", None, "NO", "10.0.0.1"), device_profile=("mobile", "iOS", None),
             cart_contents={"p2": (2, 10.0), "p1": (1, 0.995), "p3": (None, 4.0)},
             conversion_status="converted", referrer="email"),
        dict(user_id="u2", start_time="2024-03-01T10:00:00.25"),
    )
    rows = by(keyed.user_session_rows(df), "user_id")
    one, two = rows["u1"], rows["u2"]
    assert one.row_key == f"u1#{MAX_LONG - START_MS}"
    assert two.row_key == f"u2#{MAX_LONG - START_MS - 250}"
    assert one.meta.start_time == START and one.meta.browser == ""
    assert one.geo.asDict() == dict(city="Oslo", state="", country="NO", ip_address="10.0.0.1")
    assert json.loads(one.cart.product_ids) == ["p1", "p2", "p3"]
    assert one.cart.total_value == 21.0  # prices count in whole cents
    assert two.meta.duration_seconds == 0 and two.meta.referrer == "" and two.geo.city == ""
    assert two.cart.asDict() == dict(product_ids="[]", total_value=0.0)


def test_same_user_and_start_keep_the_last_write(spark):
    df = sessions(
        spark,
        dict(start_time=START, referrer="email"),
        dict(start_time=START, referrer="social"),
    )
    assert len(dicts(keyed.user_session_rows(df))) == 2
    rows = dicts(keyed.user_session_rows(df, seq="session_id"))
    assert [r["meta"]["referrer"] for r in rows] == ["social"]


def test_first_sessions_have_an_explicit_order(spark):
    times = ["2024-03-02T00:00:00", "2024-03-01T00:00:00", "2024-03-03T00:00:00"]
    df = sessions(spark, *[dict(user_id=f"u{i}", start_time=t) for i, t in enumerate(times)])
    rows = dicts(keyed.user_session_rows(df, max_sessions=2))
    assert sorted(r["user_id"] for r in rows) == ["u0", "u1"]


def views(spark):
    def view(time, product="p1", seconds=10, page="product_detail"):
        return (time, page, product, None, seconds)

    df = sessions(
        spark,
        dict(page_views=[view(START, seconds=5), view("2024-03-01T11:00:00.5", seconds=None),
                         view("junk"), view(START, product=""), view(START, product=None),
                         view(START, page="cart")]),
        dict(user_id="u2", page_views=[view(START, seconds=6), view("2024-03-02T00:00:00")]),
        dict(user_id="u3", page_views=None),
    )
    return keyed.page_views(df)


def test_product_performance_skips_unreadable_views(spark):
    rows = by(keyed.product_performance_daily(views(spark)), "row_key")
    assert set(rows) == {"p1#20240301", "p1#20240302"}
    first = rows["p1#20240301"]
    assert (first.views, first.unique_users, first.avg_dur_sec) == (3, 2, 3.7)


def test_page_events_number_the_views_of_a_session(spark):
    rows = by(keyed.page_events(views(spark)), "row_key")
    assert len(rows) == 8
    assert rows["u1#s0#" + "5".zfill(19)].ev.page_type == "cart"
    assert rows["u2#s1#" + "1".zfill(19)].ev.timestamp == dt.datetime(2024, 3, 2)


def test_range_excludes_its_end(spark):
    daily = keyed.product_performance_daily(views(spark))
    only = dicts(keyed.product_performance_range(daily, "p1", "20240301", "20240302"))
    assert [(r["day"], r["total_views"]) for r in only] == [("20240301", 3)]
    both = dicts(keyed.product_performance_range(daily, None, "20240301", "20240303"))
    assert sorted((r["day"], r["total_views"]) for r in both) == [("20240301", 4), ("20240302", 4)]


def test_daily_table_joins_views_carts_and_sales(spark):
    carts = keyed.cart_adds_daily(
        sessions(
            spark,
            dict(start_time=START, cart_contents={"p1": (2, 3.0), "p9": (1, 1.5)}),
            dict(start_time=START, cart_contents={"p1": (1, 4.0)}),
            dict(start_time="junk", cart_contents={"p1": (1, 4.0)}),
        )
    )
    cart_rows = by(carts, "product_id")
    assert (cart_rows["p1"].add_count, cart_rows["p1"].total_value_added) == (3, 10.0)
    sold = revenue.product_sales_daily(
        revenue.order_lines(transactions(spark, txn(1, items=[item("p1", 2, 5.0)])))
    )
    table = by(
        keyed.product_performance_table(keyed.product_performance_daily(views(spark)), carts, sold),
        "row_key",
    )
    assert set(table) == {"p1#20240301", "p1#20240302", "p9#20240301"}
    full = table["p1#20240301"]
    assert (full.views.views, full.cart.add_count, full.sales.revenue) == (3, 3, 10.0)
    assert table["p9#20240301"].views.views is None


def rows_of(spark, *users_and_times):
    return keyed.user_session_rows(
        sessions(spark, *[dict(user_id=u, start_time=t) for u, t in users_and_times])
    )


def test_recent_sessions_do_not_mix_users_with_the_same_prefix(spark):
    rows = rows_of(
        spark,
        *[("user_1", f"2024-03-0{d}T00:00:00") for d in (1, 2, 3)],
        *[("user_10", f"2024-03-0{d}T00:00:00") for d in (4, 5)],
    )
    newest = dicts(keyed.recent_sessions(rows, "user_1", n=2))
    assert [r["meta"]["start_time"][:10] for r in newest] == ["2024-03-03", "2024-03-02"]
    everyone = dicts(keyed.recent_sessions(rows, n=1))
    assert sorted(r["meta"]["start_time"][:10] for r in everyone) == ["2024-03-03", "2024-03-05"]


def test_key_scans_and_lookups(spark):
    df = spark.createDataFrame(
        [("a#1", 1), ("a#2", 2), ("b#1", 3)], "row_key string, n int"
    ).withColumn("f", F.struct("n"))

    def keys(**bounds):
        return [r.row_key for r in keyed.key_range_scan(df, **bounds).collect()]

    assert keys() == keys(limit=0) == ["a#1", "a#2", "b#1"]
    assert keys(start="a#2") == ["a#2", "b#1"] and keys(stop="a#2") == ["a#1"]
    assert keys(start="a#", stop="a#~", limit=1) == ["a#1"]
    assert dicts(keyed.point_lookup(df, "a#2", family="f")) == [{"n": 2}]
    assert dicts(keyed.point_lookup(df, "zz")) == []
    matching = keyed.filter_by_value_limit(df, "f.n", 3)
    assert [r.row_key for r in matching.collect()] == ["b#1"]


def test_upsert_keeps_cells_that_later_writes_leave_out(spark):
    df = spark.createDataFrame(
        [("k", 1, "a", None), ("k", 3, None, 30), ("k", 2, "b", 20), ("m", 1, None, None)],
        "key string, seq int, x string, y int",
    )
    rows = by(keyed.upsert_latest(df, "key", "seq"), "key")
    assert (rows["k"].x, rows["k"].y, rows["k"].seq) == ("b", 30, 3)
    assert (rows["m"].x, rows["m"].y) == (None, None)


def test_row_counts(spark):
    counted = keyed.row_counts({"three": spark.range(3), "none": spark.range(0)})
    assert {r.table_name: r.row_count for r in counted.collect()} == {"three": 3, "none": 0}


def test_empty_sessions(spark):
    df = frame(spark, "sessions", [])
    assert keyed.user_session_rows(df, seq="session_id").collect() == []
    assert keyed.product_performance_daily(keyed.page_views(df)).collect() == []
    assert keyed.cart_adds_daily(df).collect() == []


def test_no_session_is_lost_to_an_early_or_unreadable_time(spark):
    df = sessions(
        spark,
        dict(user_id="u1", start_time="1969-12-31T23:59:59"),
        dict(user_id="u2", start_time="1969-01-01T00:00:00"),
        dict(user_id="u3", start_time="junk"),
        dict(user_id="u4", start_time=START),
        dict(user_id=None, start_time=START),
    )
    rows = dicts(keyed.user_session_rows(df, seq=["end_time", "session_id"]))
    assert sorted(r["user_id"] for r in rows) == ["u1", "u2", "u4"]
    early = {r["user_id"]: r["row_key"].split("#")[1] for r in rows}
    assert early["u4"] < early["u1"] < early["u2"]
    rejected = dicts(keyed.rejected_sessions(df))
    assert sorted(r["session_id"] for r in rejected) == ["s2", "s4"]


def test_the_last_write_is_the_one_that_ended_last(spark):
    df = sessions(
        spark,
        dict(session_id="1#10", start_time=START, end_time="2024-03-01T12:00:00", referrer="late"),
        dict(session_id="1#9", start_time=START, end_time="2024-03-01T11:00:00", referrer="early"),
    )
    rows = dicts(keyed.user_session_rows(df, seq=["end_time", "session_id"]))
    assert [r["meta"]["referrer"] for r in rows] == ["late"]
    plan = keyed.user_session_rows(df, seq="session_id")._jdf.queryExecution().executedPlan()
    assert "SortAggregate" not in plan.toString()


def test_the_stored_product_table_is_read_by_day(spark, tmp_path):
    carts = keyed.cart_adds_daily(sessions(spark, dict(start_time=START, cart_contents={"p9": (1, 1.5)})))
    sold = revenue.product_sales_daily(
        revenue.order_lines(transactions(spark, txn(1, items=[item("p1", 2, 5.0)])))
    )
    table = keyed.product_performance_table(keyed.product_performance_daily(views(spark)), carts, sold)
    path = str(tmp_path / "performance")
    files.to_keyed_parquet(table, path, partition_by=["day"])
    stored = spark.read.schema(table.schema).parquet(path)
    found = keyed.product_performance_range(stored, None, "20240301", "20240302")
    totals = {r.product_id: r.total_views for r in found.collect()}
    assert totals == {"p1": 3, "p9": 0}
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "day" in filters and "20240301" in filters and "20240302" in filters
