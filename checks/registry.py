"""Every operator as a named query over the star-schema tables in a directory.

Only scalar columns leave a query, and dates and times leave it as text.  Spend
thresholds fit the order sizes of these tables; the operators' defaults are lower.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import (
    baskets, clean, customers, keyed, ledger, pairs, reach, revenue, sketches, summary,
)
from basketry.operators import sessions as funnels
from basketry.plans.profile import customer_profile
from basketry.plans.sqlapi import register_functions
from basketry.session import prepare
from basketry.sources import files
from basketry.sources.colocated import Colocated
from basketry.sources.merge import KeyedTable
from basketry.sources.shared import new_folder, stored, unique_name
from basketry.sources.star import OPERATING_SYSTEMS, StarSchema

MID_SPEND, HIGH_SPEND = 500_000.0, 1_000_000.0
AS_OF = "2002-01-01"
RANGE = ("20240105", "20240120")
STATUS_LIMIT = 100
#: Days that reach a stored table one after the other, as batches.
BATCHES = 3

Query = Callable[[SparkSession, str], DataFrame]


def _time_text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def _date_text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


class Entities(StarSchema):
    """The cleaned entities the operators take."""

    def transactions(self) -> DataFrame:
        return clean.clean_transactions(self.raw_transactions(tidy_status=True), tidy_status=True)

    def lines(self, with_discount: bool = False) -> DataFrame:
        return self.order_lines(self.transactions(), with_discount)

    def users(self) -> DataFrame:
        return clean.clean_users(self.raw_users(), F.to_date(F.lit(AS_OF)))

    def products(self, missing: str | None = "Unknown") -> DataFrame:
        return clean.enrich_products(self.raw_products(), self.categories(), missing)

    def profile(self) -> DataFrame:
        return customer_profile(self.transactions(), self.sessions(), self.users())

    def session_rows(self) -> DataFrame:
        return keyed.user_session_rows(self.sessions(), seq=["end_time", "session_id"])


def _flat_session_rows(rows: DataFrame) -> DataFrame:
    return rows.select("row_key", "user_id", "meta.*", "geo.*", "cart.*")


def clean_transactions(e: Entities) -> DataFrame:
    return clean.clean_transactions(e.raw_transactions()).select(
        "transaction_id", "session_id", "user_id", _time_text("timestamp"), "subtotal",
        "discount", "total", "status", "is_suspicious", _date_text("date"), "year_month",
    )


def clean_users(e: Entities) -> DataFrame:
    return e.users().select(
        "user_id", "country", _time_text("registration_date"), _time_text("last_active"),
        "reg_year_month", "tenure_days",
    )


def clean_products(e: Entities) -> DataFrame:
    return clean.clean_products(e.raw_products()).select(
        "product_id", "name", "category_id", "base_price", "current_stock", "is_active",
        "price_history_len", "is_price_volatile",
    )


def enrich_products(e: Entities) -> DataFrame:
    return e.products().select("product_id", "name", "category_name", "subcategory_name")


def transaction_quality_profile(e: Entities) -> DataFrame:
    return clean.transaction_quality_profile(e.transactions())


def daily_revenue(e: Entities) -> DataFrame:
    return revenue.daily_revenue(e.transactions()).withColumn("date", _date_text("date"))


def daily_revenue_series(e: Entities) -> DataFrame:
    return revenue.daily_revenue_series(e.transactions()).withColumn("date", _date_text("date"))


def funnel_by_referrer(e: Entities) -> DataFrame:
    return funnels.funnel_by_referrer(e.sessions())


def revenue_by_device_os(e: Entities) -> DataFrame:
    return funnels.revenue_by_device_os(e.transactions(), e.sessions())


def ltv_segments(e: Entities) -> DataFrame:
    return customers.ltv_segments(e.transactions(), MID_SPEND, HIGH_SPEND)


def copurchase_pairs(e: Entities) -> DataFrame:
    return pairs.copurchase_pairs(e.lines(), e.raw_products())


def product_purchase_counts(e: Entities) -> DataFrame:
    return baskets.product_purchase_counts(e.lines())


def cohort_revenue(e: Entities) -> DataFrame:
    return customers.cohort_revenue(e.users(), e.transactions())


def user_monthly_spend(e: Entities) -> DataFrame:
    return customers.user_monthly_spend(e.transactions())


def product_popularity(e: Entities) -> DataFrame:
    return revenue.product_popularity(e.lines(), e.products())


def revenue_by_category(e: Entities) -> DataFrame:
    return revenue.revenue_by_category(e.lines(with_discount=True), e.products())


def category_revenue_allocated(e: Entities) -> DataFrame:
    return revenue.category_revenue_allocated(
        e.lines(with_discount=True), e.products(missing=None), digits=2
    )


def product_sales_daily(e: Entities) -> DataFrame:
    return revenue.product_sales_daily(e.lines())


def kpi_summary(e: Entities) -> DataFrame:
    return summary.kpi_summary(
        e.transactions(),
        e.sessions(),
        e.lines(with_discount=True),
        e.products(missing=None),
        digits=2,
    )


def clv_features(e: Entities) -> DataFrame:
    features = customers.clv_features(e.transactions())
    return features.withColumns(
        {name: _time_text(name) for name in ("first_purchase", "last_purchase")}
    )


def clv_tier(e: Entities) -> DataFrame:
    tiers = customers.clv_tier(customers.clv_features(e.transactions()))
    return tiers.select("user_id", "clv", "clv_tier")


def engagement_features(e: Entities) -> DataFrame:
    return customers.engagement_features(e.sessions())


def unified_profile(e: Entities) -> DataFrame:
    times = ("first_purchase", "last_purchase", "registration_date")
    return e.profile().withColumns({name: _time_text(name) for name in times})


def clv_segment_summary(e: Entities) -> DataFrame:
    return customers.clv_segment_summary(e.profile())


def clv_segment_behaviour(e: Entities) -> DataFrame:
    untiered = customers.unified_profile(
        customers.clv_features(e.transactions()),
        customers.engagement_features(e.sessions()),
        e.users(),
    )
    return customers.clv_segment_behaviour(untiered)


def top_clv_users(e: Entities) -> DataFrame:
    return customers.top_clv_users(e.profile())


def referrer_revenue(e: Entities) -> DataFrame:
    return customers.referrer_revenue(e.profile())


def clv_segments_fixed(e: Entities) -> DataFrame:
    return customers.clv_segments_fixed(e.transactions(), e.sessions(), MID_SPEND, HIGH_SPEND)


def funnel_composition(e: Entities) -> DataFrame:
    return funnels.funnel_composition(e.sessions())


def referrer_conversion(e: Entities) -> DataFrame:
    return funnels.referrer_conversion(e.sessions())


def device_os_matrix(e: Entities) -> DataFrame:
    return funnels.device_os_matrix(e.transactions(), e.sessions(), OPERATING_SYSTEMS)


def user_session_rows(e: Entities) -> DataFrame:
    rows = keyed.user_session_rows(e.sessions(with_cart=True), seq=["end_time", "session_id"])
    return _flat_session_rows(rows)


def recent_sessions(e: Entities) -> DataFrame:
    return keyed.recent_sessions(e.session_rows(), n=5).select(
        "row_key", "user_id", "meta.start_time", "meta.conversion_status"
    )


def filter_by_value_limit(e: Entities) -> DataFrame:
    found = keyed.filter_by_value_limit(
        e.session_rows(), "meta.conversion_status", "converted", STATUS_LIMIT
    )
    return found.select("row_key", "user_id", "meta.conversion_status")


def key_range_scan(e: Entities) -> DataFrame:
    rows = keyed.key_range_scan(e.session_rows(), start="1", stop="3")
    return rows.select("row_key", "user_id", "meta.duration_seconds")


def product_performance_daily(e: Entities) -> DataFrame:
    return keyed.product_performance_daily(e.page_views())


def product_performance_range(e: Entities) -> DataFrame:
    daily = keyed.product_performance_daily(e.page_views())
    return keyed.product_performance_range(daily, start=RANGE[0], end=RANGE[1])


def cart_adds_daily(e: Entities) -> DataFrame:
    return keyed.cart_adds_daily(e.sessions(with_cart=True))


def product_performance_table(e: Entities) -> DataFrame:
    table = keyed.product_performance_table(
        keyed.product_performance_daily(e.page_views()),
        keyed.cart_adds_daily(e.sessions(with_cart=True)),
        revenue.product_sales_daily(e.lines()),
    )
    return table.select("row_key", "views.*", "cart.*", "sales.*")


def page_events(e: Entities) -> DataFrame:
    return keyed.page_events(e.session_page_views()).select(
        "row_key", "ev.page_type", "ev.product_id", "ev.view_duration",
        F.date_format("ev.timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )


def upsert_latest(e: Entities) -> DataFrame:
    """Per user the last value of each kind of event, cells of other kinds kept."""
    event_type, value = F.col("event_type"), F.col("value")
    writes = e.table("events").select(
        "user_id",
        "event_id",
        F.when(event_type == "view", value).alias("last_view"),
        F.when(event_type == "click", value).alias("last_click"),
        F.when(event_type == "purchase", value).alias("last_purchase"),
    )
    return keyed.upsert_latest(writes, "user_id", "event_id")


def point_lookup(e: Entities) -> DataFrame:
    """The newest session of the user whose key sorts first."""
    rows = e.session_rows()
    first_key = rows.agg(F.min("row_key")).scalar()
    return keyed.point_lookup(rows, first_key, family="meta")


def row_counts(e: Entities) -> DataFrame:
    return keyed.row_counts(
        {
            "user_sessions": e.session_rows(),
            "product_performance": keyed.product_performance_daily(e.page_views()),
        }
    )


def product_reach_range(e: Entities) -> DataFrame:
    """Distinct users in a range of days, from rows that can be added."""
    return reach.reach_in_range(reach.visitor_gaps(reach.daily_visitors(e.page_views())), *RANGE)


def product_reach_sketched(e: Entities) -> DataFrame:
    """The same from daily sketches; no product here has more users than they hold exactly."""
    return reach.sketched_reach(reach.daily_sketches(reach.daily_visitors(e.page_views())), *RANGE)


def order_value_bands(e: Entities) -> DataFrame:
    """Quartiles of completed orders per year, from daily sketches; no year here passes what they
    hold exactly."""
    daily = sketches.daily_value_sketches(e.transactions())
    year = F.year("date").alias("year")
    bands = sketches.merged_quantiles(daily, (0.25, 0.5, 0.75), [year])
    return bands.withColumnsRenamed({"q0": "low", "q1": "median", "q2": "high", "n": "orders"})


def _in_sql(e: Entities, query: str) -> DataFrame:
    register_functions(e.spark, {"transactions": e.transactions(), "sessions": e.sessions()})
    return e.spark.sql(query)


def daily_revenue_in_sql(e: Entities) -> DataFrame:
    return _in_sql(
        e,
        "SELECT CAST(date AS STRING) AS date, daily_orders, daily_revenue, rolling_avg AS rolling_7d_avg, "
        "daily_discount FROM daily_revenue(7)",
    )


def ltv_segments_in_sql(e: Entities) -> DataFrame:
    return _in_sql(e, f"SELECT * FROM ltv_segments(high => {HIGH_SPEND}D, mid => {MID_SPEND}D)")


def funnel_by_referrer_in_sql(e: Entities) -> DataFrame:
    return _in_sql(e, "SELECT * FROM funnel_by_referrer()")


def _stored_lines(e: Entities, *more: str) -> DataFrame:
    """Completed lines from orders and lines that are stored in one layout."""
    shared = ["user_id", "timestamp", "date", "status"]
    orders = e.transactions().select("transaction_id", *shared, "discount", "n_lines")
    buckets = int(e.spark.conf.get("spark.sql.shuffle.partitions"))
    name = unique_name("orders")
    store = Colocated(e.spark, new_folder(e.spark, "orders"), name, "transaction_id", buckets)
    store.create(orders, e.items())
    done = F.col("status") == "completed"
    return store.joined([*shared, *more], ["product_id", "quantity", "unit_price", "subtotal"], done)


def stored_revenue_by_category(e: Entities) -> DataFrame:
    return revenue.revenue_by_category(_stored_lines(e, "discount"), e.products())


def stored_category_revenue(e: Entities) -> DataFrame:
    return revenue.category_revenue_allocated(
        _stored_lines(e, "discount", "n_lines"), e.products(missing=None), digits=2
    )


def stored_sales_daily(e: Entities) -> DataFrame:
    return revenue.product_sales_daily(_stored_lines(e))


def _last_days(df: DataFrame, day: Column) -> list:
    """The last days of a table, in order."""
    found = df.select(day.alias("day")).filter("day is not null").distinct()
    return [row["day"] for row in found.orderBy(F.desc("day")).limit(BATCHES).collect()][::-1]


def clean_transactions_from_json(e: Entities) -> DataFrame:
    """Transactions written as objects on one long line a file, read back in blocks and cleaned."""
    raw = e.raw_transactions().drop("n_lines")
    path = new_folder(e.spark, "transactions-json")
    raw.select(F.to_json(F.struct("*"))).write.option("lineSep", " ").text(path)
    read = stored(files.read_entity(e.spark, "transactions", path), "transactions")
    return clean.clean_transactions(read).select(
        F.col("transaction_id").cast("bigint").alias("transaction_id"), "session_id",
        F.col("user_id").cast("bigint").alias("user_id"), _time_text("timestamp"), "subtotal",
        "discount", "total", "status", "is_suspicious", _date_text("date"), "year_month",
    )


def merged_session_rows(e: Entities) -> DataFrame:
    """The session table without its last days, into which these, and carts that were written
    late, are merged day by day."""
    rows = stored(
        keyed.user_session_rows(e.sessions(with_cart=True), seq=["end_time", "session_id"])
        .withColumn("day", F.left("meta.start_time", F.lit(10)))
        .withColumn("late", F.pmod(F.xxhash64("row_key"), F.lit(10 * BATCHES))),
        "session-rows",
    )
    days = _last_days(rows, F.col("day"))
    if not days:
        return _flat_session_rows(rows)
    cells = ["row_key", "user_id", "meta", "geo", "cart"]
    written = lambda df, n: df.select(*cells, F.lit(n).alias("written"))
    old = rows.filter(F.col("day") < days[0])
    no = lambda df, name: df.withColumn(name, F.lit(None).cast(df.schema[name].dataType))
    late = F.col("late") < BATCHES
    table = KeyedTable(e.spark, new_folder(e.spark, "keyed-sessions"))
    table.create(written(old.filter(~late).unionByName(no(old.filter(late), "cart")), 0))
    for n, day in enumerate(days):
        carts = no(no(old.filter(F.col("late") == n), "meta"), "geo")
        table.merge(written(rows.filter(F.col("day") == day).unionByName(carts), n + 1))
    return _flat_session_rows(table.read())


def _kept_ledger(e: Entities) -> DataFrame:
    """Partial sums of all orders but the last days, every fifth with a status that was wrong at first,
    to which the days and the corrections are applied day by day."""
    names = ["transaction_id", "user_id", "timestamp", "date", "year_month", "status", "total", "discount"]
    orders = stored(e.transactions().select(names), "orders")
    days = _last_days(orders, F.col("date"))
    number = F.col("transaction_id")
    wrong = F.when(F.col("status") == "completed", "processing").otherwise("completed")
    at_first = F.when(number % 5 == 0, wrong).otherwise(F.col("status"))
    recent = F.col("date").isin(days)
    old = orders.filter(~recent | F.col("date").isNull())
    kept = ledger.Ledger(e.spark, new_folder(e.spark, "ledger"))
    kept.create(old.withColumn("status", at_first))
    for n, day in enumerate(days):
        due = old.filter((number % 5 == 0) & (F.floor(number / 5) % len(days) == n))
        new = orders.filter(F.col("date") == day)
        kept.apply(due.withColumn("status", at_first), due.unionByName(new), n + 1)
    return kept.rows()


def ledger_monthly_spend(e: Entities) -> DataFrame:
    return ledger.user_monthly_spend(_kept_ledger(e))


def ledger_ltv_segments(e: Entities) -> DataFrame:
    return ledger.ltv_segments(_kept_ledger(e), MID_SPEND, HIGH_SPEND)


def ledger_clv_features(e: Entities) -> DataFrame:
    times = ("first_purchase", "last_purchase")
    features = ledger.clv_features(_kept_ledger(e))
    return features.withColumns({name: _time_text(name) for name in times})


OPERATORS = (
    clean_transactions,
    clean_users,
    clean_products,
    enrich_products,
    transaction_quality_profile,
    daily_revenue,
    funnel_by_referrer,
    revenue_by_device_os,
    ltv_segments,
    copurchase_pairs,
    cohort_revenue,
    product_popularity,
    revenue_by_category,
    category_revenue_allocated,
    clv_features,
    clv_tier,
    engagement_features,
    unified_profile,
    clv_segment_summary,
    top_clv_users,
    referrer_revenue,
    clv_segments_fixed,
    funnel_composition,
    clv_segment_behaviour,
    device_os_matrix,
    daily_revenue_series,
    kpi_summary,
    user_session_rows,
    product_performance_daily,
    recent_sessions,
    product_performance_range,
    key_range_scan,
    point_lookup,
    row_counts,
    upsert_latest,
    filter_by_value_limit,
    page_events,
    product_sales_daily,
    cart_adds_daily,
    product_performance_table,
    referrer_conversion,
    user_monthly_spend,
    product_purchase_counts,
    product_reach_range,
    product_reach_sketched,
    order_value_bands,
    daily_revenue_in_sql,
    ltv_segments_in_sql,
    funnel_by_referrer_in_sql,
    stored_revenue_by_category,
    stored_category_revenue,
    stored_sales_daily,
    clean_transactions_from_json,
    merged_session_rows,
    ledger_monthly_spend,
    ledger_ltv_segments,
    ledger_clv_features,
)


def _bound(operator: Callable[[Entities], DataFrame]) -> Query:
    return lambda spark, directory: operator(Entities(prepare(spark), directory))


def queries() -> dict[str, Query]:
    return {operator.__name__: _bound(operator) for operator in OPERATORS}
