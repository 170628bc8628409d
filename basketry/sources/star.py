"""Entities from a star schema: orders and line items become transactions, parts become
products, customers become users, and an event log becomes sessions and page views.

Line items and page views stay flat rows.  Only the cart map is nested, after its
entries were summed per session and product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions.numeric import cents, dollars

# Session attributes, picked by the number in an event's properties.
REFERRERS = ("direct", "email", "social", "search_engine", "affiliate")
DEVICE_TYPES = ("mobile", "desktop", "tablet")
OPERATING_SYSTEMS = ("iOS", "Android", "Windows", "macOS")
BROWSERS = ("Chrome", "Safari", "Firefox", "Edge")

# What an event type stands for.
PAGE_TYPES = {
    "view": "product_detail",
    "click": "category_listing",
    "signup": "home",
    "purchase": "confirmation",
    "error": "search",
}

# The columns used of each table.  Given to the reader, so that no job has
# to look into the files before a query starts.
TABLES = {
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
                 o_totalprice double, o_orderdate timestamp_ntz""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_quantity double,
                   l_extendedprice double, l_discount double""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
               p_retailprice double""",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
                 value double, props string""",
}

SESSION_GAP_SECONDS = 12 * 3600
#: Divides the session gap, so that a minute lies in one slice.
POSITION_SECONDS = 60
SESSION_SLOTS = 24
SHARDS = 1024


def _pick(names: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in names]), index % len(names))


class StarSchema:
    """Lazy entities over the Parquet tables in one directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read.schema(TABLES[name])
            self._tables[name] = reader.parquet(f"{self.directory}/{name}.parquet")
        return self._tables[name]

    # -- transactions -----------------------------------------------------------------

    def raw_transactions(self, tidy_status: bool = False) -> DataFrame:
        """Orders as uncleaned transactions, without their items; with a tidy status, a filter
        on it becomes one on the order's own."""
        done = "completed" if tidy_status else " Completed"
        status = F.lit(None).cast("string")
        for code, name in (("P", "shipped"), ("O", "processing"), ("F", done)):
            status = F.when(F.col("o_orderstatus").eqNullSafe(code), name).otherwise(status)
        order = F.col("o_orderkey")
        slot = F.lit(1) + F.floor(order / 4).cast("bigint") % SESSION_SLOTS
        return (
            self.table("orders")
            .join(self._order_totals(), F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(
                order.alias("transaction_id"),
                F.when(
                    order % 4 != 0, F.concat_ws("#", F.col("o_custkey"), slot)
                ).alias("session_id"),
                F.col("o_custkey").alias("user_id"),
                F.col("o_orderdate").alias("timestamp"),
                "subtotal",
                "discount",
                F.col("o_totalprice").alias("total"),
                status.alias("status"),
                "n_lines",
            )
        )

    def _order_totals(self) -> DataFrame:
        """Per order: sum of its lines, discount rounded half up to cents, line count."""
        price = cents(F.col("l_extendedprice"))
        share = cents(F.col("l_discount"))
        # A price in cents times a discount in hundredths counts hundredths of a cent.
        off = F.floor((F.sum(price * share) * 2 + 100) / 200)
        return (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(
                dollars(F.sum(price)).alias("subtotal"),
                dollars(off).alias("discount"),
                F.count("*").alias("n_lines"),
            )
        )

    def items(self) -> DataFrame:
        """Line items by the number of their transaction."""
        price = cents(F.col("l_extendedprice"))
        quantity = F.col("l_quantity").cast("bigint")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
            dollars(F.floor((price * 2 + quantity) / (quantity * 2))).alias("unit_price"),
            F.col("l_extendedprice").alias("subtotal"),
        )

    def order_lines(self, transactions: DataFrame, with_discount: bool = False) -> DataFrame:
        """Line items with the columns they share with their (cleaned) transaction; the
        discount and the number of lines only where asked for.

        Spark splits an order with a large part of all lines over several tasks if both
        sides were shuffled for this very join.  With the discount, transactions are
        already partitioned by order from the join that brought it in; the second key
        has them shuffled again.
        """
        items = self.items()
        shared = ["transaction_id", "user_id", "timestamp", "date", "status"]
        if not with_discount:
            return items.join(transactions.select(shared), "transaction_id")
        shard = F.pmod("transaction_id", F.lit(SHARDS)).alias("shard")
        discounted = transactions.select(*shared, "discount", "n_lines", shard)
        return items.select("*", shard).join(discounted, ["transaction_id", "shard"]).drop("shard")

    # -- catalog and users ------------------------------------------------------------

    def raw_products(self) -> DataFrame:
        """Parts as uncleaned products."""
        price, day = F.col("p_retailprice"), F.lit("2024-01-01")
        entry = F.struct(price.alias("price"), day.alias("date"))
        changes = F.col("p_partkey") % 3
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("category_id"),
            F.concat_ws("/", "p_brand", "p_type").alias("subcategory_id"),
            price.alias("base_price"),
            F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("current_stock"),
            (F.col("p_size") % 20 != 0).cast("string").alias("is_active"),
            F.when(changes == 1, F.array(entry))
            .when(changes == 2, F.array(entry, entry))
            .alias("price_history"),
        )

    def categories(self) -> DataFrame:
        """Brands as categories with their part types."""
        sub = F.struct(
            F.concat_ws("/", "p_brand", "p_type").alias("subcategory_id"),
            F.col("p_type").alias("name"),
        )
        return (
            self.table("part")
            .groupBy(F.col("p_brand").alias("category_id"))
            .agg(F.collect_set(sub).alias("subcategories"))
            .withColumn("name", F.concat(F.lit("Category "), "category_id"))
        )

    def raw_users(self) -> DataFrame:
        """Customers as uncleaned users; the country is unknown for every twentieth."""
        activity = (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(
                F.min("o_orderdate").alias("registration_date"),
                F.max("o_orderdate").alias("last_active"),
            )
        )
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        country = F.when(F.col("c_custkey") % 20 != 0, F.col("n_name"))
        return (
            self.table("customer")
            .join(activity, "c_custkey", "left")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("c_custkey").alias("user_id"),
                F.struct(
                    F.lit(None).cast("string").alias("city"),
                    F.col("r_name").alias("state"),
                    country.alias("country"),
                ).alias("geo_data"),
                "registration_date",
                "last_active",
            )
        )

    # -- sessions ---------------------------------------------------------------------

    def _events(self) -> DataFrame:
        """Events with the number from their properties and their time slice.

        A slice is as long as the gap that ends a session, so a session can only begin
        with the first event of a slice.
        """
        seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
        return self.table("events").select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            F.col("ts").cast("timestamp").alias("ts"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            F.floor(seconds / SESSION_GAP_SECONDS).alias("slice"),
        )

    def _slices(self, with_clicks: bool = False) -> DataFrame:
        """One row per user and active time slice, with the session it belongs to.

        Events are summed per slice before anything is ordered by user, so the window
        sees at most two rows per user and day however many events a user has.  With
        ``with_clicks`` a slice carries its clicked products (number and top price of
        each), which are as many as a user touches in half a day.
        """
        event_type = F.col("event_type")
        click = event_type == "click"
        events = self._events()
        if with_clicks:
            events = events.groupBy("user_id", "slice", "k").agg(
                F.min("ts").alias("ts"),
                F.max("ts").alias("last_ts"),
                F.min("event_id").alias("event_id"),
                F.count("*").alias("n"),
                F.count_if(event_type == "purchase").alias("purchases"),
                F.count_if(click).alias("clicks"),
                F.max(F.when(click, F.col("value"))).alias("price"),
            )
            line = F.struct(
                F.col("k").cast("string").alias("product"), F.col("clicks").alias("quantity"), "price"
            )
            counts = [
                F.max("last_ts").alias("last_ts"),
                F.sum("n").alias("n_events"),
                F.sum("purchases").alias("purchases"),
                F.sum("clicks").alias("clicks"),
                F.collect_list(F.when(F.col("clicks") > 0, line)).alias("lines"),
            ]
        else:
            counts = [
                F.max("ts").alias("last_ts"),
                F.count("*").alias("n_events"),
                F.count_if(event_type == "purchase").alias("purchases"),
                F.count_if(click).alias("clicks"),
            ]
        slices = events.groupBy("user_id", "slice").agg(
            F.min("ts").alias("first_ts"),
            F.min("event_id").alias("first_event"),
            F.min_by("k", "event_id").alias("first_k"),
            *counts,
        )
        by_user = Window.partitionBy("user_id").orderBy("slice")
        gap = F.unix_micros("first_ts") - F.unix_micros(F.lag("last_ts").over(by_user))
        begins = F.coalesce(gap > SESSION_GAP_SECONDS * 1_000_000, F.lit(True))
        return slices.withColumn("begins", begins.cast("int")).withColumn(
            "session_no", F.sum("begins").over(by_user)
        )

    @staticmethod
    def _by_product(slices: DataFrame) -> DataFrame:
        """Slices with their clicks -> a row for each session and product, with the product's cart
        entry (null for no product).

        A slice's own counts go with its first line only; the rest is the same however often it
        is repeated.  Rows are partitioned by user already, so nothing is shuffled.
        """
        own = [c for c in slices.columns if c not in ("lines", "purchases", "clicks")]
        first = F.coalesce(F.col("at"), F.lit(0)) == 0
        value = F.struct(F.sum("line.quantity").cast("int").alias("quantity"), F.max("line.price").alias("price"))
        entry = F.struct(F.col("product").alias("key"), value.alias("value"))
        return (
            slices.select(*own, "purchases", "clicks", F.posexplode_outer("lines").alias("at", "line"))
            .groupBy("user_id", "session_no", F.col("line.product").alias("product"))
            .agg(
                F.min("first_ts").alias("first_ts"),
                F.max("last_ts").alias("last_ts"),
                F.min_by("first_k", "first_event").alias("first_k"),
                F.min("first_event").alias("first_event"),
                F.sum(F.when(first, F.col("purchases")).otherwise(0)).alias("purchases"),
                F.sum(F.when(first, F.col("clicks")).otherwise(0)).alias("clicks"),
                F.when(F.col("product").isNotNull(), entry).alias("entry"),
            )
        )

    def sessions(self, with_cart: bool = False) -> DataFrame:
        """Sessions: a user's events up to the next pause of more than 12 hours."""
        first_k = F.col("k")
        profile = F.struct(
            _pick(DEVICE_TYPES, first_k).alias("type"),
            _pick(OPERATING_SYSTEMS, first_k).alias("os"),
            _pick(BROWSERS, first_k).alias("browser"),
        )
        status = (
            F.when(F.col("purchases") > 0, "converted")
            .when(F.col("clicks") > 0, "abandoned")
            .otherwise("browsed")
        )
        place = "struct<city:string, state:string, country:string, ip_address:string>"
        slices = self._slices(with_cart)
        if with_cart:
            slices = self._by_product(slices)
        entries = [F.sort_array(F.collect_list("entry")).alias("entries")] if with_cart else []
        grouped = slices.groupBy("user_id", "session_no").agg(
            F.min("first_ts").alias("start_time"),
            F.max("last_ts").alias("end_time"),
            F.min_by("first_k", "first_event").alias("k"),
            F.sum("purchases").alias("purchases"),
            F.sum("clicks").alias("clicks"),
            *entries,
        )
        cart = F.lit(None)
        if with_cart:
            cart = F.when(F.size("entries") > 0, F.map_from_entries("entries"))
        seconds = F.unix_seconds("end_time") - F.unix_seconds("start_time")
        return grouped.select(
            F.concat_ws("#", "user_id", "session_no").alias("session_id"),
            "user_id",
            "start_time",
            "end_time",
            seconds.cast("int").alias("duration_seconds"),
            F.lit(None).cast(place).alias("geo_data"),
            F.when(first_k % 50 != 0, profile).alias("device_profile"),
            cart.cast("map<string, struct<quantity:int, price:double>>").alias("cart_contents"),
            status.alias("conversion_status"),
            _pick(REFERRERS, first_k).alias("referrer"),
        )

    def page_views(self) -> DataFrame:
        """Events as page views, without their session."""
        page = F.lit(None).cast("string")
        for event_type, name in reversed(PAGE_TYPES.items()):
            page = F.when(F.col("event_type").eqNullSafe(event_type), name).otherwise(page)
        return self._events().select(
            "event_id",
            "user_id",
            "slice",
            F.col("ts").alias("timestamp"),
            page.alias("page_type"),
            F.col("k").cast("bigint").alias("product_id"),
            F.lit(None).cast("string").alias("category_id"),
            F.floor("value").cast("int").alias("view_duration"),
        )

    def session_page_views(self) -> DataFrame:
        """Page views with their session and position in it.

        Positions are counted inside a minute, and moved by the events of the minutes before
        in the time slice and by those of the session's earlier slices.  The largest window
        over events is one user's minute; the others see a row for each minute or slice.
        """
        earlier = Window.partitionBy("user_id", "session_no").orderBy("slice")
        slices = self._slices().select(
            "user_id",
            "slice",
            F.concat_ws("#", "user_id", "session_no").alias("session_id"),
            (F.sum("n_events").over(earlier) - F.col("n_events")).alias("before_slice"),
        )
        views = self.page_views().withColumn(
            "minute", F.floor(F.unix_seconds("timestamp") / POSITION_SECONDS)
        )
        in_slice = Window.partitionBy("user_id", "slice").orderBy("minute")
        minutes = (
            views.groupBy("user_id", "slice", "minute")
            .agg(F.count("*").alias("n"))
            .withColumn("before_minute", F.sum("n").over(in_slice) - F.col("n"))
            .join(slices, ["user_id", "slice"])
            .select(
                "user_id",
                "minute",
                "session_id",
                (F.col("before_slice") + F.col("before_minute")).alias("before"),
            )
        )
        in_minute = Window.partitionBy("user_id", "minute").orderBy("timestamp", "event_id")
        return (
            views.withColumn("at", F.row_number().over(in_minute) - 1)
            .join(minutes, ["user_id", "minute"])
            .withColumn("seq", F.col("before") + F.col("at"))
            .drop("before", "at", "slice", "minute", "event_id")
        )
