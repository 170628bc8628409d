"""Keyed, time-ordered tables built from sessions, and the reads they are laid out for.

A keyed table has a string ``row_key`` and one struct column per group of cells.  Write
it with ``files.to_keyed_parquet``: the range filters below then skip whole files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.keys import compact_day, padded_position, reverse_timestamp, row_key
from basketry.functions.numeric import dollars, ratio, total
from basketry.functions.times import parsed


def _text(df: DataFrame, name: str) -> Column:
    """Cell text of a time column: as it came, or ISO when it is a timestamp."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.coalesce(F.col(name), F.lit(""))
    return F.coalesce(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))


def first_sessions(sessions: DataFrame, n: int | None) -> DataFrame:
    """The ``n`` earliest sessions, or all of them for None."""
    return sessions if n is None else sessions.orderBy("start_time", "session_id").limit(n)


def _session_key(sessions: DataFrame) -> Column:
    return row_key(F.col("user_id"), reverse_timestamp(parsed(sessions, "start_time")))


def rejected_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions without a user or a readable start time: they have no key and no row."""
    return sessions.filter(_session_key(sessions).isNull())


def user_session_rows(
    sessions: DataFrame,
    max_sessions: int | None = None,
    seq: str | Sequence[str] | None = None,
) -> DataFrame:
    """Sessions keyed 'user#reversed start time' (a user's newest first) with the cell
    groups ``meta``, ``geo`` and ``cart``; missing cells are '' or 0.  What has no key is in
    `rejected_sessions` instead.

    With ``seq`` (columns that order the writes, such as end time and id) sessions with the
    same key collapse to the last written one.
    """
    chosen = first_sessions(sessions, max_sessions)

    def cell(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(""))

    cart = F.col("cart_contents")
    exact = "decimal(38,6)"
    value = F.aggregate(
        F.map_values(cart),
        F.lit(0).cast(exact),
        lambda done, item: (
            done + F.coalesce((item["quantity"] * item["price"]).cast("decimal(28,6)"), F.lit(0))
        ).cast(exact),
    )
    rows = chosen.select(
        _session_key(chosen).alias("row_key"),
        "user_id",
        F.struct(
            _text(chosen, "start_time").alias("start_time"),
            _text(chosen, "end_time").alias("end_time"),
            F.coalesce("duration_seconds", F.lit(0)).alias("duration_seconds"),
            cell("device_profile.type").alias("device_type"),
            cell("device_profile.os").alias("device_os"),
            cell("device_profile.browser").alias("browser"),
            cell("referrer").alias("referrer"),
            cell("conversion_status").alias("conversion_status"),
        ).alias("meta"),
        F.struct(
            *[cell(f"geo_data.{part}").alias(part) for part in ("city", "state", "country")],
            cell("geo_data.ip_address").alias("ip_address"),
        ).alias("geo"),
        F.struct(
            F.coalesce(F.to_json(F.array_sort(F.map_keys(cart))), F.lit("[]")).alias("product_ids"),
            F.coalesce(F.round(value, 2).cast("double"), F.lit(0.0)).alias("total_value"),
        ).alias("cart"),
        *([] if seq is None else [F.struct(seq).alias("_seq")]),
    ).filter(F.col("row_key").isNotNull())
    if seq is None:
        return rows
    # No cell group is null, so the last write of a key is its last row.
    last = Window.partitionBy("row_key").orderBy(F.desc("_seq"))
    ranked = rows.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1")
    return ranked.drop("_rank", "_seq")


def page_views(sessions: DataFrame) -> DataFrame:
    """Nested sessions -> one row per page view, numbered from 0 within its session."""
    exploded = sessions.select("session_id", "user_id", F.posexplode("page_views").alias("seq", "view"))
    flat = exploded.select("session_id", "user_id", "seq", "view.*")
    return flat.withColumn("timestamp", parsed(flat, "timestamp"))


def page_events(views: DataFrame) -> DataFrame:
    """Page views keyed 'user#session#position' with the cell group ``ev``."""
    return views.select(
        row_key(F.col("user_id"), F.col("session_id"), padded_position(F.col("seq"))).alias(
            "row_key"
        ),
        F.struct("page_type", "product_id", "category_id", "view_duration", "timestamp").alias("ev"),
    )


def product_performance_daily(views: DataFrame) -> DataFrame:
    """Product page views per product and day, keyed 'product#yyyyMMdd': views, distinct
    users, mean seconds (a missing duration counts as 0).  Views without a readable time
    or a product do not count."""
    product = F.col("product_id")
    duration = F.coalesce(F.col("view_duration").cast("bigint"), F.lit(0))
    return (
        views.filter(
            (F.col("page_type") == "product_detail")
            & product.isNotNull()
            & (product.cast("string") != "")
            & F.col("timestamp").isNotNull()
        )
        .groupBy("product_id", compact_day(F.col("timestamp")).alias("day"))
        .agg(
            F.count("*").alias("views"),
            F.count_distinct("user_id").alias("unique_users"),
            ratio(F.sum(duration), F.count("*"), 1).alias("avg_dur_sec"),
        )
        .select(row_key(product, F.col("day")).alias("row_key"), "*")
    )


def cart_adds_daily(sessions: DataFrame) -> DataFrame:
    """Units and value put into carts per product and day of the session's start."""
    start = parsed(sessions, "start_time")
    lines = sessions.select(
        compact_day(start).alias("day"), F.explode("cart_contents").alias("product_id", "line")
    )
    quantity = F.col("line.quantity").cast("bigint")
    return (
        lines.filter(F.col("day").isNotNull())
        .groupBy("product_id", "day")
        .agg(
            F.sum(quantity).alias("add_count"),
            dollars(total(quantity * F.col("line.price"))).alias("total_value_added"),
        )
    )


def product_performance_table(views: DataFrame, carts: DataFrame, sales: DataFrame) -> DataFrame:
    """The three daily aggregates side by side, one row per product and day that has any
    of them, keyed 'product#yyyyMMdd'; absent cells are null."""
    on = ["product_id", "day"]
    daily = (
        views.drop("row_key")
        .withColumn("product_id", F.col("product_id").cast("string"))
        .join(carts.withColumn("product_id", F.col("product_id").cast("string")), on, "full")
        .join(sales.withColumn("product_id", F.col("product_id").cast("string")), on, "full")
    )
    return daily.select(
        row_key(F.col("product_id"), F.col("day")).alias("row_key"),
        "product_id",
        "day",
        F.struct("views", "unique_users", "avg_dur_sec").alias("views"),
        F.struct("add_count", "total_value_added").alias("cart"),
        F.struct("units_sold", "revenue", "order_count").alias("sales"),
    )


def recent_sessions(rows: DataFrame, user_id=None, n: int = 5) -> DataFrame:
    """The ``n`` newest sessions of one user, or of every user.

    For every user Spark keeps ``n`` rows per user before the shuffle, so a user with a
    large part of all sessions does not fill one task.
    """
    if user_id is not None:
        return rows.filter(F.col("user_id") == user_id).orderBy("row_key").limit(n)
    newest = Window.partitionBy("user_id").orderBy("row_key")
    ranked = rows.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def product_performance_range(
    performance: DataFrame, product_id=None, start: str = "20250101", end: str = "20251231"
) -> DataFrame:
    """Daily rows from ``start`` up to but *not* including ``end`` for one product (or
    each), with the product's total views in the range.

    ``performance`` is the result of `product_performance_daily` or, stored in folders by
    day, of `product_performance_table`.
    """
    chosen = performance.filter((F.col("day") >= start) & (F.col("day") < end))
    if product_id is not None:
        chosen = chosen.filter(F.col("product_id") == product_id)
    # At most one row per day and product reaches this window.
    in_range = Window.partitionBy("product_id")
    nested = isinstance(performance.schema["views"].dataType, T.StructType)
    views = F.col("views.views" if nested else "views")
    return chosen.withColumn("total_views", F.coalesce(F.sum(views).over(in_range), F.lit(0)))


def key_range_scan(
    df: DataFrame,
    key: str = "row_key",
    start: str | None = None,
    stop: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows with ``start`` <= key < ``stop`` in key order; an empty bound is open, and no
    limit (or 0) means all."""
    if start:
        df = df.filter(F.col(key) >= start)
    if stop:
        df = df.filter(F.col(key) < stop)
    ordered = df.orderBy(key)
    return ordered.limit(limit) if limit else ordered


def point_lookup(
    df: DataFrame, value, key: str = "row_key", family: str | None = None
) -> DataFrame:
    """The row with this key, or just the cells of one group."""
    found = df.filter(F.col(key) == value)
    return found if family is None else found.select(f"{family}.*")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def counted_rows(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """`row_counts` of tables whose rows were counted when they were written."""
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


def upsert_latest(
    df: DataFrame, key: str, seq: str, constant: Sequence[str] = ()
) -> DataFrame:
    """One row per key after writing all rows in ``seq`` order: each cell holds its last
    non-null value.  ``seq`` must not repeat within a key.  ``constant`` names columns that
    follow from the key."""
    cells = [name for name in df.columns if name not in (key, seq, *constant)]
    latest = [
        F.max_by(F.col(name), F.when(F.col(name).isNotNull(), F.col(seq))).alias(name)
        for name in cells
    ]
    found = df.groupBy(key, *constant).agg(*latest, F.max(seq).alias(seq))
    return found.select(df.columns)


def filter_by_value_limit(
    rows: DataFrame, column: str, value, limit: int = 100, key: str = "row_key"
) -> DataFrame:
    """The first ``limit`` rows in key order whose cell holds ``value``."""
    return rows.filter(F.col(column) == value).orderBy(key).limit(limit)
