"""The whole batch: raw JSON entities in, cleaned tables, keyed tables and reports out.

    python -m basketry.plans.reports INPUT_DIR OUTPUT_DIR --as-of 2024-12-31

Each cleaned entity, and the customer profile, is written once as Parquet and read back,
so every report scans columns instead of parsing JSON again, a filter on the status
reaches the Parquet reader, and a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import clean, customers, keyed, pairs, revenue, summary
from basketry.operators import sessions as funnels
from basketry.plans.profile import customer_profile
from basketry.plans.sqlapi import register_functions
from basketry.session import prepare
from basketry.sources import files


#: Cells that are searched for by value, though the tables are sorted by key.
BLOOM = {
    "user_sessions": ("user_id", "meta.conversion_status"),
    "page_events": ("ev.product_id",),
}


def read_inputs(
    spark: SparkSession, directory: str, layout: str = "objects", documents: bool = False
) -> dict[str, DataFrame]:
    """The raw entities of a directory of JSON files, of users, products, transactions and sessions with
    their whole documents where asked for."""
    single = ("users", "categories", "products", "transactions")
    read = lambda name, path: files.read_entity(
        spark, name, path, layout, documents and name != "categories"
    )
    raw = {name: read(name, f"{directory}/{name}.json") for name in single}
    return raw | {"sessions": read("sessions", f"{directory}/sessions_*.json")}


def write_cleaned(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    directory: str,
    as_of: Column,
    counts: dict[str, dict[str, int]] | None = None,
) -> dict[str, DataFrame]:
    """Write the cleaned entities, the order lines and the page views; return them as read
    back.  ``counts`` gets what was counted while each was written."""
    counts = {} if counts is None else counts

    def stored(name: str, df: DataFrame, counted: list[Column] | None = None) -> DataFrame:
        path = f"{directory}/tables/{name}"
        counts[name] = files.to_parquet(df, path, counts=counted or [])
        return spark.read.parquet(path)

    categories = clean.clean_categories(raw["categories"])
    products = clean.enrich_products(clean.clean_products(raw["products"]), categories)
    tables = {
        "transactions": stored(
            "transactions",
            clean.clean_transactions(raw["transactions"]),
            clean.quality_counts(),
        ),
        "users": stored("users", clean.clean_users(raw["users"], as_of)),
        "products": stored("products", products),
        "sessions": stored("sessions", clean.clean_sessions(raw["sessions"])),
    }
    tables["lines"] = stored("lines", revenue.order_lines(tables["transactions"]))
    tables["views"] = stored("views", keyed.page_views(tables["sessions"]))
    profile = customer_profile(tables["transactions"], tables["sessions"], tables["users"])
    tables["profile"] = stored("profile", profile)
    return tables


def write_keyed(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    directory: str,
    counts: dict[str, dict[str, int]] | None = None,
) -> dict[str, DataFrame]:
    """Write the keyed tables in key order; return them as read back.  ``counts`` gets their rows and
    those of the rejected sessions."""
    counts = {} if counts is None else counts
    daily = keyed.product_performance_table(
        keyed.product_performance_daily(tables["views"]),
        keyed.cart_adds_daily(tables["sessions"]),
        revenue.product_sales_daily(tables["lines"]),
    )
    sessions = tables["sessions"]
    built = {
        "user_sessions": keyed.user_session_rows(sessions, seq=["end_time", "session_id"]),
        "product_performance": daily,
        "page_events": keyed.page_events(tables["views"]),
    }
    for name, df in built.items():
        folders = ("day",) if name == "product_performance" else ()
        path = f"{directory}/keyed/{name}"
        counts[name] = files.to_keyed_parquet(df, path, partition_by=folders, bloom=BLOOM.get(name, ()))
    rejected = keyed.rejected_sessions(sessions)
    counts["rejected_sessions"] = files.to_parquet(rejected, f"{directory}/rejected/sessions")
    # With the schema given, a day in a folder's name stays text.
    reader = {name: spark.read.schema(df.schema) for name, df in built.items()}
    return {name: reader[name].parquet(f"{directory}/keyed/{name}") for name in built}


def reports(t: dict[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """Every report by name over the cleaned tables."""
    # Reports that leave uncategorised products out need null, not 'Unknown'.
    categorised = t["products"].withColumn(
        "category_name", F.nullif(F.col("category_name"), F.lit("Unknown"))
    )
    return {
        "transaction_quality": lambda: clean.transaction_quality_profile(t["transactions"]),
        "daily_revenue": lambda: revenue.daily_revenue(t["transactions"]),
        "funnel_by_referrer": lambda: funnels.funnel_by_referrer(t["sessions"]),
        "funnel_composition": lambda: funnels.funnel_composition(t["sessions"]),
        "revenue_by_device_os": lambda: funnels.revenue_by_device_os(
            t["transactions"], t["sessions"]
        ),
        "device_os_matrix": lambda: funnels.device_os_matrix(t["transactions"], t["sessions"]),
        "ltv_segments": lambda: customers.ltv_segments(t["transactions"]),
        "cohort_analysis": lambda: customers.cohort_revenue(t["users"], t["transactions"]),
        "copurchase_pairs": lambda: pairs.copurchase_pairs(t["lines"], t["products"]),
        "product_popularity": lambda: revenue.product_popularity(t["lines"], t["products"]),
        "revenue_by_category": lambda: revenue.revenue_by_category(t["lines"], t["products"]),
        "category_revenue": lambda: revenue.category_revenue_allocated(t["lines"], categorised),
        "clv_segment_summary": lambda: customers.clv_segment_summary(t["profile"]),
        "clv_segment_behaviour": lambda: customers.clv_segment_behaviour(t["profile"]),
        "clv_segments_fixed": lambda: customers.clv_segments_fixed(
            t["transactions"], t["sessions"]
        ),
        "top_clv_users": lambda: customers.top_clv_users(t["profile"]),
        "referrer_revenue": lambda: customers.referrer_revenue(t["profile"]),
        "kpi_summary": lambda: summary.kpi_summary(
            t["transactions"], t["sessions"], t["lines"], categorised
        ),
    }


def register_views(tables: dict[str, DataFrame]) -> None:
    """The tables as temporary views of their names, for SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    as_of: Column,
    layout: str = "objects",
    documents: bool = False,
) -> list[str]:
    """Write everything below ``output_dir``; return the names of the reports."""
    written: dict[str, dict[str, int]] = {}
    raw = read_inputs(prepare(spark), input_dir, layout, documents)
    tables = write_cleaned(spark, raw, output_dir, as_of, written)
    register_views(tables)
    register_functions(spark, tables)
    counted: dict[str, dict[str, int]] = {}
    write_keyed(spark, tables, output_dir, counted)
    quality = {k: v for k, v in written["transactions"].items() if k != "rows"}
    # Both were counted by the jobs that wrote the tables.
    known = reports(tables) | {
        "transaction_quality": lambda: clean.with_percent(
            spark.createDataFrame([quality], ", ".join(f"{name} bigint" for name in quality))
        ),
        "row_counts": lambda: keyed.counted_rows(
            spark, {name: found["rows"] for name, found in counted.items()}
        ),
        "unified_profile": lambda: tables["profile"],
    }
    for name, build in known.items():
        files.to_json_records(build(), f"{output_dir}/reports/{name}")
    return list(known)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("input_dir")
    parser.add_argument("output_dir")
    parser.add_argument("--as-of", help="date that tenure is counted to (default: today)")
    parser.add_argument("--layout", default="objects", choices=("objects", "lines"))
    parser.add_argument("--documents", action="store_true", help="keep whole documents beside the columns")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("commerce-reports").getOrCreate()
    as_of = F.to_date(F.lit(options.as_of)) if options.as_of else F.current_date()
    run(spark, options.input_dir, options.output_dir, as_of, options.layout, options.documents)
    spark.stop()


if __name__ == "__main__":
    main()
