"""Customer aggregates that follow orders as they change, without reading all orders again.

The ledger holds partial sums: for each user and moment of purchase the completed orders
and their amounts.  A change of an order is two entries, its old version subtracted and its
new one added, so a batch of changes is summed up per user and moment and added to what is
stored, in the folders of the months it touches.  Whatever was taken back is zero again, and
first and last purchase follow from the moments that still hold an order.

Amounts are kept as whole dollars and millionths, as `functions.numeric.total` adds them, so
any number of additions and retractions ends in the same sums as one full computation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.numeric import cents, dollars, money_mean, parts_of, ratio, rounded, total_of
from basketry.functions.times import whole_days_between
from basketry.sources import merge

KEY = ["user_id", "timestamp"]
FOLDER = "year_month"
#: What one completed order adds; amounts as whole dollars and millionths.
SUMS = ("orders", "with_id", "with_total", "total_whole", "total_parts", "discount_whole", "discount_parts")
BATCH = "batch"
UNDATED = "none"


def entries(orders: DataFrame, sign: int = 1) -> DataFrame:
    """Ledger entries of the completed ones of cleaned ``orders``, to be added or subtracted."""
    spent, off = parts_of(F.col("total")), parts_of(F.col("discount"))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    values = {
        "orders": one,
        "with_id": F.col("transaction_id").isNotNull().cast("long"),
        "with_total": F.col("total").isNotNull().cast("long"),
        "total_whole": F.coalesce(spent[0], none),
        "total_parts": F.coalesce(spent[1], none),
        "discount_whole": F.coalesce(off[0], none),
        "discount_parts": F.coalesce(off[1], none),
    }
    done = orders.filter(F.col("status") == "completed")
    signed = [(F.lit(sign) * value).cast("long").alias(name) for name, value in values.items()]
    return done.select(*KEY, F.coalesce(FOLDER, F.lit(UNDATED)).alias(FOLDER), *signed)


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Entries of orders that were ``before`` and are ``after`` now; new orders have no row before."""
    return entries(before, -1).unionByName(entries(after))


def summed(rows: DataFrame) -> DataFrame:
    """Entries of the same user and moment as one."""
    return rows.groupBy(*KEY, FOLDER).agg(*[F.sum(name).alias(name) for name in SUMS])


class Ledger:
    """The stored partial sums at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def create(self, orders: DataFrame) -> None:
        """Replace the ledger by one of all ``orders``; it counts as batch 0."""
        rows = summed(entries(orders)).withColumn(BATCH, F.lit(0).cast("long"))
        merge.create_folders(self._ordered(rows), self.path, [FOLDER], KEY)

    def apply(self, before: DataFrame, after: DataFrame, batch: int) -> list[tuple]:
        """Add the changes of a batch, numbered from 1 in order; the months that were rewritten.

        Only months of the changed orders are read and written.  A month that has the batch, or a later
        one, already is left as it is, so a batch that was cut off can be applied again.
        """
        delta = summed(changes(before, after))
        delta = delta.filter(" or ".join(f"{name} <> 0" for name in SUMS))
        delta = self._ordered(delta.withColumn(BATCH, F.lit(batch).cast("long")))

        def add(old: DataFrame, new: DataFrame) -> DataFrame:
            known = old.groupBy(FOLDER).agg(F.max(BATCH).alias("has")).filter(F.col("has") >= batch)
            fresh = new.join(known.select(FOLDER), FOLDER, "left_anti")
            # Zero rows stay: they mark what a month has had, and no month is left without rows.
            added = old.unionByName(fresh.select(old.columns)).groupBy(*KEY, FOLDER)
            return added.agg(*[F.sum(name).alias(name) for name in SUMS], F.max(BATCH).alias(BATCH))

        return merge.merge_folders(delta, self.path, [FOLDER], add, KEY)

    def rows(self) -> DataFrame:
        """The partial sums that are not zero."""
        kinds = dict(self.spark.read.parquet(self.path).select(KEY).dtypes) | {FOLDER: "string"}
        names = [*KEY, *SUMS, BATCH, FOLDER]
        # With the schema given, a month in a folder's name stays text.
        schema = ", ".join(f"{name} {kinds.get(name, 'bigint')}" for name in names)
        return self.spark.read.schema(schema).parquet(self.path).filter("orders <> 0")

    def _ordered(self, rows: DataFrame) -> DataFrame:
        return rows.select(*KEY, *SUMS, BATCH, FOLDER)


def _spend() -> Column:
    return total_of(F.sum("total_whole"), F.sum("total_parts"))


def user_monthly_spend(rows: DataFrame) -> DataFrame:
    """Completed spend per user and month, as `customers.user_monthly_spend` of the orders."""
    month = F.nullif(F.col(FOLDER), F.lit(UNDATED))
    spend = F.when(F.sum("with_total") > 0, dollars(_spend()))
    return rows.groupBy("user_id", month.alias("txn_month")).agg(spend.alias("monthly_spend"))


def ltv_segments(rows: DataFrame, mid: float = 500.0, high: float = 2000.0) -> DataFrame:
    """Users by spend thresholds, as `customers.ltv_segments` of the orders."""
    paid = F.sum("with_total")
    per_user = rows.groupBy("user_id").agg(
        F.sum("orders").alias("order_count"),
        F.when(paid > 0, _spend()).alias("spend_cents"),
        F.when(paid > 0, cents(money_mean(_spend(), paid, 2))).alias("order_value_cents"),
        F.datediff(F.max("timestamp"), F.min("timestamp")).alias("lifespan_days"),
    )
    spend = dollars(F.col("spend_cents"))
    segment = F.when(spend > high, "High Value").when(spend > mid, "Mid Value").otherwise("Low Value")
    mean = lambda name, digits: ratio(F.sum(name), F.count(name), digits)
    money = lambda name: money_mean(F.sum(name), F.count(name), 2)
    return (
        per_user.groupBy(segment.alias("ltv_segment"))
        .agg(
            F.count("*").alias("user_count"),
            money("spend_cents").alias("avg_ltv"),
            mean("order_count", 1).alias("avg_orders"),
            money("order_value_cents").alias("avg_order_value"),
            mean("lifespan_days", 0).alias("avg_lifespan_days"),
        )
        .orderBy(F.desc("avg_ltv"), "ltv_segment")
    )


def clv_features(rows: DataFrame, digits: int | None = 2) -> DataFrame:
    """Per user orders, spend, discount and span, as `customers.clv_features` of the orders."""
    off = total_of(F.sum("discount_whole"), F.sum("discount_parts"))
    per_user = (
        rows.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.sum("with_id").alias("order_count"),
            dollars(_spend()).alias("total_spend"),
            money_mean(_spend(), F.sum("orders"), None).alias("avg_order_val"),
            dollars(off).alias("total_discount"),
            F.min("timestamp").alias("first_purchase"),
            F.max("timestamp").alias("last_purchase"),
        )
    )
    spend, less = F.col("total_spend"), F.col("total_discount")
    lifespan = whole_days_between(F.col("first_purchase"), F.col("last_purchase"))
    rate = F.lit(100.0) * less / (spend + less + F.lit(0.01))
    return per_user.withColumns(
        {
            "clv": spend,
            "lifespan_days": F.coalesce(lifespan, F.lit(0)),
            "discount_rate_pct": rounded(rate, digits),
        }
    )

