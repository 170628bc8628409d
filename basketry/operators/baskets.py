"""Products bought together.

A basket with k products has k^2/2 pairs, so before any pair is written out, products
that cannot be in a winning pair are dropped.  With any one partner a product's pairs
number at most the sum, over its baskets, of its own lines times the most lines any product
has there: its bound.  The pairs of the products with the highest bounds are counted first;
the count that the last of the best of them reaches is a count that a winner needs, and a
product with a lower bound is in no winning pair.  The result is exact for baskets of
any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.numeric import ratio
from basketry.operators.revenue import completed

#: Products whose pairs are counted first; they list at most half its square pairs a basket.
SCOUTS = 64


def product_purchase_counts(lines: DataFrame) -> DataFrame:
    """Completed lines per product."""
    return completed(lines).groupBy("product_id").agg(F.count("*").alias("purchase_count"))


def copurchase_pairs(
    lines: DataFrame,
    products: DataFrame,
    top_n: int = 10,
    min_support: int = 2,
    digits: int | None = 4,
    scouts: int = SCOUTS,
) -> DataFrame:
    """The ``top_n`` product pairs found most often in one completed transaction, with
    names and Jaccard similarity count / (purchases a + purchases b - count).

    A product repeated in a basket counts each time.  Products outside the catalog make
    no pair.  Pairs of equal count come in product order.  ``scouts`` changes what is
    counted first, not the result.
    """
    # One row per product and basket: repeats collapse before anything is paired.
    bought = (
        completed(lines)
        .filter(F.col("product_id").isNotNull())
        .groupBy("transaction_id", "product_id")
        .agg(F.count("*").alias("times"))
        .join(products.select("product_id"), "product_id", "left_semi")
    )
    paired = candidate_lines(bought, top_n, min_support, scouts)
    in_order = [F.desc("co_purchase_count"), "product_a", "product_b"]
    pairs = (
        listed_pairs(paired)
        .filter(F.col("n") >= min_support)
        .withColumnRenamed("n", "co_purchase_count")
        .orderBy(*in_order)
        .limit(top_n)
    )
    purchases = bought.groupBy("product_id").agg(F.sum("times").alias("purchase_count"))
    return described_pairs(pairs, purchases, products, digits)


def candidate_lines(
    bought: DataFrame, top_n: int, min_support: int, scouts: int = SCOUTS
) -> DataFrame:
    """Rows of ``bought`` (transaction, product, times) whose product can be in one of the
    ``top_n`` pairs, or ties with one that can."""
    basket = bought.filter(F.col("transaction_id").isNotNull())
    fullest = basket.groupBy("transaction_id").agg(
        F.max("times").alias("most_times"), F.count("*").alias("n_products")
    )
    together = basket.join(fullest.filter("n_products > 1"), "transaction_id")
    bounds = (
        together.groupBy("product_id")
        .agg(F.sum(F.col("times") * F.col("most_times")).alias("bound"))
        .filter(F.col("bound") >= min_support)
    )
    first = bounds.orderBy(F.desc("bound"), "product_id").limit(scouts)
    reached = listed_pairs(together.join(first, "product_id", "left_semi"))
    best = reached.orderBy(F.desc("n")).limit(top_n)
    # Fewer than ``top_n`` pairs of theirs say nothing about the others.
    needed = best.agg(F.when(F.count("*") == top_n, F.min("n")).alias("n")).scalar()
    needed = F.greatest(F.coalesce(needed, F.lit(0)), F.lit(min_support))
    able = bounds.filter(F.col("bound") >= needed).select("product_id")
    return together.join(able, "product_id", "left_semi").select(
        "transaction_id", "product_id", "times"
    )


def listed_pairs(basket: DataFrame) -> DataFrame:
    """Counts ``n`` of all pairs of products in one basket, each pair in product order."""
    a, b = basket.alias("a"), basket.alias("b")
    same_basket = F.col("a.transaction_id") == F.col("b.transaction_id")
    in_order = F.col("a.product_id") < F.col("b.product_id")
    return (
        a.join(b, same_basket & in_order)
        .groupBy(
            F.col("a.product_id").alias("product_a"), F.col("b.product_id").alias("product_b")
        )
        .agg(F.sum(F.col("a.times") * F.col("b.times")).alias("n"))
    )


def described_pairs(
    pairs: DataFrame, counts: DataFrame, products: DataFrame, digits: int | None
) -> DataFrame:
    """The chosen pairs with names and similarity."""
    for side in ("a", "b"):
        key = f"product_{side}"
        purchases = counts.select(
            F.col("product_id").alias(key), F.col("purchase_count").alias(f"purchases_{side}")
        )
        names = products.select(
            F.col("product_id").alias(key), F.col("name").alias(f"name_{side}")
        )
        pairs = pairs.join(purchases, key).join(names, key)
    together = F.col("co_purchase_count")
    either = F.col("purchases_a") + F.col("purchases_b") - together
    return pairs.select(
        "product_a",
        "name_a",
        "product_b",
        "name_b",
        "co_purchase_count",
        ratio(together, either, digits).alias("jaccard_similarity"),
    ).orderBy(F.desc("co_purchase_count"), "product_a", "product_b")
