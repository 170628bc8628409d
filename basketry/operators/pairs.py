"""Products bought together, counted from baskets that are stored once.

The lines are read once: baskets are written to the shared folder, a row for each product in
one, and everything else reads those rows.

* **Rounds.** The products of the highest bounds (see `operators.baskets`) are paired first.
  The count of the last of their best pairs is what a winner needs, so products with a lower
  bound drop out; then more products are paired, until all that can still win were.
* **Heavy products**, those in an eighth of the baskets or more, are not listed pair by pair.
  Baskets are numbered within blocks, a heavy product is a bit map over each block's baskets,
  and a pair is counted 64 baskets at a time.  Products that come several times in a basket have
  a bit map for every binary digit of that number.
* **Light products** are joined with the products of their baskets, so a basket lists its
  light ones times all, and never heavy ones times heavy ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from basketry.operators.baskets import described_pairs
from basketry.operators.revenue import completed
from basketry.sources.shared import stored

#: Products of the first round, and how many times as many come in the next.
FIRST, GROWTH = 64, 16
#: Listed rows, for each row of the baskets, up to which all that are left are paired at once.
AT_ONCE = 8
#: A product in one of so many baskets, or more, is heavy.
HEAVY = 8
#: Baskets of a block, a multiple of 64.
BLOCK = 4096


@dataclass
class Baskets:
    """``bought``: transaction, product and times, of products in the catalog, also of single ones;
    ``together``: those of baskets with several products, ``number`` baskets in ``rows`` rows."""

    bought: DataFrame
    together: DataFrame
    rows: int
    number: int


def stored_baskets(lines: DataFrame, products: DataFrame) -> Baskets:
    """The completed baskets of ``lines``, written once."""
    bought = stored(
        completed(lines)
        .filter(F.col("product_id").isNotNull())
        .groupBy("transaction_id", "product_id")
        .agg(F.count("*").alias("times"))
        .join(products.select("product_id"), "product_id", "left_semi"),
        "bought",
    )
    basket = bought.filter(F.col("transaction_id").isNotNull())
    several = basket.groupBy("transaction_id").agg(
        F.max("times").alias("most_times"), F.count("*").alias("n_products")
    )
    together = basket.join(several.filter("n_products > 1"), "transaction_id")
    seen = Observation("together")
    together = together.observe(
        seen, F.count("*").alias("rows"), F.sum(F.lit(1.0) / F.col("n_products")).alias("number")
    )
    together = stored(together, "together")
    return Baskets(bought, together, seen.get["rows"], round(seen.get["number"] or 0))


def _bit_maps(heavy: DataFrame, baskets: int) -> DataFrame:
    """``block``, ``product_id``, ``digit`` and its ``words``: a bit for each basket of the block in which
    the product's times have that binary digit."""
    blocks = baskets // BLOCK + 1
    ids = heavy.select("transaction_id").distinct()
    ids = ids.withColumn("block", F.pmod(F.xxhash64("transaction_id"), F.lit(blocks)))
    place = F.row_number().over(Window.partitionBy("block").orderBy("transaction_id")) - 1
    numbered = ids.withColumn("place", place)  # about BLOCK rows in a window
    digits = F.filter(
        F.sequence(F.lit(0), F.lit(62)), lambda d: F.col("times").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), d)) != 0
    )
    bits = (
        heavy.join(numbered, "transaction_id")
        .select("block", "product_id", F.explode(digits).alias("digit"), F.floor(F.col("place") / 64).alias("word"),
                F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int")).alias("bit"))
        .groupBy("block", "product_id", "digit", "word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    return bits.groupBy("block", "product_id", "digit").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words")
    )


def _heavy_pairs(heavy: DataFrame, baskets: int) -> DataFrame:
    """``product_a``, ``product_b`` and their count ``n`` for pairs of heavy products."""
    maps = stored(_dense(_bit_maps(heavy, baskets)), "bit-maps")
    a, b = maps.alias("a"), maps.alias("b")
    in_order = F.col("a.product_id") < F.col("b.product_id")
    both = F.aggregate(
        F.zip_with("a.words", "b.words", lambda x, y: F.bit_count(x.bitwiseAND(y)).cast("bigint")),
        F.lit(0).cast("bigint"), lambda sum, n: sum + n,
    )
    weight = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("a.digit") + F.col("b.digit")).cast("int"))
    return (
        a.join(b, (F.col("a.block") == F.col("b.block")) & in_order)
        .groupBy(F.col("a.product_id").alias("product_a"), F.col("b.product_id").alias("product_b"))
        .agg(F.sum(both * weight).alias("n"))
        .filter("n > 0")
    )


def _dense(maps: DataFrame) -> DataFrame:
    """Words in order, from a block's first to the last that any of its products has."""
    last = maps.groupBy(F.col("block").alias("of")).agg(F.max(F.array_max(F.map_keys("words"))).alias("last"))
    words = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("last")),
        lambda w: F.coalesce(F.try_element_at("words", w), F.lit(0).cast("bigint")),
    )
    return maps.join(last, F.col("block") == F.col("of")).select(
        "block", "product_id", "digit", words.alias("words")
    )


def _light_pairs(light: DataFrame, rest: DataFrame) -> DataFrame:
    """Counts of pairs of a light product and any other; ``light`` and ``rest`` are rows of baskets."""
    same = F.col("a.transaction_id") == F.col("b.transaction_id")
    # Of two light products each pair is listed once, and none of two heavy ones is.
    once = (F.col("a.product_id") < F.col("b.product_id")) | (
        F.col("b.heavy") & (F.col("a.product_id") != F.col("b.product_id"))
    )
    pairs = light.alias("a").join(rest.alias("b"), same & once)
    low, high = F.least("a.product_id", "b.product_id"), F.greatest("a.product_id", "b.product_id")
    return pairs.groupBy(low.alias("product_a"), high.alias("product_b")).agg(
        F.sum(F.col("a.times") * F.col("b.times")).alias("n")
    )


def pair_counts(
    rows: DataFrame, number: int, often: DataFrame | None = None
) -> DataFrame:
    """``product_a``, ``product_b`` and ``n``, the pairs of lines, for all products of ``rows``
    (transaction, product, times) that share a basket.  ``often`` has the ``product_id`` of heavy ones,
    ``number`` is about that of the baskets."""
    rows = rows.select("transaction_id", "product_id", "times")
    if often is None:
        marked = rows.withColumn("heavy", F.lit(False))
        return _light_pairs(marked, marked)
    known = often.select("product_id", F.lit(True).alias("heavy"))
    marked = rows.join(known, "product_id", "left")
    marked = stored(marked.withColumn("heavy", F.coalesce("heavy", F.lit(False))), "marked")
    light = _light_pairs(marked.filter("not heavy"), marked)
    return light.unionByName(_heavy_pairs(marked.filter("heavy"), number))


def best_pairs(
    baskets: Baskets, top_n: int, min_support: int, first: int = FIRST, growth: int = GROWTH
) -> DataFrame:
    """The ``top_n`` pairs of the highest counts, from ``min_support`` on, ties in product order."""
    together = baskets.together
    bounds = together.groupBy("product_id").agg(
        F.sum(F.col("times") * F.col("most_times")).alias("bound"),
        F.count("*").alias("held"),
        F.sum(F.col("n_products") - 1).alias("listed"),
    )
    bounds = stored(bounds, "bounds")
    # At most HEAVY times the mean size of a basket are heavy.
    often = bounds.filter(F.col("held") * HEAVY >= max(baskets.number, 64 * HEAVY))
    order = [F.desc("n"), "product_a", "product_b"]
    needed, taken = min_support, first
    while True:
        able = bounds.filter(F.col("bound") >= needed)
        left = able.agg(
            F.count("*").alias("products"),
            (F.coalesce(F.sum("listed"), F.lit(0)) / 2).alias("pairs"),
            F.count_if(F.col("held") * HEAVY >= max(baskets.number, 64 * HEAVY)).alias("heavy"),
        ).first()
        whole = taken >= left["products"] or (
            taken > first and left["pairs"] <= AT_ONCE * baskets.rows
        )
        if not whole:
            able = able.orderBy(F.desc("bound"), "product_id").limit(taken)
        chosen = together.join(able.select("product_id"), "product_id", "left_semi")
        counts = pair_counts(chosen, baskets.number, often if left["heavy"] else None)
        best = counts.filter(F.col("n") >= needed).orderBy(*order).limit(top_n)
        if whole:
            return best
        found = [row["n"] for row in best.collect()]  # top_n rows
        if len(found) == top_n:
            needed = max(needed, found[-1])
        taken *= growth


def copurchase_pairs(
    lines: DataFrame,
    products: DataFrame,
    top_n: int = 10,
    min_support: int = 2,
    digits: int | None = 4,
    first: int = FIRST,
) -> DataFrame:
    """`operators.baskets.copurchase_pairs`, with the same rows, from baskets that are stored.

    Building it runs jobs: it stores the baskets and raises the count that a winner needs.
    """
    baskets = stored_baskets(lines, products)
    pairs = best_pairs(baskets, top_n, min_support, first)
    purchases = baskets.bought.groupBy("product_id").agg(F.sum("times").alias("purchase_count"))
    return described_pairs(
        pairs.withColumnRenamed("n", "co_purchase_count"), purchases, products, digits
    )
