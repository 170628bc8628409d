import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from basketry.operators import pairs
from checks import registry
from tests.test_baskets import brute_force, catalog_of, lines_of


def found(spark, contents, catalog, **options):
    result = pairs.copurchase_pairs(lines_of(spark, contents), catalog_of(spark, catalog), **options)
    return [
        (r.product_a, r.product_b, r.co_purchase_count, pytest.approx(r.jaccard_similarity, abs=1e-4))
        for r in result.collect()
    ]


def counted(spark, contents, share):
    rows = [(t, p, n) for t, held in contents.items() for p, n in Counter(held).items()]
    df = spark.createDataFrame(rows, "transaction_id string, product_id int, times bigint")
    often = df.groupBy("product_id").count().filter(F.col("count") * share >= len(contents))
    often = often if share > 1 else None
    return {(r.product_a, r.product_b): r.n for r in pairs.pair_counts(df, len(contents), often).collect()}


def brute_counts(contents):
    both = Counter()
    for held in contents.values():
        both.update((a, b) for a, b in combinations(sorted(held), 2) if a != b)
    return dict(both)


@pytest.mark.parametrize("share", [1, 8, 10**6], ids=["light", "both", "heavy"])
def test_counts_equal_brute_force_however_they_are_made(spark, monkeypatch, share):
    monkeypatch.setattr(pairs, "BLOCK", 128)
    pick = random.Random(share)
    contents = {
        f"t{i}": [p for p in range(30) if pick.random() < (0.5 if p < 6 else 0.04) for _ in range(pick.choice([1, 1, 1, 2, 5]))]
        for i in range(700)
    }
    assert counted(spark, contents, share) == brute_counts(contents)


@pytest.mark.parametrize("heavy", [8, 2000])
def test_winners_among_heavy_products(spark, monkeypatch, heavy):
    monkeypatch.setattr(pairs, "HEAVY", heavy)
    pick = random.Random(heavy)
    contents = {f"t{i}": [p for p in range(40) if pick.random() < (0.4 if p < 5 else 0.03)] for i in range(900)}
    assert found(spark, contents, set(range(40)), first=4) == brute_force(contents, set(range(40)), 10, 2)


@pytest.mark.parametrize("seed", range(3))
def test_winners_equal_brute_force(spark, seed):
    pick = random.Random(seed)
    catalog = set(range(60)) - {5}
    contents = {f"s{i}": pick.choices(range(60), k=pick.randint(1, 5)) for i in range(150)}
    contents |= {f"big{i}": pick.sample(range(60), 25) for i in range(4)}
    for top_n, first in ((10, 2), (1, 64)):
        assert found(spark, contents, catalog, top_n=top_n, first=first) == brute_force(contents, catalog, top_n, 2)


def test_rounds_raise_the_threshold_to_the_same_winners(spark, monkeypatch):
    monkeypatch.setattr(pairs, "AT_ONCE", 0)  # never all at once
    contents = {f"large{i}": list(range(1000 + 60 * i, 1060 + 60 * i)) for i in range(20)}
    contents |= {f"t{i}": [1, 2, 3 + i % 3] for i in range(12)}
    catalog = {p for products in contents.values() for p in products}
    assert found(spark, contents, catalog, top_n=3, first=2) == brute_force(contents, catalog, 3, 2)


def test_no_lines_give_no_pairs(spark):
    assert found(spark, {}, {1, 2}) == []
    assert found(spark, {"t": [1]}, {1, 2}) == []


def test_baskets_that_share_two_thousand_products_list_no_squares(spark):
    """Eighty baskets of the same 2,000 products hold 160 million pairs of rows."""
    ids = spark.range(80 * 2000).selectExpr(
        "CAST(id div 2000 AS STRING) AS transaction_id", "CAST(id % 2000 AS INT) AS product_id", "1L AS times"
    )
    maps = pairs._dense(pairs._bit_maps(ids, 80))
    assert maps.count() == 2000 and maps.agg(F.max(F.size("words"))).first()[0] == 2
    told = pairs._heavy_pairs(ids, 80).agg(F.count("*"), F.min("n"), F.max("n")).first()
    assert tuple(told) == (2000 * 1999 // 2, 80, 80)


def test_lines_are_scanned_once(spark, monkeypatch):
    plans = []
    write = pairs.stored
    keep = lambda df, name: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, name))[1]
    monkeypatch.setattr(pairs, "stored", keep)
    query = registry.queries()["copurchase_pairs"](spark, "/root/testdata/sf0.001")
    plans.append(query._jdf.queryExecution().optimizedPlan().toString())
    assert sum(plan.count("l_orderkey") > 0 for plan in plans) == 1
    assert "lineitem" not in query._jdf.queryExecution().executedPlan().toString()
