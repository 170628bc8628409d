import random
from itertools import combinations

import pytest

from basketry.operators import reach

VIEWS = "product_id string, user_id string, page_type string, timestamp timestamp_ntz"
DAYS = [f"202403{d:02d}" for d in range(1, 9)]


def views_of(spark, visits):
    rows = [(p, u, "product_detail", f"{d[:4]}-{d[4:6]}-{d[6:]} 10:00:00") for p, u, d in visits]
    rows += [("p0", "other", "home", "2024-03-02 10:00:00"), ("", "u1", "product_detail", "2024-03-02 10:00:00"),
             (None, "u1", "product_detail", "2024-03-02 10:00:00"), ("p0", "u1", "product_detail", None)]
    strings = spark.createDataFrame(rows, VIEWS.replace("timestamp timestamp_ntz", "timestamp string"))
    return strings.withColumn("timestamp", strings["timestamp"].cast("timestamp_ntz"))


def random_visits(seed, n=400):
    pick = random.Random(seed)
    users = [None, *(f"u{i}" for i in range(12))]
    return [(f"p{pick.randrange(4)}", pick.choice(users), pick.choice(DAYS)) for _ in range(n)]


def brute(visits, start, end):
    found = {p: set() for p, _, d in visits if start <= d < end}
    for p, u, d in visits:
        if start <= d < end and u is not None:
            found[p].add(u)
    return {p: len(users) for p, users in found.items()}


def counts(df):
    return {r["product_id"]: r["unique_users"] for r in df.collect()}


def test_every_range_is_a_sum_of_gaps_and_a_union_of_sketches(spark):
    visits = random_visits(1, 90) + [("alone", None, DAYS[3])]
    visitors = reach.daily_visitors(views_of(spark, visits))
    gaps = reach.visitor_gaps(visitors).persist()
    sketches = reach.daily_sketches(visitors).persist()
    for start, end in combinations([*DAYS, "20240399"], 2):
        wanted = brute(visits, start, end)
        assert counts(reach.reach_in_range(gaps, start, end)) == wanted
        if start in DAYS[::3]:
            assert counts(reach.sketched_reach(sketches, start, end)) == wanted
    assert counts(reach.reach_in_range(gaps, "20240302", "20240302")) == {}


def test_days_that_come_one_after_the_other_give_the_same_gaps(spark):
    visits = random_visits(2)
    seen, found = None, []
    for part in (DAYS[:3], DAYS[3:4], DAYS[4:]):
        visitors = reach.daily_visitors(views_of(spark, [v for v in visits if v[2] in part]))
        visitors = visitors.filter(visitors["day"].isin(part))
        found += reach.visitor_gaps(visitors, seen).collect()
        seen = spark.createDataFrame(reach.extended(visitors, seen).collect(), "product_id string, user_id string, day string")
    whole = reach.visitor_gaps(reach.daily_visitors(views_of(spark, visits))).collect()
    assert sorted(map(str, found)) == sorted(map(str, whole))


def test_gaps_hold_no_more_rows_than_pairs_of_days(spark):
    visits = [("p", f"u{i}", d) for i in range(300) for d in DAYS]
    gaps = reach.visitor_gaps(reach.daily_visitors(views_of(spark, visits)))
    assert gaps.count() == len(DAYS)


@pytest.mark.parametrize("lg_entries", [8, 12])
def test_sketches_keep_their_stated_error(spark, lg_entries):
    ids = spark.range(60_000).selectExpr("'p' AS product_id", "id AS user_id", "CAST(id % 5 AS STRING) AS day")
    again = spark.range(30_000).selectExpr("'p' AS product_id", "id AS user_id", "'3' AS day")
    sketches = reach.daily_sketches(ids.unionByName(again).distinct(), lg_entries)
    told = counts(reach.sketched_reach(sketches, "0", "9", lg_entries))["p"]
    assert abs(told - 60_000) <= 3 * 60_000 / 2 ** (lg_entries / 2)
    assert max(len(r["users"]) for r in sketches.collect()) <= 16 * 2**lg_entries + 100
