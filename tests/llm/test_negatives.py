import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm.negatives import (
    Wanted, _panels, cluster_bounds, fit_centroids, hard_negatives, walk,
)

SCHEMA = "vec_id long, embedding array<float>, label int"
ASKS = "ident % 10 = 0"


def brute(rows, asks, positives=5, negatives=5):
    """Rows as (anchor, positive, rank, negative, scores), by a look at every pair."""
    clean = {
        (i, tuple(v), l) for i, v, l in rows
        if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    known = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], l) for i, v, l in clean]

    def best(a, keep):
        scored = [
            (-sum(x * y for x, y in zip(known[a][1], v, strict=False)), i is None, i or 0, b)
            for b, (i, v, l) in enumerate(known)
            if b != a and keep(l)
        ]
        return [(-s, None if null else i) for s, null, i, _ in sorted(scored)]

    out = []
    for a, (i, _, l) in enumerate(known):
        if i is None or not asks(i):
            continue
        for ps, p in best(a, lambda x: x == l)[:positives]:
            found = [(s, n) for s, n in best(a, lambda x: x != l) if 80 * ps <= 100 * s <= 100 * ps]
            out += [(i, p, r + 1, n, ps, s) for r, (s, n) in enumerate(found[:negatives])]
    return sorted(out, key=str)


def mined(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, hard_negatives(df, F.expr(ASKS), **sizes).collect()), key=str)


def near_rows(pick, n, copies=0):
    centres = [[pick.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(n):
        v = [x + pick.gauss(0, 0.4) for x in pick.choice(centres)]
        rows.append((i, v, pick.randrange(3)))
    same = [0.5, 0.25, -0.5, 1.0, 0.0, 0.125]
    rows += [(1000 + i, same, pick.randrange(2)) for i in range(copies)]
    return rows


@pytest.mark.parametrize(
    "sizes", [{}, {"bucket": 16, "first_round": 1, "growth": 2, "panel": 3}], ids=["one round", "rounds"]
)
def test_equals_brute_force(spark, sizes):
    rows = near_rows(random.Random(1), 120, copies=40)
    assert mined(spark, rows, **sizes) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.5, 0.5], 1), (1, [1.0, 0.0], 1), (2, [1.0], 2),
        (3, [1.0, 0.0, 0.0], 2), (4, [], 2), (None, [1.0, 0.0], 1), (None, [1.0, 0.0], 2),
        (10, None, 1), (20, [None, 1.0], 1), (30, [inf, 1.0], 1), (40, [nan, 1.0], 1),
        (50, [1.0, 1.0], None), (60, [], 2), (70, [-1.0, -1.0], 1), (5, [0.9, 0.0], 2), (6, [0.8, 0.0], 3),
    ]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_no_rows_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_other_columns_do_not_clash(spark):
    rows = near_rows(random.Random(2), 40)
    df = spark.createDataFrame(rows, SCHEMA)
    more = df.withColumns({c: F.lit(7) for c in "ident vec mark anchor panel bucket held lo hi w score".split()})
    found = sorted(map(tuple, hard_negatives(more, F.expr(ASKS)).collect()), key=str)
    assert found == brute(rows, lambda i: i % 10 == 0)


def test_inexact_scores_raise(spark):
    with pytest.raises(Exception, match="too large for exact scores"):
        mined(spark, [(0, [1e15, 1.0], 1), (1, [1e15, 1.0], 1)])


def test_bounds_hold_for_every_member_and_end_the_walk():
    pick = np.random.default_rng(3)
    members = np.round(pick.normal(size=(9, 8)) + 40 * np.eye(8)[0]) * 4
    candidates = np.round(pick.normal(size=(4000, 8)) * 40)
    centroid = fit_centroids(members, 1)[0]
    bounds = cluster_bounds(members, centroid, candidates)
    scores = members @ candidates.T
    lengths = np.linalg.norm(members, axis=1, keepdims=True)
    assert (scores <= lengths * bounds + 1e-9).all()
    none = np.zeros(0, np.int64)
    every = np.array([-np.inf]), np.array([np.inf])
    wanted = [Wanted(*every, 5, none, none, none, none.astype(bool)) for _ in members]
    idents = np.arange(len(candidates))
    taken = walk(wanted, members, bounds, candidates, idents, idents, np.ones(scores.shape, bool))
    assert taken < scores.size / 2  # the certificate ends most walks early
    for row, found in zip(scores, wanted, strict=True):
        assert found.idents.tolist() == sorted(idents, key=lambda i: (-row[i], i))[:5]


def test_panels_share_small_clusters_and_split_large_ones():
    plan, panels = _panels([(0, 2), (1, 2), (2, 11), (3, 1), (4, 4)], 4)
    assert plan == [(0, 0, 1), (1, 0, 1), (2, 1, 3), (3, 4, 1), (4, 5, 1)] and panels == 6
