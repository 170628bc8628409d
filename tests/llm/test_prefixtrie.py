import hashlib
import random
import re
from collections import defaultdict
from math import fmod
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from basketry.llm.prefixtrie import conversation_trie, ends_hashes, sweep

HEAD, BASE = "crc32(cast(conv AS string)) % 4", "conv - conv % 20"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    held = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            held[c].append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(found)] for c, found in held.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, found in sorted(turns.items()):
        h = crc32(str(c).encode()) % 4
        whole = turns.get(c - int(fmod(c, 20)), [])[:h] + found[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ends[tuple(whole)].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[x] for x in children[path]) or 1
        saved[path] = sum(saved[x] for x in children[path]) + (len(members[path]) - 1) * words
    digest = lambda path: hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest()
    return sorted(
        (
            (found[0], len(path), members[path[:-1]][0] if path else None, len(found),
             len(children[path]), leaves[path], saved[path], digest(path))
            for path, found in members.items()
        ),
        key=str,
    )


def nodes(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, conversation_trie(df, F.expr(HEAD), F.expr(BASE), **sizes).collect()), key=str)


def odd_rows():
    pick = random.Random(5)
    return [
        (
            pick.choice([None, *range(-30, 60)]), pick.choice([None, *range(8)]),
            pick.choice(["user", "assistant", None]), pick.choice(["x", "y z", None, " "]),
        )
        for _ in range(500)
    ]


def long_rows():
    """Two long conversations that part late, a short one, and turnless ones."""
    long = [(c, i, "user", "w " * (i % 5)) for c, n in ((20, 600), (40, 700)) for i in range(n)]
    return long + [(41, i, "user", "w") for i in range(3)] + [(c, 0, "user", "w") for c in range(61, 80)]


@pytest.mark.parametrize("burst", [10_000, 5])
@pytest.mark.parametrize("rows", [odd_rows(), long_rows()], ids=["odd", "long"])
def test_equals_brute_force(spark, rows, burst):
    assert nodes(spark, rows, burst=burst) == brute(rows)


def test_one_first_turn_and_thousands_of_copies(spark):
    rows = [(c, t, "user", ["hello", "a b", f"c {c % 3}"][t]) for c in range(0, 60_000, 20) for t in range(3)]
    assert nodes(spark, rows, burst=50) == brute(rows)


def test_small_and_empty_tables(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 0, "user", "x")]) == []
    for rows in ([(5, 0, "user", "a b")], [(20, 0, None, None)], [(c, 0, "user", "x") for c in (21, 22, 24)]):
        assert nodes(spark, rows) == brute(rows)


def test_other_columns_do_not_clash(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    more = df.withColumns({c: F.lit("z") for c in "conv seq a b words block rep top depth path h n".split()})
    assert sorted(map(tuple, conversation_trie(more, F.expr(HEAD), F.expr(BASE)).collect()), key=str) == brute(rows)


def test_ends_are_joined_in_numeric_order_over_ranges(spark):
    ids = sorted({*range(-3000, 3000, 7), 10**12, -(10**12), 9, 10, 100})
    rows = [(i, 1) for i in ids] + [(5_000_000, 2), (6, 3), (7, 3)]
    given = spark.createDataFrame(rows, "conv long, rep long").repartition(4)
    told = {r["rep"]: r["ends_sha256"] for r in ends_hashes(given).collect()}
    text = lambda found: hashlib.sha256(",".join(map(str, found)).encode()).hexdigest()
    assert told == {1: text(ids), 2: text([5_000_000]), 3: text([6, 7])}


def test_sweep_closes_nodes_once():
    a, b, c = (1, 1), (2, 2), (3, 3)
    found = sweep([((a, b), 4, 2, [1, 10]), ((a,), 9, 1, [1]), ((a, c, b), 2, 1, [1, 5, 7])], 3, 0)
    assert sorted(found) == [
        (2, 3, 0, 4, 2, 2, 13, 9), (2, 4, 2, 1, 1, 1, 0, None), (2, 5, 2, 1, 0, 1, 0, 2),
        (4, 4, 2, 2, 0, 1, 10, 4),
    ]
