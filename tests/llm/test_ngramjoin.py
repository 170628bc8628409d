import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import ngramjoin
from basketry.llm.batches import BATCH_BYTES, SLICE_BYTES, small_batches
from basketry.llm.ngramjoin import _Group, jaccard_groups, tokens_of


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 4:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[j : j + 4]) for j in range(len(words) - 3)}


def brute(rows, percent=85):
    """Rows as (id, set size, smallest id reachable), by a look at every pair that shares a shingle."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = defaultdict(list)
    for i, found in enumerate(sets):
        both = Counter(j for gram in found for j in held[gram])
        for j, n in both.items():
            if 100 * n >= percent * (len(found) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for gram in found:
            held[gram].append(i)
    least = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            least[find(i)] = min(ident, least.get(find(i), ident))
    return sorted(((ident, len(sets[i]), least.get(find(i))) for i, (ident, _) in enumerate(rows)), key=str)


def families(pick, n):
    rows, base = [], []
    for i in range(n):
        if i % 50 == 0:
            base = [f"w{pick.randrange(300)}" for _ in range(pick.choice([3, 8, 30, 120, 300]))]
        words = list(base)
        for _ in range(pick.choice([0, 0, 1, 2, 3, 6])):
            words[pick.randrange(len(words))] = f"x{pick.randrange(30)}"
        if pick.random() < 0.4:
            words += "A very common passage that many of the documents share".split() * pick.choice([1, 3])
        rows.append((i, " ".join(words)))
    return rows


def grouped(spark, rows, **sizes):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(map(tuple, jaccard_groups(df, **sizes).collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"group": 4, "large": 5}], ids=["large groups", "small groups"])
def test_equals_brute_force(spark, sizes):
    rows = families(random.Random(4), 220)
    assert grouped(spark, rows, **sizes) == brute(rows)


def test_chains_of_links_and_copies(spark):
    pick = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(30):  # each is like the one before, the last unlike the first
        words = words[3:] + [f"n{i}a", f"n{i}b", f"n{i}c"]
        rows += [(100 * i + pick.randrange(50), " ".join(words))] + [(7000 + i, " ".join(words).upper())] * 2
    found = grouped(spark, rows, group=3, large=4)
    assert found == brute(rows) and len({c for _, _, c in found}) == 1


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a b c"), (4, "a b c"), (5, "A  B\tC"), (6, "a b c d"),
        (7, "d"), (None, "D"), (None, "no id and no one like it at all"), (None, None),
        (8, " ".join(f"w{i}" for i in range(30_000))), (9, " ".join(f"w{i}" for i in range(1_000, 30_500))),
        (10, "É é a b"), (11, "é É a b"),
    ]
    assert grouped(spark, rows) == brute(rows)
    assert grouped(spark, []) == []


def test_clashing_columns_come_back(spark):
    rows = families(random.Random(6), 40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    names = "row ident mark n a b s low least counted t g part tokens component n_shingles".split()
    more = df.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in names})
    found = jaccard_groups(more)
    assert found.columns == ["doc_id", *names[:-1], "n_shingles", "component_id"]
    told = sorted((tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert told == brute(rows)
    assert {(r["doc_id"], r["tokens"]) for r in found.collect()} == {(i, f"tokens{i}") for i, _ in rows}


def test_a_group_whose_union_holds_too_little_is_not_opened():
    sets = [np.arange(10), np.arange(5, 15), np.arange(100, 120)]
    group = _Group([1, 2, 3], sets, [1, 2, 3])
    assert group.linked(np.arange(10), 85).tolist() == [0]
    assert group.linked(np.arange(11), 85).tolist() == [0]
    assert group.linked(np.array([1, 2, 3, 200, 201]), 85).tolist() == []
    group.owners = None  # an overlap would be counted from these
    assert group.linked(np.arange(500, 510), 85).tolist() == []


def test_sets_of_short_texts_are_one_shingle():
    assert len(tokens_of("one TWO three", 4)) == 1
    assert tokens_of("one TWO three", 4).tolist() == tokens_of(" ONE two\nthree", 4).tolist()
    assert tokens_of("a b", 4).tolist() != tokens_of("b a", 4).tolist()
    assert len(tokens_of("a b c d e a b c d", 4)) == 5
    assert len(tokens_of(None, 4)) == len(tokens_of(" ", 4)) == 0


def test_arrow_batches_are_small(spark, monkeypatch):
    told, kept = [], ngramjoin.checkpointed
    monkeypatch.setattr(ngramjoin, "checkpointed", lambda df: (told.append(spark.conf.get(BATCH_BYTES)), kept(df))[1])
    before = spark.conf.get(BATCH_BYTES)
    rows = families(random.Random(8), 30)
    assert grouped(spark, rows) == brute(rows)
    assert set(told) == {str(SLICE_BYTES)} and spark.conf.get(BATCH_BYTES) == before

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": pa.array([batch.nbytes], pa.int64())})

    texts = spark.range(64, numPartitions=1).select(F.repeat(F.lit("word and "), 30_000).alias("text"))
    with small_batches(spark):
        found = [r["bytes"] for r in texts.mapInArrow(sizes, "bytes long").collect()]
    assert sum(found) > 4 * SLICE_BYTES and max(found) < 2 * SLICE_BYTES
