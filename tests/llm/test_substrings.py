import random

import pyarrow as pa
import pytest

from basketry.llm import substrings
from basketry.llm.batches import BATCH_BYTES, SLICE_BYTES
from basketry.llm.common import Workspace
from basketry.llm.substrings import WINDOW, substring_dedup


def brute(rows):
    first, words = {}, {i: (t or "").encode().split() for i, t in rows}
    for i in sorted(words):
        for a in range(len(words[i]) - WINDOW + 1):
            first.setdefault(tuple(words[i][a : a + WINDOW]), (i, a))
    found = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for a in range(len(w) - WINDOW + 1):
            if first[tuple(w[a : a + WINDOW])] < (i, a):
                gone[a : a + WINDOW] = [True] * WINDOW
        found[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return found


def documents(seed):
    pick = random.Random(seed)
    base = [[pick.choice("abcdefg") for _ in range(pick.randint(20, 60))] for _ in range(5)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(pick.randint(0, 4)):
            words += pick.choice([
                pick.choice(base), ["the"] * pick.randint(1, 70), [pick.choice("abc") for _ in range(25)],
                [f"{pick.random()}"], pick.choice(base)[3:], pick.choice(base) * 2,
            ])
        rows.append((i * 7 % 60, pick.choice([" ", "\n", "\t "]).join(words)))
    return rows


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("crowd", [20_000, 3])
def test_equals_brute_force(spark, seed, crowd):
    rows = [*documents(seed), (100, None), (101, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = substring_dedup(docs, crowd=crowd, shard_words=300)
    assert {r["doc_id"]: tuple(r)[2:] for r in found.collect()} == brute(rows)


def test_a_null_id_is_before_all_others(spark):
    text = " ".join(f"w{i}" for i in range(30))
    found = substring_dedup(spark.createDataFrame([(1, text), (None, text)], "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in found.collect()} == {None: 0, 1: 30}


def test_a_step_goes_when_the_next_is_there_and_crowded_anchors_move_no_words(spark, monkeypatch):
    steps, plans, store, drop = [], [], Workspace.store, Workspace.drop

    def stored(self, df, table):
        steps.append(table)
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        assert spark.conf.get(BATCH_BYTES) == str(SLICE_BYTES)
        return store(self, df, table)

    def dropped(self, *tables):
        steps.extend(f"-{table}" for table in tables)
        return drop(self, *tables)

    monkeypatch.setattr(Workspace, "store", stored)
    monkeypatch.setattr(Workspace, "drop", dropped)
    sizes = spark.conf.get(BATCH_BYTES)
    databases = spark.sql("SHOW DATABASES").collect()
    rows = documents(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    smallest = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = substring_dedup(docs, crowd=3, shard_words=300)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", smallest)
    assert steps == ["repeated", "distinct_segments", "firsts", "firsts", "-distinct_segments"]
    for plan, kind in zip(plans[2:], ("LeftAnti", "LeftSemi"), strict=True):
        joins = [line for line in plan.splitlines() if kind in line]
        assert joins and all("BroadcastHashJoin" in line for line in joins)
    assert spark.sql("SHOW DATABASES").collect() == databases
    assert spark.conf.get(BATCH_BYTES) == sizes
    assert {r["doc_id"]: tuple(r)[2:] for r in found.collect()} == brute(rows)


def test_words_of_a_batch_are_split_and_hashed_together(monkeypatch):
    texts = [" two  words ", None, "", " \t\n", "a\x0bb\x0cc\x1cd\x85\u3000e\u00a0f\r\ng", "two " * 40, "x" * 9]
    sizes, words = substrings.split_words(pa.array([*texts, "not these"]).slice(0, len(texts)))
    known = [substrings.words_of(t) for t in texts]
    assert sizes.tolist() == list(map(len, known))
    assert [w.encode() for w in words.to_pylist()] == [w for held in known for w in held]
    hashed, digest = [], substrings.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(substrings.xxhash, "xxh3_64_intdigest", lambda w: (hashed.append(w), digest(w))[1])
    hashes = substrings.word_hashes(words)
    assert hashes.tolist() == [digest(w) for held in known for w in held]
    assert len(hashed) == len({w for held in known for w in held})
    sizes, words = substrings.split_words(pa.array([None, ""], pa.string()))
    assert sizes.tolist() == [0, 0] and len(words) == 0
    assert substrings.split_words(pa.array([], pa.string()))[0].tolist() == []
