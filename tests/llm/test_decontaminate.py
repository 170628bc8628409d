import random
import re

import pytest
from pyspark.sql import functions as F

from basketry.llm.decontaminate import decontaminate, without_spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for a in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + size]), set()).add(str(item))
    found = {}
    for ident, text in docs:
        w, hit, who = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for a in range(len(w) - size + 1):
                if tuple(w[a : a + size]) in windows:
                    hit.update(range(a, a + size))
                    who |= windows[tuple(w[a : a + size])]
        found[ident] = (len(w), len(hit), sorted(who))
    return found


def tables(seed):
    pick = random.Random(seed)
    some = lambda n: [pick.choice(["Alpha", "beta", "ΓÉ", "x1", "y", "Zed", "the"]) for _ in range(n)]
    items = [(i, pick.choice([" ", ", ", "\n"]).join(some(pick.choice([0, 1, 3, 9, 10, 14, 25])))) for i in range(12)]
    items = [x for x in items if len(words(x[1])) != 1] + [(50, None), (51, "..."), (52, items[0][1])]
    docs = []
    for i in range(80):
        parts = [" ".join(some(pick.randint(0, 20)) + ["other"]) for _ in range(3)]
        if i % 2:
            parts.insert(1, pick.choice(items)[1] or "")
        docs.append((i, "-".join(parts)))
    return docs, items


@pytest.mark.parametrize("block_bytes", [8 << 20, 60])
def test_equals_brute_force(spark, block_bytes):
    docs, items = tables(5)
    found = decontaminate(
        spark.createDataFrame([*docs, (900, None)], "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        block_bytes=block_bytes,
    )
    rows = found.select("doc_id", "leak.n_words", "leak.n_hit", "leak.items").collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == brute([*docs, (900, None)], items)


def test_spans_are_cut_and_the_rest_stays(spark):
    text = "É before, One TWO-three four; five six seven eight nine ten eleven. after\n"
    docs = spark.createDataFrame([(1, text), (2, "nothing here")], "doc_id long, text string")
    item = "one two three four five six seven eight nine ten"
    found = decontaminate(docs, spark.createDataFrame([("a", item)], "item_id string, text string"))
    cut = found.withColumn("text", without_spans(F.col("text"), F.col("leak.spans")))
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {
        1: "É before,  eleven. after\n",
        2: "nothing here",
    }
