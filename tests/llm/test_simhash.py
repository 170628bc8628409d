import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from basketry.llm.graph import components
from basketry.llm.simhash import fingerprint, fingerprint_groups, simhash_groups


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def brute_groups(prints, most):
    root = {i: i for i, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in prints:
        for j, b in prints:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= most:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in prints}


@pytest.mark.parametrize("text", [None, "", "One", "One TWO", "a b c", "A  b\nc É d e a b c", "x " * 70_000])
def test_fingerprint(text):
    if text and len(text) > 1000:
        assert fingerprint(text, 3) == brute_print(text[:200])
    else:
        assert fingerprint(text, 3) == brute_print(text)


@pytest.mark.parametrize("most", [1, 2])
@pytest.mark.parametrize("crowd", [1000, 2])
def test_groups_equal_brute_force(spark, most, crowd):
    pick = random.Random(most)
    prints = []
    for i in range(150):
        value = pick.getrandbits(64) if i < 20 or pick.random() < 0.2 else pick.choice(prints)[1]
        for _ in range(pick.choice([0, 1, 2, 3])):
            value ^= 1 << pick.randrange(64)
        value &= (1 << 64) - 1
        prints.append((i, value - (1 << 64) if value >> 63 else value))
    pick.shuffle(prints)
    given = spark.createDataFrame(prints, "doc_id long, fingerprint long")
    found = fingerprint_groups(given, max_bits=most, crowd=crowd)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == brute_groups(prints, most)


def test_null_texts_are_linked_and_null_ids_never_lead(spark):
    rows = [(5, None), (3, ""), (None, "  "), (None, "quite another text of more than a few words")]
    found = simhash_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r["doc_id"], r["component_id"]) for r in found.collect()), key=str) == sorted(
        [(5, 3), (3, 3), (None, 3), (None, None)], key=str
    )


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(50)] + [(7, 7)]
    found = components(spark.createDataFrame(edges, "u long, v long"))
    roots = {r["u"]: r["root"] for r in found.collect()}
    assert roots == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(50)}
    assert found.groupBy("u").count().filter(F.col("count") > 1).isEmpty()
