import random
import re
from collections import Counter

import pytest

from basketry.llm.quality import Limits, js_distance, quality_rules

SCHEMA = "doc_id long, text string, lang string"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def test_counts_equal_brute_force(spark):
    pick = random.Random(1)
    texts = [
        "".join(pick.choice(["a ", "b ", "éè ", "c\n", "#|", "\t", "　", "d e f g h "])
                for _ in range(pick.randint(0, 60)))
        for _ in range(200)
    ]
    rows = [(i, t, "en") for i, t in enumerate([*texts, None, ""])]
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    found = quality_rules(spark.createDataFrame(rows, SCHEMA))
    found = {r[0]: tuple(r)[1:] for r in found.select("doc_id", *[f"quality.{n}" for n in names]).collect()}
    assert found == {i: brute(t) for i, t, _ in rows}


def test_a_document_far_from_its_language_goes(spark):
    pick = random.Random(2)
    plain = "the river of a town and it is on the way to that old house in the hills".split()
    rows = [(i, " ".join(pick.choices([*plain, *map(str, range(9))], k=300)), "en") for i in range(60)]
    shouted = " ".join(f"{w.upper()}{i}!!" for i, w in enumerate(pick.choices(plain, k=300)))
    listed = " ".join(pick.choices([f"item{i}" for i in range(900)], k=300))
    rows += [(100, shouted, "en"), (101, listed, "en"), (102, shouted[:300], "en")]
    limits = Limits(max_word_distance=0.35)
    kept = {r[0] for r in quality_rules(spark.createDataFrame(rows, SCHEMA), limits)
            .filter("quality.kept").select("doc_id").collect()}
    assert {100, 101} & kept == set()
    assert kept >= {*range(60), 102}  # the last is too short to be judged


def test_distance_is_zero_for_equal_and_one_for_disjoint_histograms(spark):
    row = spark.range(1).select(
        js_distance(*_arrays([3, 1], [6, 2])).alias("same"),
        js_distance(*_arrays([3, 0], [0, 2])).alias("apart"),
        js_distance(*_arrays([0, 0], [0, 2])).alias("none"),
    ).first()
    assert row["same"] == pytest.approx(0) and row["apart"] == pytest.approx(1)
    assert row["none"] is None


def _arrays(*values):
    from pyspark.sql import functions as F

    return [F.array(*[F.lit(float(x)) for x in v]) for v in values]
