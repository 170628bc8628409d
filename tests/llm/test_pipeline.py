"""The stages over a small table against plain Python."""

from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_decontaminate, test_lines, test_quality, test_simhash

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage was given and gave."""
    folder = tmp_path_factory.mktemp("stages")
    docs, kept = spark.read.parquet(f"{TABLES}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, TABLES).write.parquet(f"{folder}/{number}")
        kept.append((docs.collect(), spark.read.parquet(f"{folder}/{number}")))
        docs = kept[-1][1]
    return [(given, after.columns, after.collect()) for given, after in kept]


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_all_but_the_last_return_documents(steps):
    for _, columns, rows in steps[:-1]:
        assert columns == corpus_pipeline.COLUMNS
        assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_quality_drops_what_fails(steps):
    given, _, rows = steps[0]
    passing = {r["doc_id"] for r in given if not test_quality.brute(r["text"])[-1]}
    assert texts(rows).keys() <= passing
    assert len(rows) > 0.9 * len(passing)


def test_boilerplate_lines_go(steps):
    given, _, rows = steps[1]
    wanted = test_lines.brute([(r["doc_id"], r["source"], r["text"]) for r in given], 0.1, 3)
    assert texts(rows) == wanted


def test_one_document_of_each_group_stays(steps):
    given, _, rows = steps[2]
    prints = [(r["doc_id"], test_simhash.brute_print(r["text"])) for r in given]
    groups = test_simhash.brute_groups(prints, 2)
    assert sorted(texts(rows)) == sorted(set(groups.values()))
    assert all(texts(given)[i] == t for i, t in texts(rows).items())


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    pick = np.random.default_rng(3)
    a, b, c, d = (" ".join(pick.choice(list("abcdefghijklmnopqrstuvwxyz"), 200)) for _ in range(4))
    rows = [(5, a), (5, b), (9, b), (5, c), (5, c + " "), (None, d), (None, d), (None, c), (None, d)]
    rows = [(i, text, "en", "s", len(text)) for i, text in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for given in (rows, rows[::-1]):
        kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(given, schema).repartition(3), TABLES)
        found = sorted((r["doc_id"] or 0, r["text"].strip()) for r in kept.collect())
        assert found == sorted([(5, a), (5, b), (5, c), (0, d)])


def test_no_benchmark_passage_is_left(spark, steps):
    given, _, rows = steps[3]
    items = [tuple(r) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").select("item_id", "text").collect()]
    before = test_decontaminate.brute([(r["doc_id"], r["text"]) for r in given], items)
    after = test_decontaminate.brute([(r["doc_id"], r["text"]) for r in rows], items)
    for ident, (size, hit, _) in before.items():
        if 0 < size == hit:
            assert ident not in after
        else:
            assert after[ident][0] == size - hit
    assert not any(hit for _, hit, _ in after.values())


def test_every_piece_is_packed(steps):
    given, _, rows = steps[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes, held = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r["doc_id"]] += r["length"]
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sizes == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts(given).items()}
    for parts in held.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts[:-1])]).tolist()
        assert sum(n for _, n in parts) <= 2048
    assert len(held) <= 1.05 * sum(sizes.values()) / 2048 + 1
