"""Registered queries that SQL cannot express, over whole tables, against plain Python."""

import re
import zlib
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketry.llm import queries
from tests.llm.test_simhash import brute_groups, brute_print

TABLES = "/root/testdata/sf0.001"
QUERIES = queries.queries()


def rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, TABLES).collect()]


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}


def tokenizer(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def test_every_operator_is_checked_somewhere():
    here = {"op5_best_fit_packing", "op6_token_counts", "op7_kd_tree_shards", "op8_main_text", "op10_simhash"}
    assert set(QUERIES) == here | set(queries.oracle_sql())


def test_op5_pieces_fill_sequences_without_gaps(spark, documents):
    encoder = tokenizer(queries.PACKED_BY)
    found = rows(spark, "op5_best_fit_packing")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(documents)
    for ident, text in documents.items():
        ids = np.array([*encoder.encode(text, add_special_tokens=False).ids, 0], "<u4")
        held = sorted(pieces[ident], key=lambda r: r["piece"])
        assert [r["piece"] for r in held] == list(range(len(held)))
        assert [r["start"] for r in held] == [sum(x["length"] for x in held[:i]) for i in range(len(held))]
        assert sum(r["length"] for r in held) == len(ids)
        assert len(held) == 1 or all(r["length"] == 2048 for r in held[1:])
        for r in held:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(r["length"] for r in found) // 2048)
    assert least <= len(sequences) <= least + 1


def test_op6_counts_what_the_library_counts(spark, documents):
    encoder = tokenizer(queries.COUNTED_BY)
    for r in rows(spark, "op6_token_counts"):
        text = documents[r["doc_id"]]
        n = len(encoder.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)


def test_op7_shards_are_near_equal_and_gapless(spark, documents):
    found = rows(spark, "op7_kd_tree_shards")
    assert sorted(r["doc_id"] for r in found) == sorted(documents)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in found:
        data = documents[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (
            len(data) + 16, zlib.crc32(data), "bytes", None,
        )
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) <= set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, largest = sum(sizes.values()) / 40, max(r["size"] for r in found)
    assert max(sizes.values()) <= mean + largest  # five documents a shard here


class _Article(HTMLParser):
    """Text of the one article of a page of these tables, adverts left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.text, self.inside, self.out = [], "", False, 0

    def flush(self):
        if text := " ".join(self.text.split()):
            self.blocks.append(text)
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        elif tag == "br":
            self.text += " "
        elif tag == "div" and self.inside and ("class", "ad") in attrs:
            self.out += 1
        if tag not in ("b", "br"):
            self.flush()

    def handle_endtag(self, tag):
        if tag == "b":
            return
        self.flush()
        if tag == "div" and self.out:
            self.out -= 1
        self.inside &= tag != "article"

    def handle_data(self, data):
        if self.inside and not self.out:
            self.text += data


def test_op8_is_the_article(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{TABLES}/pages.parquet").collect()}
    found = rows(spark, "op8_main_text")
    assert len(found) == len(pages)
    for r in found:
        reader = _Article()
        reader.feed(pages[r["page_id"]] or "")
        reader.close()
        reader.flush()
        assert r["text"] == "\n\n".join(reader.blocks)
        assert r["n_chars"] == len(r["text"])


def test_op10_fingerprints_and_groups(spark, documents):
    prints = {i: brute_print(t) for i, t in documents.items()}
    wanted = brute_groups(sorted(prints.items()), 2)
    for r in rows(spark, "op10_simhash"):
        assert re.fullmatch("[0-9a-f]{16}", r["fingerprint"])
        assert int(r["fingerprint"], 16) == prints[r["doc_id"]] % (1 << 64)
        assert r["component_id"] == wanted[r["doc_id"]]
