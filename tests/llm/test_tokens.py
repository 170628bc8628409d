import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm.tokens import TokenIds, WordCounts, chunks, whole_tokens

BYTES, WORDS = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = (
    "a b the é ñ 's 'LL 1 23 ½ ² _ - !! Σ ΑΣ İ ß 中文 word <|endoftext|> <|startoftext|> K ﬁ Å x​y \U0001f600 ́"
).split() + [" ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "　", " \n ", " "]
IDS, COUNTS = TokenIds(BYTES), WordCounts(WORDS, whole_tokens(WORDS))
LIBRARY = {path: Tokenizer.from_file(path) for path in (BYTES, WORDS)}


def check(texts):
    wanted = LIBRARY[BYTES].encode_batch([t or "" for t in texts], add_special_tokens=False)
    for t, ids, e in zip(texts, IDS(texts), wanted, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, repr(t)
    wanted = LIBRARY[WORDS].encode_batch([t or "" for t in texts], add_special_tokens=False)
    for t, n, e in zip(texts, COUNTS(texts), wanted, strict=True):
        assert n == len(e.ids), repr(t)


def test_parts_in_any_order():
    pick = random.Random(4)
    check(["".join(pick.choices(PARTS, k=pick.randint(0, 12))) for _ in range(20_000)] + [None, "", " "])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", max_codepoint=0x2FFF), max_size=30), max_size=4))
def test_any_text(texts):
    known = lambda c: __import__("unicodedata").category(c) != "Cn"
    check(["".join(filter(known, t)) for t in texts])


def test_the_memo_may_be_dropped(monkeypatch):
    monkeypatch.setattr("basketry.llm.tokens.MEMO", 5)
    texts = [f"word{i} and {i}" for i in range(50)]
    for _ in range(3):
        check(texts)


def test_whole_tokens_are_single_tokens():
    found = sorted(whole_tokens(WORDS))
    assert len(found) > 30_000
    encoded = LIBRARY[WORDS].encode_batch(found, add_special_tokens=False)
    assert all(len(e.ids) == 1 for e in encoded)


def test_chunks_lose_only_the_space_between():
    for text in ("a b", " a", "a ", "a  b", "", " ", "a\n b \n c"):
        assert " ".join(chunks(text)) == text
