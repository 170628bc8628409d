"""Token ids and counts of whole texts by public tokenizers, with what words share kept.

Both tokenizers cut a text into pre-tokens before they merge, and no pre-token reaches
over the border before a space that a non-space follows.  So a text is cut at those spaces,
and each distinct chunk is encoded once per batch by the library; a bounded memo, local to
the worker, keeps chunks for later batches.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from basketry.llm.batches import map_slices, replaced

#: Chunks a worker remembers; beyond that it starts anew, which changes no result.
MEMO = 300_000
#: How byte-level BPE cuts texts into pre-tokens; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BORDER = re.compile(r" (?=\S)")
_OTHER_SPACE = re.compile(r" (?!\S)")


def chunks(text: str) -> list[str]:
    """``text`` cut before every space that a character other than white space follows; the space
    is left out of all chunks but the first."""
    return _BORDER.split(text) if _OTHER_SPACE.search(text) else text.split(" ")


class _Chunks(dict):
    """What ``encode`` gives for chunks, those met so far remembered."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        self[chunk] = ids = self.encode(f" {chunk}")
        return ids


class TokenIds:
    """Ids of a byte-level BPE tokenizer, as little-endian unsigned 32-bit integers.

    Where the file's merges are numbered as its vocabulary, which is checked, ranks say all
    there is to say, and single chunks are merged by a quicker library with the same result.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        model = json.loads(self.tokenizer.to_str())["model"]
        to_byte = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(map(to_byte.__getitem__, t)): i for t, i in model["vocab"].items()}
        merged = ["".join(pair) for pair in model["merges"]]
        ranked = [model["vocab"].get(t) for t in merged] == list(range(256, 256 + len(merged)))
        self.quick = ranked and tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.memo = _Chunks(self._plain)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special strings."""
        if not self.quick:
            return self._whole(text)
        return np.array(self.quick.encode_ordinary(text), "<u4").tobytes()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        return [self._ids(t) if t else b"" for t in texts]

    def _ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._whole(text)
        head, *rest = chunks(text)
        return self._plain(head) + b"".join(map(self.memo.__getitem__, rest))


class WordCounts:
    """Numbers of tokens of a word-end BPE tokenizer that lower-cases and drops white space."""

    _pretoken = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str, whole: frozenset[str]) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = whole
        self.memo: dict[str, int] = {}
        self.merged: dict[str, int] = {}

    @classmethod
    def pretokens(cls, text: str) -> list[str]:
        lower = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return cls._pretoken.findall(lower)

    def _lengths(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str | None]) -> list[int]:
        memo, merged, whole = self.memo, self.merged, self.whole
        for held in (memo, merged):
            if len(held) > MEMO:
                held.clear()
        odd = [i for i, t in enumerate(texts) if t and any(s in t for s in self.special)]
        plain = dict.fromkeys(odd)
        cut = [[] if not t or i in plain else t.split(" ") for i, t in enumerate(texts)]
        seen: set[str] = set()
        for parts in cut:
            seen.update(parts)
        new = [(c, self.pretokens(c)) for c in seen if c not in memo]
        rest = {p for _, found in new for p in found if p not in whole and p not in merged}
        merged.update(zip(rest, self._lengths(list(rest)), strict=True))
        for c, found in new:
            memo[c] = sum(1 if p in whole else merged[p] for p in found)
        counts = [sum(map(memo.__getitem__, parts)) for parts in cut]
        for i, n in zip(odd, self._lengths([texts[i] for i in odd]), strict=True):
            counts[i] = n
        return counts


def whole_tokens(path: str) -> frozenset[str]:
    """Pre-tokens that the tokenizer encodes alone as one token, each proved by encoding it.

    There are at most as many as the vocabulary has entries.
    """
    tokenizer = Tokenizer.from_file(path)
    ends = json.loads(tokenizer.to_str())["model"]["end_of_word_suffix"]
    to_byte = {c: b for b, c in _byte_letters().items()}
    found = []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        if not entry.endswith(ends):
            continue
        letters = entry.removesuffix(ends)
        try:
            word = bytes(to_byte[c] for c in letters).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if WordCounts.pretokens(word) == [word]:
            found.append(word)
    encoded = tokenizer.encode_batch_fast(found, add_special_tokens=False)
    return frozenset(w for w, e in zip(found, encoded, strict=True) if len(e.ids) == 1)


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE files write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def _ids(path: str) -> TokenIds:
    return TokenIds(path)


@lru_cache(maxsize=2)
def _counts(path: str, whole: frozenset[str]) -> WordCounts:
    return WordCounts(path, whole)


def token_ids(path: str, texts: list[str | None]) -> list[bytes]:
    return _ids(path)(texts)


def token_counts(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of ``text`` (a long; 0 for null or empty texts).

    ``path`` is the tokenizer's file, at the same place on every executor.  Special strings
    inside texts count as the library has it: one token each.  Every row is counted by itself;
    repeated rows come back alike.  A column ``name`` is replaced.
    """
    docs = docs.drop(name)
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = _counts(path, whole.value)(batch.column(text).to_pylist())
        return replaced(batch, {name: pa.array(counts, pa.int64())})

    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"`{name}` bigint").fields])
    return map_slices(docs, text, work, schema)


def with_bytes(docs: DataFrame, text: str = "text") -> DataFrame:
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return docs.withColumn("n_bytes", size)
