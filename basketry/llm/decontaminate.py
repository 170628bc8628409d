"""Benchmark decontamination with an FM-index for every shard of the training texts.

A shard is a run of documents of bounded bytes.  Its words are numbered by the benchmark's
vocabulary.  A word outside it cannot be in any occurrence, and neither can a run of known
words that is shorter than the shortest phrase, so only the longer runs are indexed.  All
phrases are searched backwards at once, occurrences are located by sampled suffix
positions, and overlapping ones are merged to spans.

The benchmark is read in blocks of bounded bytes, each of them searched in all documents:
every block is one more pass of the same tasks, without a shuffle.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.llm.batches import map_slices, replaced
from basketry.llm.fmindex import FMIndex, expand

#: Bytes of benchmark text searched, and sent to the executors, at a time.
BLOCK_BYTES = 8 << 20
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_LOWER_WORDS = bytes.maketrans(
    bytes(range(0x41, 0x5B)) + _SEPARATORS, bytes(range(0x61, 0x7B)) + b" " * len(_SEPARATORS)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LEAK = (
    "leak struct<n_words:bigint,n_hit:bigint,"
    "spans:array<struct<first:bigint,last:bigint,start:bigint,stop:bigint>>,items:array<string>>"
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and all characters beyond ASCII."""
    return (text or "").encode().translate(_LOWER_WORDS).split()


@dataclass
class Phrases:
    """A block of the benchmark: its vocabulary, its distinct windows by length, and who has them."""

    vocabulary: dict[bytes, int]
    by_length: dict[int, np.ndarray]
    items_of: dict[int, list[list[int]]]
    items: list[str]


def phrases(rows: list[tuple[str, str | None]], window: int) -> Phrases:
    vocabulary: dict[bytes, int] = {}
    owners: dict[int, dict[tuple[int, ...], list[int]]] = {}
    names = sorted({item for item, _ in rows})
    number = {item: i for i, item in enumerate(names)}
    for item, text in rows:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        size = min(window, len(ids))
        for at in range(len(ids) - size + 1) if ids else ():
            held = owners.setdefault(size, {}).setdefault(tuple(ids[at : at + size]), [])
            if not held or held[-1] != number[item]:
                held.append(number[item])
    return Phrases(
        vocabulary,
        {size: np.array(list(found), np.int64) for size, found in owners.items()},
        {size: list(found.values()) for size, found in owners.items()},
        names,
    )


def _blocks(benchmark: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple]]:
    rows, held = [], 0
    chosen = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")), F.col(text))
    for row in chosen.toLocalIterator():
        size = len((row[1] or "").encode())
        if rows and held + size > most:
            yield rows
            rows, held = [], 0
        rows.append((row[0], row[1]))
        held += size
    if rows:
        yield rows


def _occurrences(block: Phrases, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Places of occurrences in ``ids`` (0 is an unknown word or an end), their phrases, the length."""
    if not block.by_length:
        return
    known = ids != 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], known, [False])).astype(np.int8)))
    first, last = edges[::2], edges[1::2]
    long = last - first >= min(block.by_length)
    first, last = first[long], last[long]
    if not len(first):
        return
    # The runs and the unknown word or end after each, which separates them.
    places, _ = expand(first, last + 1)
    index = FMIndex(ids[places])
    for size, windows in block.by_length.items():
        low, high = index.search(windows)
        rows, of = expand(low, high)
        if len(rows):
            yield places[index.locate(rows)], of, size


def _offsets(text: str, spans: list[tuple[int, int]]) -> list[dict]:
    """Spans of word numbers with their code points; both as first and one past the last."""
    at = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    return [
        {"first": a, "last": b, "start": at[a][0], "stop": at[b - 1][1]} for a, b in spans
    ]


def _scan(batch: pa.RecordBatch, text: str, leak: str, block: Phrases) -> pa.RecordBatch:
    texts = batch.column(text).to_pylist()
    number = block.vocabulary.get
    parts, sizes = [], []
    for t in texts:
        found = words_of(t)
        sizes.append(len(found))
        parts.append(np.fromiter((number(w, 0) for w in found), np.int64, len(found)))
        parts.append(np.zeros(1, np.int64))
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    starts = np.cumsum([0, *(n + 1 for n in sizes)])
    change = np.zeros(len(ids) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for places, of, size in _occurrences(block, ids):
        np.add.at(change, places, 1)
        np.add.at(change, places + size, -1)
        doc = np.searchsorted(starts, places, side="right") - 1
        for d, w in set(zip(doc.tolist(), of.tolist(), strict=True)):
            items[d].update(block.items[i] for i in block.items_of[size][w])
    before = batch.column(leak).to_pylist() if leak in batch.schema.names else [None] * len(texts)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], np.cumsum(change) > 0, [False])).astype(np.int8)))
    spans: dict[int, list[tuple[int, int]]] = {}
    of_span = np.searchsorted(starts, edges[::2], side="right") - 1
    for d, a, b in zip(of_span.tolist(), edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        spans.setdefault(d, []).append((a - int(starts[d]), b - int(starts[d])))
    result = []
    for d, (size, held) in enumerate(zip(sizes, before, strict=True)):
        old = [(s["first"], s["last"]) for s in held["spans"]] if held else []
        merged = _merged(old + spans.get(d, []))
        result.append(
            {
                "n_words": size,
                "n_hit": sum(b - a for a, b in merged),
                "spans": _offsets(texts[d], merged) if merged else [],
                "items": sorted(items[d].union(held["items"] if held else ())),
            }
        )
    return replaced(batch, {leak: pa.array(result, _leak_type())})


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    done: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if done and a <= done[-1][1]:
            done[-1] = (done[-1][0], max(b, done[-1][1]))
        else:
            done.append((a, b))
    return done


def _leak_type() -> pa.DataType:
    span = pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "stop")])
    return pa.struct(
        [
            ("n_words", pa.int64()),
            ("n_hit", pa.int64()),
            ("spans", pa.list_(span)),
            ("items", pa.list_(pa.string())),
        ]
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct ``leak``: ``n_words``, ``n_hit`` words inside occurrences of benchmark
    windows, merged ``spans`` (word numbers ``first`` to before ``last``, code points ``start`` to
    before ``stop``) and the sorted ``items`` that occur, as strings.

    A window is ``window`` consecutive words of an item, or a shorter item as a whole.  A null
    text, on either side, has no words; items without words and an empty benchmark hit nothing.
    Items of one id count once, a null id is the empty string.  Every row is judged by itself,
    so repeated rows come back alike.  A column ``leak`` is replaced.
    """
    docs = docs.drop("leak")
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(LEAK).fields])
    context = docs.sparkSession.sparkContext
    rest = _blocks(benchmark, item, item_text, block_bytes)
    found = docs
    for rows in itertools.chain([next(rest, [])], rest):  # one pass at least
        found = _pass(found, context.broadcast(phrases(rows, window)), text, schema)
    return found


def _pass(docs: DataFrame, block: Broadcast, text: str, schema: StructType) -> DataFrame:
    return map_slices(docs, text, lambda batch: _scan(batch, text, "leak", block.value), schema)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without its spans; what stays is not joined anew."""
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["stop"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    pieces = F.transform(
        F.arrays_zip(ends.alias("a"), starts.alias("b")),
        lambda z: F.substring(text, (z["a"] + 1).cast("int"), (z["b"] - z["a"]).cast("int")),
    )
    return F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(text)
