"""Substring dedup with an FM-index, of all suffix positions, for every shard.

A window of consecutive words goes if its words also stand earlier in the corpus.  Searching
every document in every shard would be quadratic, so a shard holds whatever can match:
each window belongs to the least hash of the phrases in it (its anchor), and equal windows
have equal anchors.  Consecutive windows of one anchor are one segment, and anchors found
once in the corpus drop out before any text moves.

In a shard the distinct segments, read where each comes first, are indexed and streamed.  Five words are one symbol, and
a segment is written in five phases, so a window of twenty words is four symbols in a row:
a backward search of four steps finds all its occurrences, and the text positions of that
range of suffixes say which comes first in the corpus.

Repeated segments are grouped before they reach a shard, so copies cost one search.  An anchor
with very many distinct segments is not kept in one shard: its windows are grouped by
their own words instead, which gives the same first places.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.llm.batches import map_slices, replaced, small_batches
from basketry.llm.common import Workspace, checkpointed, free_name, workspace
from basketry.llm.fmindex import FMIndex

WINDOW, PHRASE, STRIDE = 20, 8, 5
#: Distinct segments of one anchor above which its windows are grouped by their words.
CROWD = 20_000
#: Words of segments that one shard indexes, about.
SHARD_WORDS = 400_000
MEMO = 200_000
_NO_ID = -(1 << 63)
#: Words of one text up to which a place fits beside the hash that is compared.
_PLACE_BITS = 24


class _Hashes(dict):
    """Hashes of words, those of common ones remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of words of each text, as `words_of` has them, and all words."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = split.flatten()
    # White space at an end leaves an empty word there.
    full = pc.not_equal(pc.binary_length(words), 0)
    before = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy())))
    return np.diff(before[ends]), words.filter(full)


_FACTOR = 0x9E3779B97F4A7C15


def _rolled(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, from those of runs half as long."""
    if length == 1:
        return hashes
    half = _rolled(hashes, length // 2)
    factor = lambda n: np.uint64(pow(_FACTOR, n, 1 << 64))
    rolled = half[: len(half) - length // 2] * factor(length // 2) + half[length // 2 :]
    if length % 2:
        rolled = rolled[:-1] * np.uint64(_FACTOR) + hashes[length - 1 :]
    return rolled


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The smallest of every ``span`` neighbours."""
    size = 1
    while 2 * size <= span:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = span - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(
    texts: list[list[bytes]], window: int = WINDOW, phrase: int = PHRASE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of texts, given as words: text, first window, number of windows, anchor, and a
    hash of the words."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    hashes = np.fromiter(
        map(_hashes.__getitem__, itertools.chain.from_iterable(texts)), np.uint64, int(sizes.sum())
    )
    return anchors_of_hashes(sizes, hashes, window, phrase)


def word_hashes(words: pa.Array) -> np.ndarray:
    """Hashes of words as `anchors` takes them; equal ones are hashed once."""
    coded = words.dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary())
    if not len(distinct):
        return np.zeros(0, np.uint64)
    _, offsets, data = distinct.buffers()
    ends = np.frombuffer(offsets, np.int64)[distinct.offset :][: len(distinct) + 1].tolist()
    held = memoryview(data or b"")
    known = [xxhash.xxh3_64_intdigest(held[a:b]) for a, b in itertools.pairwise(ends)]
    return np.array(known, np.uint64)[coded.indices.to_numpy()]


def anchors_of_hashes(
    sizes: np.ndarray, hashes: np.ndarray, window: int, phrase: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """`anchors` of texts of ``sizes`` words, given as the hashes of all their words."""
    total = len(hashes)
    if total < window:
        return (np.zeros(0, np.int64),) * 5
    if total >= 1 << _PLACE_BITS and len(sizes) > 1:
        middle = len(sizes) // 2
        cut = int(sizes[:middle].sum())
        low, high = (
            anchors_of_hashes(*part, window, phrase)
            for part in ((sizes[:middle], hashes[:cut]), (sizes[middle:], hashes[cut:]))
        )
        return tuple(
            np.concatenate((x, y + middle if i == 0 else y))
            for i, (x, y) in enumerate(zip(low, high, strict=True))
        )
    phrases = _rolled(hashes, phrase)
    phrases ^= phrases >> np.uint64(31)
    phrases *= np.uint64(0xBF58476D1CE4E5B9)
    phrases ^= phrases >> np.uint64(29)
    # The leftmost of the least: where a phrase comes again within a window, equal windows
    # still agree on its place in them.
    bits = _PLACE_BITS if total < 1 << _PLACE_BITS else total.bit_length()
    place = np.uint64((1 << bits) - 1)
    marked = (phrases & ~place) | np.arange(len(phrases), dtype=np.uint64)
    least = (_least(marked, window - phrase + 1) & place).astype(np.int64)
    # Windows that begin in one text and end in another are none.
    ends = np.cumsum(sizes)
    text_of = np.repeat(np.arange(len(sizes)), np.maximum(sizes - window + 1, 0))
    starts = ends - sizes
    begun = np.cumsum(np.maximum(sizes - window + 1, 0))
    at = np.arange(len(text_of)) - np.repeat(
        begun - np.maximum(sizes - window + 1, 0), np.maximum(sizes - window + 1, 0)
    )
    if not len(at):
        return (np.zeros(0, np.int64),) * 5
    least = least[starts[text_of] + at]
    new = (least[1:] != least[:-1]) | (text_of[1:] != text_of[:-1])
    first = np.flatnonzero(np.concatenate(([True], new)))
    count = np.diff(np.append(first, len(at)))
    windows = _rolled(hashes, window)
    whole = starts[text_of[first]] + at[first]
    # A segment is shorter than two windows, so its first and last window hold all its words.
    content = windows[whole] * np.uint64(_FACTOR) + windows[whole + count - 1]
    anchor = phrases[least[first]]
    return text_of[first], at[first], count, anchor.view(np.int64), content.view(np.int64)


def _anchored(docs: DataFrame) -> DataFrame:
    """``ident``, ``mark`` and for each segment its first window ``at``, windows ``n``, ``anchor`` and
    ``content``; the last two identify its words."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, words = split_words(batch.column("text"))
        of, at, n, anchor, content = anchors_of_hashes(sizes, word_hashes(words), WINDOW, PHRASE)
        columns = [batch.column(name).take(pa.array(of, pa.int64())) for name in ("ident", "mark")]
        columns += [pa.array(at, pa.int32()), pa.array(n, pa.int32())]
        columns += [pa.array(anchor, pa.int64()), pa.array(content, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["ident", "mark", "at", "n", "anchor", "content"])

    schema = "ident bigint, mark bigint, at int, n int, anchor bigint, content bigint"
    return map_slices(docs, "text", work, schema)


def _with_words(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """Each distinct segment with its words, cut from the document it comes first in."""
    listed = distinct.groupBy("ident", "mark").agg(
        F.collect_list(F.struct("at", "n", "anchor", "content")).alias("found")
    )
    given = docs.join(listed, ["ident", "mark"])
    names = ["ident", "at", "n", "anchor", "content", "words"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        idents, texts = batch.column("ident").to_pylist(), batch.column("text").to_pylist()
        out: list[list] = [[] for _ in names]
        for ident, text, found in zip(idents, texts, batch.column("found").to_pylist(), strict=True):
            held = words_of(text)
            for s in found:
                words = b" ".join(held[s["at"] : s["at"] + s["n"] + WINDOW - 1]).decode()
                row = (ident, s["at"], s["n"], s["anchor"], s["content"], words)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        columns = [pa.array(column, kind) for column, kind in zip(out, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    schema = "ident bigint, at int, n int, anchor bigint, content bigint, words string"
    return map_slices(given, "text", work, schema)


def _numbered(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers from 0 that are equal where both are."""
    return np.unique(first * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1]


def first_places(
    texts: pa.Array, idents: np.ndarray, places: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of every window of ``texts`` come first, texts beginning at ``places`` of
    documents ``idents``: identifiers, places, and the number of windows of each text."""
    split = pc.split_pattern(texts, " ")
    sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
    flat = split.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    within = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # A symbol for the five words from a place on; the last four places of a text have none.
    begins = np.flatnonzero(within <= sizes[text_of] - STRIDE)
    symbols = np.zeros(len(flat), np.int64)
    twos = _numbered(flat[:-1], flat[1:])
    fours = _numbered(twos[begins], twos[begins + 2])
    symbols[begins] = _numbered(fours, flat[begins + 4]) + 1
    # Text by text and phase by phase, with an end after each phase.
    phase = text_of[begins] * STRIDE + within[begins] % STRIDE
    order = np.argsort(phase, kind="stable")
    phase, source = phase[order], begins[order]
    place = np.arange(len(source)) + np.cumsum(np.concatenate(([0], phase[1:] != phase[:-1])))
    written = np.zeros(place[-1] + 2, np.int64)
    written[place] = symbols[source]
    index = FMIndex(written, sample=1)
    windows = np.flatnonzero(within <= sizes[text_of] - WINDOW)
    patterns = np.stack([symbols[windows + k] for k in range(0, WINDOW, STRIDE)], axis=1)
    low, high = index.search(patterns)
    # Every position's place in the corpus as one number.
    known, rank = np.unique(idents, return_inverse=True)
    corpus = np.zeros(len(written), np.int64)
    corpus[place] = (rank[text_of[source]] << 32) + places[text_of[source]] + within[source]
    ranges, of = np.unique(low, return_inverse=True)
    ends = np.zeros(len(ranges), np.int64)
    ends[of] = high
    # Windows are of one length, so their ranges of suffixes are equal or disjoint.
    cuts = np.stack([ranges, ends], axis=1).ravel()
    least = np.minimum.reduceat(np.append(corpus[index.samples], 0), cuts)[::2][of]
    return known[least >> 32], least & 0xFFFFFFFF, sizes - WINDOW + 1


def _searched(distinct: DataFrame, shards: int) -> DataFrame:
    """Each segment with the first places ``f_ident``, ``f_at`` of its windows from ``skip`` on."""
    schema = "anchor bigint, content bigint, skip int, f_ident array<bigint>, f_at array<int>"

    def work(table: pa.Table) -> pa.Table:
        idents, at, count = first_places(
            table["words"].combine_chunks(), table["ident"].to_numpy(), table["at"].to_numpy()
        )
        offsets = pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32())
        return pa.table(
            {
                "anchor": table["anchor"],
                "content": table["content"],
                "skip": pa.array(np.zeros(len(count)), pa.int32()),
                "f_ident": pa.ListArray.from_arrays(offsets, pa.array(idents, pa.int64())),
                "f_at": pa.ListArray.from_arrays(offsets, pa.array(at, pa.int32())),
            }
        )

    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    dealt = distinct.select(shard.alias("shard"), "anchor", "content", "words", "ident", "at")
    return dealt.groupBy("shard").applyInArrow(work, schema)


def _by_words(crowded: DataFrame) -> DataFrame:
    """The same as `_searched`, by grouping single windows."""
    windows = crowded.select(
        "anchor",
        "content",
        "ident",
        "at",
        F.split("words", " ").alias("held"),
        F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("skip"),
    ).select(
        "anchor",
        "content",
        "skip",
        F.struct("ident", (F.col("at") + F.col("skip")).alias("at")).alias("place"),
        F.md5(F.array_join(F.slice("held", F.col("skip") + 1, WINDOW), " ")).alias("window"),
    )
    firsts = windows.groupBy("window").agg(F.min("place").alias("first"))
    return windows.join(firsts, "window").select(
        "anchor",
        "content",
        "skip",
        F.array("first.ident").alias("f_ident"),
        F.array("first.at").alias("f_at"),
    )


def _repeats(docs: DataFrame, crowd: int, shard_words: int) -> DataFrame:
    """``ident``, ``mark`` and ``again``: the windows whose words also start earlier.

    ``docs`` has a long ``ident``, a hash ``mark`` of the text and the ``text``.
    """
    session = docs.sparkSession
    with workspace(session) as kept, small_batches(session):
        return _again(docs, crowd, shard_words, kept)


def _again(docs: DataFrame, crowd: int, shard_words: int, kept: Workspace) -> DataFrame:
    # What was shuffled for a table goes when the table is there; so does a table when the next is.
    found = _anchored(docs)
    often = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    repeated = kept.store(found.join(often.select("anchor"), "anchor", "left_semi"), "repeated")
    distinct = (
        repeated.groupBy("anchor", "content")
        .agg(F.min(F.struct("ident", "at", "mark", "n")).alias("first"))
        .select("anchor", "content", "first.*")
    )
    distinct = kept.store(_with_words(docs, distinct), "distinct_segments")
    sizes = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("held"))
    crowded = checkpointed(sizes.filter(F.col("held") > crowd).select("anchor"))
    many = not crowded.isEmpty()
    # A crowded anchor has over ``crowd`` segments, so these are few; no words move to leave them out.
    crowded = F.broadcast(crowded)
    alone = distinct.join(crowded, "anchor", "left_anti") if many else distinct
    total = distinct.agg(F.sum(F.col("n") + WINDOW - 1)).first()[0] or 0
    first = kept.store(_searched(alone, int(total // shard_words) + 1), "firsts")
    if many:
        first = kept.store(_by_words(distinct.join(crowded, "anchor", "left_semi")), "firsts")
    kept.drop("distinct_segments")

    def earlier(first: Column, i: Column) -> Column:
        place = F.col("at") + F.col("skip") + i
        same = (first == F.col("ident")) & (F.get("f_at", i) < place)
        return F.when((first < F.col("ident")) | same, place).otherwise(-1)

    again = F.array_remove(F.transform("f_ident", earlier), -1)
    return checkpointed(
        repeated.select("ident", "mark", "at", "anchor", "content")
        .join(first, ["anchor", "content"])
        .select("ident", "mark", again.alias("again"))
        .filter(F.size("again") > 0)
        .groupBy("ident", "mark")
        .agg(F.flatten(F.collect_set("again")).alias("again"))
    )


def substring_dedup(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    crowd: int = CROWD,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_words``, the text's words that stay, joined by
    one space.

    A window is twenty consecutive words of a document, words being runs of characters other
    than ASCII white space.  Each word in a window whose words also start earlier goes: in a
    smaller ``ident`` (a long; null is smaller than all) or before in the same one.  Windows are
    judged on the input.  Rows of one ``ident`` are one document in this: a window at the same
    place of both is not earlier, and equal rows are judged alike.  A null or empty text has no
    words, and texts shorter than a window lose none.  Columns of the new names are replaced.
    """
    docs = docs.drop("n_words", "n_removed", "kept_words")
    key = F.coalesce(F.col(ident).cast("long"), F.lit(_NO_ID))
    mark = F.xxhash64(text)
    keyed = docs.select(key.alias("ident"), mark.alias("mark"), F.col(text).alias("text"))
    again = _repeats(keyed, crowd, shard_words)
    a, b, c = (free_name(docs, name) for name in ("ident_of", "mark_of", "again"))
    again = again.select(F.col("ident").alias(a), F.col("mark").alias(b), F.col("again").alias(c))
    names = docs.columns
    given = docs.join(again, (key == F.col(a)) & (mark == F.col(b)), "left").drop(a, b)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, gone, kept = [], [], []
        starts = batch.column(c).to_pylist()
        for t, windows in zip(batch.column(text).to_pylist(), starts, strict=True):
            found = words_of(t)
            if windows:
                change = np.zeros(len(found) + 1, np.int64)
                at = np.unique(np.array(windows, np.int64))
                change[at] += 1
                change[at + WINDOW] -= 1
                stays = np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()
                words = [found[i] for i in stays]
            else:
                words = found
            sizes.append(len(found))
            gone.append(len(found) - len(words))
            kept.append(b" ".join(words).decode())
        return replaced(
            batch.select(names),
            {
                "n_words": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(gone, pa.int64()),
                "kept_words": pa.array(kept, pa.string()),
            },
        )

    schema = StructType(
        [
            *docs.schema.fields,
            *StructType.fromDDL("n_words bigint, n_removed bigint, kept_words string").fields,
        ]
    )
    return map_slices(given, text, work, schema)
