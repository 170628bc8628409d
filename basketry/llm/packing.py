"""Best-fit packing of documents into sequences by large-item matching.

Texts longer than a sequence are cut into full pieces, after a first piece with the rest.
Which pieces share a sequence depends on their lengths alone, so the plan is made on the
driver from the number of pieces of each length: one number for each length up to the
capacity, at any size of the corpus.  Pieces above a third of the capacity can share a
sequence by twos at most; the longest takes the longest partner that fits.  The smaller
ones then go, longest first, to the fullest sequence that has room, many alike at a time.

The plan says, for the pieces of a length in any fixed order, which numbers go where; the
pieces are numbered in parallel and joined with it.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.batches import map_slices
from basketry.llm.common import checkpointed, numbered
from basketry.llm.tokens import token_ids

ROWS_PER_BUCKET = 100_000


@dataclass
class Bins:
    """``count`` sequences of one content: runs of ``copies`` pieces of a ``length``."""

    count: int
    runs: tuple[tuple[int, int], ...]
    room: int


def pack_lengths(counts: dict[int, int], capacity: int) -> list[Bins]:
    """Contents of sequences that hold ``counts`` pieces of each length."""
    left = {size: n for size, n in counts.items() if n}
    by_room: dict[int, list[Bins]] = defaultdict(list)

    def opened(count: int, runs: tuple[tuple[int, int], ...]) -> None:
        room = capacity - sum(size * copies for size, copies in runs)
        by_room[room].append(Bins(count, runs, room))

    large = sorted((size for size in left if 3 * size > capacity), reverse=True)
    for size in large:
        partners = [p for p in large if p <= min(size, capacity - size)]
        while left[size]:
            partner = next((p for p in partners if left[p] > (p == size)), None)
            if partner is None:
                n = left[size]
                opened(n, ((size, 1),))
            elif partner == size:
                n = left[size] // 2
                opened(n, ((size, 2),))
                left[size] -= n
            else:
                n = min(left[size], left[partner])
                opened(n, ((size, 1), (partner, 1)))
                left[partner] -= n
            left[size] -= n
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        room = size
        while left[size]:
            while room <= capacity and not by_room[room]:
                room += 1
            if room > capacity:  # nothing has room: new sequences
                fit, source = capacity // size, Bins(-(-left[size] // (capacity // size)), (), capacity)
            else:
                fit, source = room // size, by_room[room].pop()
            full = min(source.count, left[size] // fit)
            rest = left[size] - full * fit if full < source.count else 0
            if full:
                opened(full, (*source.runs, (size, fit)))
            if rest:
                opened(1, (*source.runs, (size, rest)))
            untouched = source.count - full - bool(rest)
            if untouched and source.runs:
                by_room[room].append(Bins(untouched, source.runs, source.room))
            left[size] -= full * fit + rest
    return [bins for held in by_room.values() for bins in held]


def placements(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Rows of length, first number, one past the last, first sequence, copies and offset.

    The k-th piece of a row, from 0, goes to its first sequence plus k // copies, at its offset
    plus its length times k % copies.
    """
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for bins in pack_lengths(counts, capacity):
        offset = 0
        for size, copies in bins.runs:
            first = used[size]
            used[size] += bins.count * copies
            rows.append((size, first, used[size], sequence, copies, offset))
            offset += size * copies
        sequence += bins.count
    return rows


def token_pieces(docs: DataFrame, path: str, capacity: int, text: str, ident: str, end: int) -> DataFrame:
    """Pieces of all documents' ids, each followed by the id ``end``: ``ident``, ``piece``, ``start``,
    ``length``, ``ids_crc32`` and the ``ids`` themselves as little-endian unsigned 32-bit integers."""
    stop = end.to_bytes(4, "little")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, found = batch.column(ident), token_ids(path, batch.column(text).to_pylist())
        row, piece, start, ids = [], [], [], []
        for i, held in enumerate(found):
            held += stop
            size = len(held) // 4
            first = size % capacity or capacity
            cuts = [0, *range(first, size, capacity), size] if size > first else [0, size]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                row.append(i)
                piece.append(k)
                start.append(a)
                ids.append(held[4 * a : 4 * b])
        return pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(map(zlib.crc32, ids), pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            names=[ident, "piece", "start", "length", "ids_crc32", "ids"],
        )

    kind = docs.schema[ident].dataType.simpleString()
    schema = f"`{ident}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
    return map_slices(docs.select(ident, text), text, work, schema)


def pack_pieces(pieces: DataFrame, ident: str, capacity: int) -> DataFrame:
    """``pieces``, read twice, with ``sequence_id`` and the gapless ``offset`` in the sequence."""
    counted = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # <= capacity rows
    counts = {row["length"]: row["n"] for row in counted}
    plan = pieces.sparkSession.createDataFrame(
        placements(counts, capacity),
        "p_length bigint, p_first bigint, p_last bigint, p_sequence bigint, p_copies bigint, p_offset bigint",
    )
    buckets = max(1, sum(counts.values()) // ROWS_PER_BUCKET)
    order = [ident, "piece", "ids_crc32"]
    placed = numbered(pieces, "length", order, "number", buckets)
    number = F.col("number") - F.col("p_first")
    # The plan has a row for each run of a content, whose number depends on the capacity alone.
    return (
        placed.join(
            F.broadcast(plan),
            (F.col("length") == F.col("p_length"))
            & (F.col("number") >= F.col("p_first"))
            & (F.col("number") < F.col("p_last")),
        )
        .withColumn("sequence_id", F.col("p_sequence") + F.floor(number / F.col("p_copies")))
        .withColumn("offset", F.col("p_offset") + F.col("length") * (number % F.col("p_copies")))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def best_fit_packing(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    text: str = "text",
    ident: str = "doc_id",
    end: int = 0,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of ``docs`` with their place: ``ident``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``ids`` if ``keep_ids``, ``sequence_id`` and ``offset``.

    A null or empty text is the one id ``end``.  Every row is a document, repeated rows and rows
    with a null ``ident`` too; other columns are left out.  Equal pieces may swap places between
    runs.  An empty table has no pieces.  Pieces are written to the checkpoint folder once.
    """
    pieces = token_pieces(docs, path, capacity, text, ident, end)
    pieces = checkpointed(pieces if keep_ids else pieces.drop("ids"))
    return pack_pieces(pieces, ident, capacity)
