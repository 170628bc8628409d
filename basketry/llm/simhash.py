"""SimHash near-dedup with pigeonring filtering.

The 64 bits of a fingerprint lie in a ring of equal segments.  If two fingerprints differ
in at most t bits, then from some segment on every chain of l consecutive segments differs
in at most l * t / m bits, m being the number of segments.  Budgets below one ask for
equality: those first segments are the key under which a fingerprint is filed, once for
every segment of the ring.  Fingerprints under one key are candidates; the longer chains'
budgets prune them before the distance is counted.

Only distinct fingerprints meet, so copies cost nothing.  Where very many of them share a
key, their pairs are not listed: each is filed under itself and all fingerprints one bit
away, and two that are at most two bits apart meet there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from basketry.llm.batches import map_slices, replaced
from basketry.llm.common import checkpointed, free_name
from basketry.llm.graph import components

BITS, SEED = 64, 42
SEGMENTS = 16
#: Fingerprints under one key above which their pairs are found by neighbours instead.
CROWD = 1000
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits, each set if more than half of the shingles' hashes have it; 0 without words."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    if len(found) <= shingle:
        spans = [(0, len(joined))]
    else:
        starts = np.concatenate(([0], ends[:-1] + 1))
        last = len(found) - shingle + 1
        spans = list(zip(starts[:last].tolist(), ends[shingle - 1 :].tolist(), strict=True))
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), _HASHES_AT_ONCE):
        part = spans[at : at + _HASHES_AT_ONCE]
        hashes = np.array([digest(joined[s:e], SEED) for s, e in part], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = 2 * ones > len(spans)
    return int(np.packbits(set_bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``docs`` with ``fingerprint`` in place of ``text``, which goes to Python and not back."""
    kept = [name for name in docs.columns if name != text]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [fingerprint(t, shingle) for t in batch.column(text).to_pylist()]
        return replaced(batch.select(kept), {"fingerprint": pa.array(values, pa.int64())})

    fields = [f for f in docs.schema.fields if f.name != text]
    schema = StructType([*fields, StructField("fingerprint", LongType())])
    return map_slices(docs, text, work, schema)


def _rotated(x: Column, by: int) -> Column:
    if by == 0:
        return x
    return F.shiftrightunsigned(x, by).bitwiseOR(F.shiftleft(x, BITS - by))


def _low(x: Column, bits: int) -> Column:
    return x if bits >= BITS else x.bitwiseAND(F.lit((1 << bits) - 1))


def _chains(max_bits: int, segments: int) -> dict[int, int]:
    """For each budget of whole bits the longest chain it holds for."""
    longest: dict[int, int] = {}
    for length in range(1, segments + 1):
        longest[length * max_bits // segments] = length
    return longest


def links(prints: DataFrame, max_bits: int, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """Edges ``u``, ``v`` between distinct fingerprints ``p`` at most ``max_bits`` apart.

    They connect all such fingerprints; two that share a crowded key may be connected through
    others instead of directly.
    """
    if BITS % segments or not 0 < max_bits <= 2 < segments:
        raise ValueError("one or two bits, and a number of segments that divides 64, are asked for")
    width, chains = BITS // segments, _chains(max_bits, segments)
    first = chains[0] * width
    # The rotated fingerprint begins with the segment at which the ring is entered.
    filed = F.array(
        *[
            F.struct(F.lit(i).alias("ring"), _low(_rotated(F.col("p"), i * width), first).alias("key"))
            for i in range(segments)
        ]
    )
    keyed = prints.select("p", F.explode(filed).alias("at")).select("p", "at.ring", "at.key")
    sizes = keyed.groupBy("ring", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = checkpointed(sizes)
    shared = keyed.join(sizes.filter(F.col("n") <= crowd).select("ring", "key"), ["ring", "key"])
    other = shared.select("ring", "key", F.col("p").alias("q"))
    x = F.col("p").bitwiseXOR(F.col("q"))
    from_ring = F.lit(None).cast("long")
    for i in range(segments):
        from_ring = F.when(F.col("ring") == i, _rotated(x, i * width)).otherwise(from_ring)
    pruned = F.lit(True)
    for budget, length in chains.items():
        if 0 < budget < max_bits:
            pruned &= F.bit_count(_low(from_ring, length * width)) <= budget
    pairs = (
        shared.join(other, ["ring", "key"])
        .filter(F.col("p") < F.col("q"))
        .filter(pruned)
        .filter(F.bit_count(x) <= max_bits)
        .select(F.col("p").alias("u"), F.col("q").alias("v"))
    )
    crowded = sizes.filter(F.col("n") > crowd).select("ring", "key")
    if crowded.isEmpty():
        return pairs
    members = keyed.join(crowded, ["ring", "key"]).select("p").distinct()
    flips = F.array(F.lit(0), *[F.lit(_signed(1 << b)) for b in range(BITS)])
    near = members.select("p", F.explode(flips).alias("flip"))
    near = near.select("p", F.col("p").bitwiseXOR(F.col("flip")).alias("place"))
    if max_bits == 1:  # at one place lie fingerprints up to two bits apart
        met = near.join(members.select(F.col("p").alias("q")), F.col("place") == F.col("q"))
        return pairs.union(met.filter("p < q").select("p", "q"))
    heads = near.groupBy("place").agg(F.min("p").alias("head"))
    starred = near.join(heads, "place").filter("p <> head").select("p", "head")
    return pairs.union(starred.distinct())


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def fingerprint_groups(
    printed: DataFrame,
    ident: str = "doc_id",
    max_bits: int = 2,
    segments: int = SEGMENTS,
    crowd: int = CROWD,
) -> DataFrame:
    """``printed``, which has a ``fingerprint``, with ``component_id`` and ``component_root``.

    It is read twice: what is costly to compute again should be stored first.
    """
    printed = printed.drop("component_id", "component_root")
    marked = checkpointed(printed.groupBy("fingerprint").agg(F.min(ident).alias("smallest")))
    edges = links(marked.select(F.col("fingerprint").alias("p")), max_bits, segments, crowd)
    p, of = F.col("fingerprint"), free_name(printed, "fingerprint_of")
    rooted = marked.join(components(edges), p == F.col("u"), "left").select(
        p, "smallest", F.coalesce("root", p).alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    by_print = rooted.join(smallest, "root").select(
        p.alias(of), "component_id", F.col("root").alias("component_root")
    )
    return printed.join(by_print, F.col("fingerprint") == F.col(of)).select(
        *printed.columns, "component_id", "component_root"
    )


def simhash_groups(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    segments: int = SEGMENTS,
    crowd: int = CROWD,
) -> DataFrame:
    """``docs`` with ``fingerprint`` (a signed long), ``component_id``, the smallest ``ident``
    reachable over links of at most ``max_bits`` differing bits, and ``component_root``, the smallest
    such fingerprint, which tells groups apart whatever their ids.

    Words are ASCII-lower-cased runs without ASCII white space; a text of fewer words than a
    shingle is one shingle.  Null and empty texts have fingerprint 0 and are linked like any
    other.  Repeated rows share a group.  A null ``ident`` is never the smallest; a group of such
    rows alone has a null ``component_id``.  Columns of the three new names are replaced.

    Fingerprints are kept by ``ident`` and a hash of the text, and joined with ``docs`` by both.
    """
    docs = docs.drop("fingerprint", "component_id", "component_root")
    mark = F.xxhash64(text)
    keyed = docs.select(F.col(ident).alias("ident"), mark.alias("mark"), F.col(text).alias("text"))
    printed = checkpointed(fingerprints(keyed, "text", shingle)).dropDuplicates(["ident", "mark"])
    found = fingerprint_groups(printed, "ident", max_bits, segments, crowd)
    a, b = free_name(docs, "ident_of"), free_name(docs, "mark_of")
    found = found.withColumnsRenamed({"ident": a, "mark": b})
    same = F.col(ident).eqNullSafe(F.col(a)) & (mark == F.col(b))
    return docs.join(found, same).select(
        *docs.columns, "fingerprint", "component_id", "component_root"
    )
