"""Jaccard join of documents' word n-grams through a token-group matrix.

Similar documents are partitioned into groups, and a group keeps the union of its members'
tokens.  What a query shares with a member it shares with the union, so a group whose union
holds too few of the query's tokens is not opened; in an opened one the query's overlap with
every member is counted at once.

The matrix is read twice.  First its rows for prefixes: in one order of all tokens, rare ones
first, the prefixes of two linked documents share a number of tokens that follows from their
sizes, so counting a query's prefix tokens in each group's prefixes gives the groups that
may qualify without moving whole sets.  Then the qualifying ones meet the whole union in a task.

Documents of equal sets are one set.  Groups by the least hashes of a set, with a common
head, link most of a family before the join; after that only pairs of different components
are asked for, so a family of thousands of near copies costs no square.  What is left of a
family is grouped by the commonest token of its prefixes.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.llm.batches import map_slices, small_batches
from basketry.llm.common import checkpointed
from basketry.llm.graph import components

#: Sets and tokens of a group, queries of a group in one task, tokens of a task.
GROUP, GROUP_TOKENS, QUERIES, TASK_TOKENS = 256, 1_000_000, 2048, 4_000_000
#: Of the hash space the part whose tokens are ordered by how often they occur; others come after.
COUNTED = 0.25
#: Prefix tokens that linked sets share, of a hundred, beyond the first.
EXTRA = 5
#: Sets of a component from which it has groups of its own.
LARGE = 64
#: Documents, as id and hash, up to which those to be read again are sent to every executor.
BROADCAST_DOCS = 200_000
MEMO = 200_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Hashes of words, those of recent ones remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def tokens_of(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; of the whole sequence, if it is shorter."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    rolled = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        rolled = rolled * _FACTOR + hashes[k : len(words) - n + 1 + k]
    return np.unique(_mixed(rolled + np.uint64(n)))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _short_of(size: int, percent: int) -> int:
    """Tokens of a set that a linked one may lack."""
    return size - -(-percent * size // 100)


def _extra(size: int) -> int:
    return max(1, size * EXTRA // 100)


def _marked(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``row``, ``ident``, ``mark``, the size ``n`` of the set, a hash ``a``, ``b`` of it, its least hashes
    ``least`` in two orders, and ``low``: the tokens its prefix may have, ``counted`` first."""
    kinds = {
        "n": pa.int64(), "a": pa.int64(), "b": pa.int64(), "least": pa.list_(pa.int64()),
        "low": pa.list_(pa.int64()), "counted": pa.int64(),
    }
    border = np.uint64(int(COUNTED * 2**64))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {name: [] for name in kinds}
        for text in batch.column("text").to_pylist():
            found = tokens_of(text, n)
            size, whole = len(found), found.tobytes()
            counted = int(np.searchsorted(found, border))
            upto = max(counted, _short_of(size, percent) + _extra(size))
            other = _mixed(found + _FACTOR)
            out["n"].append(size)
            out["a"].append(xxhash.xxh3_64_intdigest(whole) - (1 << 63))
            out["b"].append(xxhash.xxh64_intdigest(whole, 1) - (1 << 63))
            out["least"].append(_signed(np.array([found[0], other.min()])) if size else None)
            out["low"].append(_signed(found[:upto]))
            out["counted"].append(counted)
        held = [batch.column(c) for c in ("row", "ident", "mark")]
        arrays = [pa.array(out[name], kind) for name, kind in kinds.items()]
        return pa.RecordBatch.from_arrays([*held, *arrays], names=["row", "ident", "mark", *kinds])

    fields = [f for f in docs.schema.fields if f.name != "text"]
    more = "n long, a long, b long, least array<long>, low array<long>, counted long"
    return map_slices(docs, "text", work, StructType([*fields, *StructType.fromDDL(more).fields]))


def _whole(docs: DataFrame, n: int) -> DataFrame:
    """``s`` and all ``tokens`` of documents."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [_signed(tokens_of(t, n)) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("s"), pa.array(sets, pa.list_(pa.int64()))], names=["s", "tokens"]
        )

    return map_slices(docs.select("s", "text"), "text", work, "s long, tokens array<long>")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``s``, ``n``, ``k``, ``least`` and ``prefix``: the tokens of its prefix that other sets have as well."""
    tokens = sets.select("s", F.explode("low").alias("t"))
    often = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    border = int(COUNTED * 2**64)  # signed, counted tokens are those from 0 to here
    counted = F.col("t").between(0, border - 1)
    shared = (
        tokens.join(often, "t")
        .groupBy("s")
        .agg(
            F.collect_list(
                F.struct((~counted).alias("later"), F.when(counted, F.col("times")).alias("times"), "t")
            ).alias("shared"),
            F.count_if(counted).alias("n_counted"),
        )
    )
    n = F.col("n")
    k = F.greatest(F.lit(1).cast("long"), F.expr(f"n * {EXTRA} div 100"))
    length = n - F.expr(f"({percent} * n + 99) div 100") + k
    # Counted tokens that no other set has come first in the order.
    left = F.when(
        F.col("counted") >= length, F.greatest(F.lit(0), length - F.col("counted") + F.col("n_counted"))
    ).otherwise(F.size("shared"))
    prefix = F.slice(F.array_sort("shared"), F.lit(1), left.cast("int"))
    least_k = F.greatest(F.lit(1), F.expr(f"(n * {percent} div 100) * {EXTRA} div 100"))
    return (
        sets.select("s", "n", "counted", "least", "ident", "mark")
        .join(shared, "s")
        .select("s", "n", k.alias("k"), "least", "ident", "mark", F.transform(prefix, lambda x: x["t"]).alias("prefix"))
        .filter(F.size("prefix") >= least_k)
    )


class _Group:
    """A group's sets, and the union of their tokens with the sets that have each."""

    def __init__(self, marks: Iterable[int], sets: list[np.ndarray], comps: Iterable[int]):
        held = {mark: (comp, tokens) for mark, comp, tokens in zip(marks, comps, sets, strict=True)}
        self.marks, self.comps = list(held), [comp for comp, _ in held.values()]
        sets = [tokens for _, tokens in held.values()]
        self.sizes = np.array([len(x) for x in sets], np.int64)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.union, self.starts = np.unique(flat[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(flat))

    def linked(self, tokens: np.ndarray, percent: int) -> np.ndarray:
        """Members linked to a set: none, unopened, if the union holds too little of it."""
        size = len(tokens)
        at = np.searchsorted(self.union, tokens)
        at[at == len(self.union)] = 0
        at = at[self.union[at] == tokens]
        if 100 * len(at) < percent * max(size, int(self.sizes.min())):
            return np.zeros(0, np.int64)
        lengths = self.ends[at] - self.starts[at]
        places = np.repeat(self.starts[at] - np.cumsum(lengths) + lengths, lengths)
        owners = self.owners[places + np.arange(len(places))]
        both = np.bincount(owners, minlength=len(self.sizes))
        return np.flatnonzero(100 * both >= percent * (size + self.sizes - both))


class _Forest:
    """Links that join what was apart so far."""

    def __init__(self):
        self.root: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while (up := self.root.get(x, x)) != x:
            self.root[x] = x = self.root.get(up, up)
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.root[max(a, b)] = min(a, b)
            self.links.append((x, y))


def _edge_table(links: list[tuple[int, int]]) -> pa.Table:
    u, v = zip(*links, strict=True) if links else ((), ())
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [x.values.to_numpy() for x in column]


def _family_links(sets: DataFrame, full: DataFrame, percent: int, group: int) -> DataFrame:
    """Edges ``u``, ``v`` between sets of equal least hashes, from parts of bounded size with one head."""
    keyed = sets.select("s", "n", F.posexplode("least").alias("order", "least"))
    family = ["order", "least"]
    sizes = keyed.groupBy(*family).agg(
        F.count(F.lit(1)).alias("held"), F.sum("n").alias("total"), F.min("s").alias("head")
    )
    sizes = sizes.filter("held > 1").withColumn(
        "parts", F.greatest(F.ceil(F.col("held") / group), F.ceil(F.col("total") / GROUP_TOKENS))
    )
    dealt = keyed.join(sizes, family).withColumn("part", F.pmod(F.xxhash64("s"), F.col("parts")))
    heads = sizes.select(*family, F.col("head").alias("s"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    members = dealt.select(*family, "s", "part").unionByName(heads).distinct()
    tokens = sizes.agg(F.sum("total")).first()[0] or 0
    shard = F.pmod(F.xxhash64(*family, "part"), F.lit(tokens // TASK_TOKENS + 1))

    def work(table: pa.Table) -> pa.Table:
        forest = _Forest()
        marks, sets = table["s"].to_numpy(), _lists(table["tokens"])
        keys = np.stack([table[c].to_numpy() for c in ("order", "least", "part")])
        order = np.lexsort(keys)
        new = np.flatnonzero((keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0)) + 1
        for rows in np.split(order, new):
            found = _Group(marks[rows].tolist(), [sets[i] for i in rows], marks[rows].tolist())
            for i in rows:
                for j in found.linked(sets[i], percent):
                    forest.join(int(marks[i]), found.marks[j])
        return _edge_table(forest.links)

    return (
        members.join(full, "s")
        .withColumn("shard", shard)
        .groupBy("shard")
        .applyInArrow(work, "u long, v long")
    )


def _grouped(sets: DataFrame, group: int, large: int) -> DataFrame:
    """Each set with its group's number ``g``.  Large components are divided among groups of their own,
    whose numbers come last.  Other sets are grouped by the commonest token of their prefix, which
    near copies that are not linked mostly share as well."""
    comps = sets.groupBy("comp").agg(F.count(F.lit(1)).alias("comp_sets"))
    sets = sets.join(comps, "comp").withColumn("own", F.col("comp_sets") >= large)
    sets = sets.withColumn("family", F.when(F.col("own"), F.col("comp")).otherwise(F.element_at("prefix", -1)))
    key = ["own", "family"]
    sizes = sets.groupBy(*key).agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("total"))
    sizes = sizes.select(
        *key,
        F.greatest(F.ceil(F.col("held") / group), F.ceil(F.col("total") / GROUP_TOKENS)).alias("parts"),
    )
    sets = sets.join(sizes, key).withColumn("part", F.pmod(F.xxhash64("s"), F.col("parts")))
    groups = sets.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("held"))
    number = F.monotonically_increasing_id() + F.when(F.col("own"), F.lit(1 << 62)).otherwise(F.lit(0))
    groups = checkpointed(groups.withColumn("g", number))
    placed = sets.join(groups.select(*key, "part", "g"), [*key, "part"])
    return checkpointed(placed.select("s", "n", "k", "comp", "own", "g", "prefix"))


def _candidates(placed: DataFrame, percent: int) -> DataFrame:
    """``s``, its size ``n`` and ``g``: groups whose prefixes hold as many of a query's prefix tokens as a linked
    member's would.  Of two sets the one of the smaller group number asks."""
    posted = placed.select("s", "n", "k", "comp", "own", "g", F.explode("prefix").alias("t"))
    apart = (
        posted.groupBy("t")
        .agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        .filter("low < high")
        .select("t")
    )
    posted = checkpointed(posted.join(apart, "t"))
    matrix = posted.groupBy(F.col("t").alias("m_t"), F.col("g").alias("m_g")).agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("k").alias("m_k"),
    )
    meets = (
        (F.col("t") == F.col("m_t"))
        & ((F.col("g") < F.col("m_g")) | ((F.col("g") == F.col("m_g")) & ~F.col("own")))
        & ((F.col("low") != F.col("comp")) | (F.col("high") != F.col("comp")))
        & (100 * F.col("most") >= percent * F.col("n"))
        & (100 * F.col("n") >= percent * F.col("least"))
    )
    return (
        posted.join(matrix, meets)
        .groupBy("s", "n", "k", F.col("m_g").alias("g"))
        .agg(F.count(F.lit(1)).alias("both"), F.min("m_k").alias("m_k"))
        .filter(F.col("both") >= F.least("k", "m_k"))
        .select("s", "n", "g")
    )


def _opened(placed: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Edges ``u``, ``v`` between components, from each query and the groups that qualify for it."""
    asked = checkpointed(_candidates(placed, percent))
    parts = asked.groupBy("g").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / QUERIES), F.ceil(F.sum("n") / TASK_TOKENS)
        ).alias("parts")
    )
    size = F.sum(F.size("tokens")).alias("size")
    known = full.join(placed.select("s", "comp", "g"), "s")
    queries = (
        asked.join(parts, "g")
        .withColumn("part", F.pmod(F.xxhash64("s"), F.col("parts")))
        .select("s", "g", "part")
        .join(known.select("s", "comp", "tokens"), "s")
        .select("g", "part", "s", "comp", "tokens", F.lit(True).alias("asks"))
    )
    members = known.join(parts, "g").select(
        "g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "s", "comp", "tokens",
        F.lit(False).alias("asks"),
    )
    rows = queries.unionByName(members)
    total = rows.agg(size).first()[0] or 0
    shard = F.pmod(F.xxhash64("g", "part"), F.lit(total // TASK_TOKENS + 1))

    def work(table: pa.Table) -> pa.Table:
        forest = _Forest()
        marks, comps = table["s"].to_pylist(), table["comp"].to_pylist()
        sets, asks = _lists(table["tokens"]), table["asks"].to_numpy()
        keys = np.stack([table[c].to_numpy() for c in ("g", "part")])
        order = np.lexsort(keys)
        new = np.flatnonzero((keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0)) + 1
        for rows in np.split(order, new):
            held = [i for i in rows if not asks[i]]
            if not held:
                continue
            found = _Group([marks[i] for i in held], [sets[i] for i in held], [comps[i] for i in held])
            for i in (i for i in rows if asks[i]):
                for j in found.linked(sets[i], percent):
                    forest.join(comps[i], found.comps[j])
        return _edge_table(forest.links)

    return rows.withColumn("shard", shard).groupBy("shard").applyInArrow(work, "u long, v long")


def _classes(
    keyed: DataFrame, shingle: int, percent: int, group: int, large: int
) -> tuple[DataFrame, DataFrame]:
    """All of ``keyed`` with the size and hash of each set, and the ``component`` of each such hash."""
    marked = checkpointed(_marked(keyed, shingle, percent))
    firsts = (
        marked.filter("n > 0")
        .groupBy("a", "b")
        .agg(
            F.min(F.struct(F.col("ident").isNull(), "ident", "mark")).alias("first"),
            F.min("ident").alias("smallest"),
            *[F.first(c).alias(c) for c in ("n", "least", "low", "counted")],
        )
        .select("*", "first.ident", "first.mark")
    )
    sets = checkpointed(firsts.drop("first").withColumn("s", F.monotonically_increasing_id()))
    near = checkpointed(_prefixes(sets, percent))
    # Only sets that may be linked are read again, whole.
    chosen = near.select("s", F.col("ident").alias("i"), F.col("mark").alias("m"))
    several = near.count()
    chosen = F.broadcast(chosen) if several <= BROADCAST_DOCS else chosen
    again = keyed.join(chosen, F.col("ident").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")))
    full = checkpointed(_whole(again, shingle))
    if full.count() > several:  # rows that are repeated with their ids
        full = checkpointed(full.dropDuplicates(["s"]))
    seeds = checkpointed(components(_family_links(near, full, percent, group)))
    rooted = near.join(seeds, near["s"] == seeds["u"], "left").select(
        "s", "n", "k", "least", "prefix", F.coalesce("root", "s").alias("comp")
    )
    placed = _grouped(rooted, group, large)
    last = components(_opened(placed, full, percent))
    final = placed.join(last, placed["comp"] == last["u"], "left").select(
        F.col("s").alias("of"), F.coalesce("root", "comp").alias("root")
    )
    known = sets.select("s", "a", "b", "smallest").join(final, F.col("s") == F.col("of"), "left")
    known = checkpointed(known.select("a", "b", "smallest", F.coalesce("root", "s").alias("root")))
    least = known.groupBy("root").agg(F.min("smallest").alias("component"))
    found = known.join(least, "root").select(F.col("a").alias("of_a"), F.col("b").alias("of_b"), "component")
    return marked, found


def jaccard_groups(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    percent: int = 85,
    group: int = GROUP,
    large: int = LARGE,
) -> DataFrame:
    """``docs`` with ``n_shingles`` and ``component_id`` in place of ``text``, which goes to Python and not back.

    A document's set is that of its distinct shingles of ``shingle`` words, words being
    ASCII-lower-cased runs without ASCII white space; a text of fewer words is one shingle.  Two
    documents are linked if 100 times what they share is at least ``percent`` times what either has.
    ``component_id`` is the smallest ``ident`` reachable over links, its own included; documents
    without words are linked with nothing and have their own.  Repeated rows are linked.  A null
    ``ident`` is never the smallest; a component of such rows alone has a null one.  Columns named
    ``n_shingles`` or ``component_id`` are replaced, others come back.

    Shingles are compared by a 64-bit hash, whole sets by 128 bits.
    """
    kept = [c for c in docs.columns if c not in (text, "n_shingles", "component_id")]
    if ident not in kept:
        raise ValueError("the identifier is among the columns that are replaced")
    keyed = docs.select(
        F.struct(*kept).alias("row"), F.col(ident).alias("ident"), F.xxhash64(text).alias("mark"),
        F.col(text).alias("text"),
    )
    with small_batches(docs.sparkSession):
        marked, found = _classes(keyed, shingle, percent, group, large)
    given = marked.select("row", "ident", "n", "a", "b")
    joined = given.join(found, (F.col("a") == F.col("of_a")) & (F.col("b") == F.col("of_b")), "left")
    return joined.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("ident")).alias("component_id"),
    )
