"""Sharding by a k-d tree over document metadata.

The root holds all shards.  A node of several shards is split along its widest dimension,
at the value left of which lie as many bytes as its left half of shards is to get, until
every leaf is one shard of the target bytes.  All nodes of a level are split at once.

A weighted median is found without sorting: a row's key is its place in the dimension (31
bits) followed by a hash that tells apart rows of one place, so a hot value can be split as
well.  Bytes are summed per node and leading bits of the key, then again only within the
bin that holds the median, until the bin is small against a leaf.

The tree is a table of nodes.  Node n has the children 2n + 1 and 2n + 2; a node of one shard
has no cut, and its rows go on to the left child.  The keys and sizes of rows (some 50 bytes a
row) are written once a level with the node they lie in.  A pass over them gets the level's
nodes as one array, by a scalar subquery, and a row looks up its own, so a pass costs the same for
any number of nodes.  The array takes about 100 bytes a shard.  The driver sees whether a level
is done, no nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import checkpointed, numbered

PLACE_BITS, KEY_BITS, STEP_BITS = 31, 63, 21
ROWS_PER_BUCKET = 100_000
LAST_KEY = (1 << KEY_BITS) - 1


def _key(dims: int, dim: Column) -> Column:
    """The row's key in dimension number ``dim``; null for null."""
    key = F.lit(None).cast("long")
    for d in range(dims):
        key = F.when(dim == d, F.col(f"_key{d}")).otherwise(key)
    return key


def _array(nodes: DataFrame, *columns: str) -> Column:
    """Nodes without gaps in their numbers as one array in their order."""
    listed = F.array_sort(F.collect_list(F.struct("node", *columns)))
    return nodes.agg(listed.alias("nodes")).scalar()


def _descended(rows: DataFrame, nodes: Column, dims: int, start: int = 0) -> DataFrame:
    """``rows`` with ``_node`` one level down; ``nodes`` begin with node number ``start``."""
    here = F.get(nodes, F.col("_node") - start)
    right = F.coalesce(_key(dims, here["dim"]) >= here["cut"], F.lit(False))
    return rows.withColumn("_node", F.col("_node") * 2 + 1 + right.cast("int"))


def _measured(at: DataFrame, level: DataFrame, dims: int) -> DataFrame:
    """``level`` with the widest dimension of each node, the byte it is to be cut at, and whether
    that has to be searched: not for nodes of one shard, and not for nodes without bytes."""
    shift = KEY_BITS - PLACE_BITS
    place = lambda d: F.shiftright(f"_key{d}", shift)
    widths = [(F.max(place(d)) - F.min(place(d))).alias(f"_w{d}") for d in range(dims)]
    sized = at.groupBy(F.col("_node").alias("node")).agg(F.sum("_size").alias("_bytes"), *widths)
    widest = F.lit(0)
    top = F.array_max(F.array(*[F.col(f"_w{d}") for d in range(dims)]))
    for d in reversed(range(dims)):
        widest = F.when(F.col(f"_w{d}") == top, F.lit(d)).otherwise(widest)
    many, held = F.col("leaves") > 1, F.coalesce("_bytes", F.lit(0)) > 0
    half = F.floor(F.col("leaves") / 2).cast("int")
    wanted = F.floor(F.col("_bytes").cast("decimal(20,0)") * half / F.col("leaves")).cast("long")
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    return level.join(sized, "node", "left").select(
        *level.columns,
        F.when(many, F.when(held, widest).otherwise(F.lit(0))).alias("dim"),
        F.when(many & ~held, zero).otherwise(null).alias("cut"),
        F.when(held, wanted).otherwise(zero).alias("wanted"),
        zero.alias("below"),
        zero.alias("prefix"),
        (many & held).alias("open"),
    )


def _refined(at: DataFrame, level: DataFrame, dims: int, start: int, known: int, slack: float) -> DataFrame:
    """``level`` after one more step of bits: each open node goes on within the bin that holds the
    wanted byte, or is cut at the border of that bin which lies nearer to it."""
    step = min(STEP_BITS, KEY_BITS - known)
    nodes = _array(level, "dim", "wanted", "below", "prefix", "open")
    here = F.get(nodes, F.col("_node") - start)
    rows = at.filter(here["open"]).withColumn("_at", _key(dims, here["dim"]))
    if known:
        rows = rows.filter(F.shiftright("_at", KEY_BITS - known) == here["prefix"])
    bins = rows.groupBy("_node", F.shiftright("_at", KEY_BITS - known - step).alias("_bin")).agg(
        F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    in_order = Window.partitionBy("_node").orderBy("_bin")
    hit = (
        bins.withColumn("_upto", F.sum("_bytes").over(in_order) + here["below"])
        .filter(F.col("_upto") >= here["wanted"])
        .withColumn("_rank", F.row_number().over(in_order))
        .filter("_rank = 1")
        .withColumnRenamed("_node", "node")
    )
    known += step
    before = F.col("_upto") - F.col("_bytes")
    after = F.col("_upto") - F.col("wanted") < F.col("wanted") - before
    lower = F.shiftleft("_bin", KEY_BITS - known)
    # The last bin has no border after it within the keys.
    upper = F.when(F.col("_bin") == (1 << known) - 1, F.lit(LAST_KEY)).otherwise(
        F.shiftleft(F.col("_bin") + 1, KEY_BITS - known)
    )
    cut = F.when(after, upper).otherwise(lower)
    done = F.lit(known == KEY_BITS) | (F.col("_rows") == 1) | (F.col("_bytes") <= slack)
    found = F.col("_bin").isNotNull()
    return level.join(hit, "node", "left").select(
        "node",
        "first",
        "leaves",
        "dim",
        F.when(found & done, cut).otherwise(F.col("cut")).alias("cut"),
        "wanted",
        F.when(found, before).otherwise(F.col("below")).alias("below"),
        F.when(found, F.col("_bin")).otherwise(F.col("prefix")).alias("prefix"),
        (found & ~done).alias("open"),
    )


def _children(level: DataFrame) -> DataFrame:
    """The nodes of the next level; a node of one shard hands it to its left child."""
    half = F.when(F.col("leaves") > 1, F.floor(F.col("leaves") / 2)).otherwise(F.col("leaves")).cast("int")
    left = F.struct(
        (F.col("node") * 2 + 1).alias("node"), F.col("first").alias("first"), half.alias("leaves")
    )
    right = F.struct(
        (F.col("node") * 2 + 2).alias("node"),
        (F.col("first") + half).alias("first"),
        (F.col("leaves") - half).alias("leaves"),
    )
    return level.select(F.inline(F.array(left, right)))


def kd_tree_shards(
    rows: DataFrame,
    size: str,
    dims: list[Column],
    identity: list[str],
    shards: int,
    slack: float = 0.0005,
) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1, nearly the same sum of ``size`` each) and a
    gapless ``slot`` in it.

    ``dims`` are numeric metadata; a null counts as the smallest value.  ``identity`` names
    columns that tell rows apart: only rows that agree in all of them are kept together.  A
    median bin of at most ``slack`` times a leaf's bytes is not refined further.  Sizes must
    not be null or negative.  Fewer rows than shards leave shards empty; an empty table has none.
    Rows are read some times a level, so they should be a stored or checkpointed table.
    Columns named ``shard`` or ``slot`` are replaced.
    """
    rows = rows.drop("shard", "slot")
    own = [f"_id{i}" for i in range(len(identity))]
    names = [F.col(name).alias(o) for name, o in zip(identity, own, strict=True)]
    bounds = rows.agg(
        *[F.min(d.cast("double")).alias(f"min{i}") for i, d in enumerate(dims)],
        *[F.max(d.cast("double")).alias(f"max{i}") for i, d in enumerate(dims)],
        F.count(F.lit(1)).alias("rows"),
        F.sum(size).alias("bytes"),
    ).first()
    top = (1 << PLACE_BITS) - 1
    keys = []
    for i, d in enumerate(dims):
        low, high = bounds[f"min{i}"], bounds[f"max{i}"]
        wide = low is not None and high > low
        place = (
            F.floor((d.cast("double") - low) / (high - low) * top) if wide else F.lit(0)
        ).cast("long")
        place = F.least(F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)), F.lit(top))
        spread = F.shiftrightunsigned(F.xxhash64(*identity, F.lit(i)), 64 - (KEY_BITS - PLACE_BITS))
        key = F.shiftleft(place, KEY_BITS - PLACE_BITS).bitwiseOR(spread)
        keys.append(key.alias(f"_key{i}"))
    keyed = rows.select(F.struct("*").alias("_row"), F.col(size).alias("_size"), *names, *keys)
    near = slack * (bounds["bytes"] or 0) / shards
    level = rows.sparkSession.range(1).select(
        F.lit(0).alias("node"), F.lit(0).alias("first"), F.lit(shards).alias("leaves")
    )
    at = keyed.select("_size", *[f"_key{d}" for d in range(len(dims))], F.lit(0).alias("_node"))
    tree, depth = None, (shards - 1).bit_length()
    for done in range(depth):
        start, known = (1 << done) - 1, 0
        at = checkpointed(at)
        level = checkpointed(_measured(at, level, len(dims)))
        while known < KEY_BITS and not level.filter("open").isEmpty():
            level = checkpointed(_refined(at, level, len(dims), start, known, near))
            known += STEP_BITS
        cuts = level.select("node", "dim", "cut")
        tree = cuts if tree is None else checkpointed(tree.unionByName(cuts))
        at = _descended(at, _array(cuts, "dim", "cut"), len(dims), start)
        level = _children(level)
    placed = keyed.withColumn("_node", F.lit(0))
    for _ in range(depth):
        placed = _descended(placed, _array(tree, "dim", "cut"), len(dims))
    leaf = F.get(_array(checkpointed(level), "first"), F.col("_node") - ((1 << depth) - 1))
    # Written, so that no filter above repeats the way down.
    placed = checkpointed(placed.select("_row", *own, leaf["first"].alias("shard")))
    buckets = max(1, bounds["rows"] // ROWS_PER_BUCKET)
    found = numbered(placed, "shard", own, "slot", buckets)
    return found.select("_row.*", "shard", "slot")


def document_metadata(docs: DataFrame) -> DataFrame:
    """What the tree needs of documents, read from the texts once: ``size`` is the text's UTF-8
    bytes (none for null) plus 16."""
    body = F.coalesce("text", F.lit(""))
    return checkpointed(
        docs.select(
            "doc_id",
            (F.octet_length(body) + 16).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.crc32(F.coalesce("source", F.lit(""))).alias("source_code"),
            F.crc32(F.coalesce("lang", F.lit(""))).alias("lang_code"),
        )
    )
