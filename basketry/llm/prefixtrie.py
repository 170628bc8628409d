"""Conversation prefix trie, built as a burst trie.

Conversations are sequences of turn ids.  Equal ones are one sequence with a count.  All
sequences begin in one container under the root.  A container with too many turns bursts:
the turns that all its members share become a chain of trie heads, and the members are
dealt to smaller containers by the next turn id.  A container with one sequence is a chain
of nodes as it stands.  The remaining containers are dealt to shards, where each one's
suffixes are sorted and swept into nodes.  Leaves and tokens found in a container count for
all heads above it.

Turns stay rows of their own until their container is small, so neither a long conversation
nor a first turn that a third of all conversations begin with meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import WORD_BREAK, checkpointed

#: Turns of a container above which it bursts, turns of a shard, and turns of a numbering block.
BURST, SHARD_TURNS, BLOCK = 10_000, 100_000, 256
#: Conversation ids next to each other that are joined to one text before groups are hashed.
ID_BITS = 10
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ended bigint"


def _numbered(turns: DataFrame) -> DataFrame:
    """``turns`` with ``seq`` from 0, by blocks of turn numbers, so no task orders a whole conversation."""
    blocks = turns.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("rows"))
    earlier = (
        Window.partitionBy("conv")
        .orderBy(F.col("block").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = blocks.select(
        F.col("conv").alias("of"),
        F.col("block").alias("of_block"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
    )
    within = Window.partitionBy("conv", "block").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text", "a", "b"
    )
    same = (F.col("conv") == F.col("of")) & F.col("block").eqNullSafe(F.col("of_block"))
    return (
        turns.withColumn("at", F.row_number().over(within) - 1)
        .join(starts, same)
        .select("conv", (F.col("before") + F.col("at")).alias("seq"), "a", "b", "words")
    )


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv``, ``seq`` from 0, the turn id ``a``, ``b`` and the ``words`` of its text."""
    blank = F.lit("")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    given = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        # Turns of one number go by the beginnings of role and text, and by hashes of the whole.
        F.left(role, F.lit(64)).alias("role"),
        F.left(text, F.lit(64)).alias("text"),
        F.xxhash64(role, F.lit("\n"), text).alias("a"),
        F.xxhash64(F.lit("turn"), text, role).alias("b"),
        F.size(F.array_remove(F.split(text, WORD_BREAK), "")).cast("long").alias("words"),
    )
    return _numbered(given.withColumn("block", F.floor(F.col("turn") / BLOCK)))


def rebuilt(turns: DataFrame, head: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """Turns, and all ids, of conversations whose first ``head`` turns are those of ``base``.

    ``head`` and ``base`` are expressions of ``conv``; ``head`` is small.
    """
    ids = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("rows"))
    ids = ids.withColumn("h", head).withColumn("base", base)
    sizes = ids.select(F.col("conv").alias("base_conv"), F.col("rows").alias("base_rows"))
    ids = checkpointed(
        ids.join(sizes, F.col("base") == F.col("base_conv"), "left").select(
            "conv", "h", "base", F.least("h", F.coalesce("base_rows", F.lit(0))).alias("taken")
        )
    )
    own = turns.withColumn("h", head).filter("seq >= h")
    own = own.join(ids.select(F.col("conv").alias("of"), "taken"), F.col("conv") == F.col("of"))
    own = own.select("conv", (F.col("seq") - F.col("h") + F.col("taken")).alias("seq"), "a", "b", "words")
    first = turns.select(F.col("conv").alias("from"), "seq", "a", "b", "words")
    lent = first.join(ids, (F.col("from") == F.col("base")) & (F.col("seq") < F.col("h")))
    return own.unionByName(lent.select(own.columns)), ids.select("conv")


def _with_word_sums(turns: DataFrame) -> DataFrame:
    """``turns`` with the ``upto`` words from the conversation's begin to each turn's end."""
    turns = turns.withColumn("block", F.floor(F.col("seq") / BLOCK))
    earlier = (
        Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        turns.groupBy("conv", "block")
        .agg(F.sum("words").alias("sum"))
        .select(
            F.col("conv").alias("of"),
            F.col("block").alias("of_block"),
            F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"),
        )
    )
    within = Window.partitionBy("conv", "block").orderBy("seq")
    return (
        turns.withColumn("upto", F.sum("words").over(within))
        .join(starts, (F.col("conv") == F.col("of")) & (F.col("block") == F.col("of_block")))
        .select("conv", "seq", "a", "b", "words", (F.col("before") + F.col("upto")).alias("upto"))
    )


def _classes(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv``, the smallest id ``rep`` of the conversations with the same turns, and their number."""
    marks = turns.groupBy("conv").agg(
        F.count(F.lit(1)).alias("turns"),
        F.bit_xor(F.xxhash64("seq", "a", "b")).alias("x"),
        F.bit_xor(F.xxhash64("b", "seq", "a")).alias("y"),
    )
    marks = ids.join(marks, "conv", "left").select(
        "conv", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("turns", "x", "y")]
    )
    marks = checkpointed(marks)
    same = ["turns", "x", "y"]
    found = marks.groupBy(*same).agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n"))
    return checkpointed(marks.join(found, same).select("conv", "rep", "n", "turns"))


def ends_hashes(classes: DataFrame) -> DataFrame:
    """``rep`` and the digest of its class's ids in numeric order, joined by commas.

    Ids of a narrow range are joined first.  A class of many ranges is hashed range after range
    as a stream, so its ids are never one value.
    """
    near = (
        classes.groupBy("rep", F.shiftright("conv", ID_BITS).alias("range"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"))
    )
    near = checkpointed(near)
    ranges = near.groupBy("rep").agg(F.count(F.lit(1)).alias("ranges"))
    single = ranges.filter("ranges = 1").select("rep").join(near, "rep")
    several = near.join(ranges.filter("ranges > 1").select("rep"), "rep", "left_semi")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rep, digest = None, None
        done: list[tuple[int, str]] = []
        for batch in batches:
            for rep, ids in zip(batch["rep"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if rep != open_rep:
                    if digest is not None:
                        done.append((open_rep, digest.hexdigest()))
                    open_rep, digest = rep, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _digests(done)
            done = []
        if digest is not None:
            yield _digests([(open_rep, digest.hexdigest())])

    ordered = several.repartition("rep").sortWithinPartitions("rep", "range").select("rep", "ids")
    streamed = ordered.mapInArrow(stream, "rep bigint, ends_sha256 string")
    return single.select("rep", F.sha2("ids", 256).alias("ends_sha256")).unionByName(streamed)


def _digests(rows: list[tuple[int, str]]) -> pa.RecordBatch:
    reps, hashes = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(reps, pa.int64()), pa.array(hashes, pa.string())], names=["rep", "ends_sha256"]
    )


Sequence = tuple[tuple, int, int, list[int]]


def sweep(sequences: list[Sequence], depth: int, up: int | None) -> list[tuple]:
    """Nodes, from ``depth`` on, of a container's ``sequences``: turn ids, the smallest conversation,
    their number, and words of each turn.  All share the first turn, a node of depth ``depth`` under
    the node of ``up``.

    The sorted sequences are read once; open nodes are a stack, and a node closes when a sequence
    leaves it, handing its counts to the one below.
    """
    nodes: list[tuple] = []
    # conv, members, children, leaves, saved below, ended, words
    stack: list[list] = []

    def close(to: int) -> None:
        while len(stack) > to:
            conv, n, children, leaves, saved, ended, words = stack.pop()
            leaves, saved = leaves or 1, saved + (n - 1) * words
            nodes.append((conv, depth + len(stack), n, children, leaves, saved, ended))
            if stack:
                over = stack[-1]
                over[0], over[1] = min(over[0], conv), over[1] + n
                over[2], over[3], over[4] = over[2] + 1, over[3] + leaves, over[4] + saved

    before: tuple = ()
    for ids, conv, n, words in sorted(sequences):
        shared = 0
        while shared < min(len(before), len(ids)) and before[shared] == ids[shared]:
            shared += 1
        close(shared)
        for place in range(shared, len(ids)):
            stack.append([conv, 0, 0, 0, 0, None, words[place]])
        top = stack[-1]
        top[0], top[1], top[5] = conv, n, conv
        before = ids
    close(0)
    # A node's parent is the next one in the list that is less deep.
    parents: list[int | None] = []
    above: dict[int, int] = {}
    for conv, at, *_ in reversed(nodes):
        above[at] = conv
        parents.append(above.get(at - 1, up))
    return [
        (conv, at, parent, *rest)
        for (conv, at, *rest), parent in zip(nodes, reversed(parents), strict=True)
    ]


def _swept(rows: DataFrame, total: int) -> DataFrame:
    """Nodes of all containers (``top``, ``depth``, ``up``) whose members' turns are ``rows``."""
    names = [column.split()[0] for column in NODE.split(", ")]

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("top", "depth", "rep", "seq")])
        found: list[tuple] = []
        held: list[Sequence] = []
        last = None
        columns = (table[c].to_pylist() for c in ("top", "depth", "up", "rep", "n", "a", "b", "words"))
        ids: list = []
        sizes: list[int] = []
        for top, depth, up, rep, n, a, b, words in zip(*columns, strict=True):
            if last != (top, depth, up, rep, n):
                if last is not None:
                    held.append((tuple(ids), last[3], last[4], sizes))
                    if last[:2] != (top, depth):
                        found += sweep(held, last[1], last[2])
                        held = []
                last, ids, sizes = (top, depth, up, rep, n), [], []
            ids.append((a, b))
            sizes.append(words)
        if last is not None:
            held.append((tuple(ids), last[3], last[4], sizes))
            found += sweep(held, last[1], last[2])
        columns = zip(*found, strict=True) if found else [()] * len(names)
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    shards = F.lit(total // SHARD_TURNS + 1)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("top", "depth"), shards))
    return dealt.groupBy("shard").applyInArrow(work, NODE)


def _containers(members: DataFrame) -> DataFrame:
    """Of each container its smallest member ``top``, what it holds, and whether it is to be swept."""
    return members.groupBy("top", "depth").agg(
        F.max("up").alias("up"),
        F.max("path").alias("path"),
        F.count(F.lit(1)).alias("reps"),
        F.sum("n").alias("n_convs"),
        # The turn of the container's own node is read as well.
        F.sum(F.col("turns") - F.col("depth") + 1).alias("held"),
    )


def prefix_trie(
    turns: DataFrame, ids: DataFrame, burst: int = BURST
) -> DataFrame:
    """A row for each node of the trie over the conversations ``ids`` (``conv``) with ``turns`` (``conv``,
    ``seq`` from 0, turn id ``a`` and ``b``, ``words``): ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``.  Without conversations there are no nodes.
    """
    turns = checkpointed(turns)
    classes = _classes(turns, ids)
    ends = ends_hashes(classes)
    reps = classes.filter("conv = rep").select("rep", "n", "turns")
    kept = turns.join(reps.select(F.col("rep").alias("conv")), "conv", "left_semi")
    kept = checkpointed(_with_word_sums(kept).withColumnRenamed("conv", "rep"))

    whole = classes.agg(F.min("rep").alias("top"), F.count(F.lit(1)).alias("n_convs")).first()
    spark = turns.sparkSession
    if whole["top"] is None:
        return spark.createDataFrame([], NODE).drop("ended").withColumn("ends_sha256", F.lit(""))
    step = F.struct(F.lit(whole["top"]).alias("top"), F.lit(0).cast("long").alias("depth"))
    path = "array<struct<top:bigint,depth:bigint>>"
    turnless = reps.filter("turns = 0").select(F.min("rep").alias("ended"))
    # Heads: a chain of nodes from ``depth`` to ``until`` with the same members.
    heads = [
        turnless.select(
            F.lit(whole["top"]).alias("top"), F.lit(0).cast("long").alias("depth"),
            F.lit(0).cast("long").alias("until"), F.lit(None).cast("long").alias("up"),
            F.lit(whole["n_convs"]).cast("long").alias("n_convs"), "ended",
            F.lit(0).cast("long").alias("chain"), F.array().cast(path).alias("path"),
        )
    ]
    members = reps.filter("turns > 0").select(
        "rep", "n", "turns", F.lit(whole["top"]).alias("top"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("until"), F.array(step).cast(path).alias("path"),
    )
    lone, ready = [], []
    while True:
        # Deal the members, which share ``until`` turns, by the next one.
        following = kept.select(F.col("rep").alias("of"), "seq", "a", "b")
        at = (F.col("rep") == F.col("of")) & (F.col("seq") == F.col("until"))
        dealt = members.join(following, at)
        by = ["top", "depth", "a", "b"]
        tops = dealt.groupBy(*by).agg(F.min("rep").alias("child"))
        members = checkpointed(
            dealt.join(tops, by).select(
                "rep", "n", "turns", F.col("top").alias("up"), F.col("child").alias("top"),
                (F.col("until") + 1).alias("depth"), "path",
            )
        )
        found = checkpointed(_containers(members))
        lone.append(found.filter("reps = 1"))
        key = ["top", "depth"]
        small = found.filter(f"reps > 1 and held <= {burst}")
        ready.append(members.join(small.select(key), key, "left_semi"))
        large = found.filter(f"reps > 1 and held > {burst}")
        if large.isEmpty():
            break
        # The turns that all members of a large container share.
        held = members.join(large.select(*key, "reps"), key)
        rows = kept.join(held.select("rep", *key, "reps"), "rep").filter("seq >= depth")
        split = (
            rows.groupBy(*key, "seq")
            .agg(
                F.count(F.lit(1)).alias("there"), F.max("reps").alias("reps"),
                F.min(F.struct("a", "b")).alias("low"), F.max(F.struct("a", "b")).alias("high"),
            )
            .filter("there < reps or low <> high")
            .groupBy(*key)
            .agg(F.min("seq").alias("first"))
        )
        # Sequences differ, so the longest goes on where another one ends.
        until = split.select(*key, F.col("first").alias("until"))
        ended = held.join(until, key).filter("turns = until").select(*key, F.col("rep").alias("ended"))
        edge = kept.select(F.col("rep").alias("top"), "seq", "upto", "words")
        begins = edge.select("top", (F.col("seq") + 1).alias("depth"), (F.col("upto") - F.col("words")).alias("start"))
        stops = edge.select("top", (F.col("seq") + 1).alias("until"), F.col("upto").alias("stop"))
        chains = (
            large.join(until, key).join(ended, key, "left").join(begins, key).join(stops, ["top", "until"])
        )
        chains = checkpointed(
            chains.select(
                *key, "until", "up", "n_convs", "ended",
                ((F.col("n_convs") - 1) * (F.col("stop") - F.col("start"))).alias("chain"), "path",
            )
        )
        heads.append(chains)
        own = F.array(F.struct("top", "depth")).cast(path)
        members = checkpointed(
            members.join(chains.select(*key, "until"), key)
            .filter("turns > until")
            .withColumn("path", F.concat("path", own))
            .select("rep", "n", "turns", *key, "until", "path")
        )
    return _nodes(checkpointed(_union(heads)), _union(lone), _union(ready), kept, ends)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _nodes(
    heads: DataFrame, lone: DataFrame, ready: DataFrame, kept: DataFrame, ends: DataFrame
) -> DataFrame:
    """All nodes: swept ones, chains of single sequences, and heads with the sums of what is below."""
    names = [column.split()[0] for column in NODE.split(", ")]
    ready = checkpointed(ready)
    rows = ready.join(kept, "rep").filter("seq >= depth - 1").select(
        "top", "depth", "up", "rep", "n", "seq", "a", "b", "words"
    )
    total = ready.agg(F.sum(F.col("turns") - F.col("depth") + 1)).first()[0] or 0
    swept = checkpointed(_swept(rows, total))
    paths = ready.select("top", "depth", "path").groupBy("top", "depth").agg(F.max("path").alias("path"))

    last = kept.groupBy(F.col("rep").alias("top")).agg(F.max("upto").alias("stop"), F.max("seq").alias("last"))
    chain = (
        lone.join(last, "top")
        .join(kept.withColumnRenamed("rep", "top"), "top")
        .filter("seq >= depth - 1")
        .select(
            F.col("top").alias("conv_id"),
            (F.col("seq") + 1).alias("depth"),
            F.when(F.col("seq") >= F.col("depth"), F.col("top")).otherwise(F.col("up")).alias("parent_conv_id"),
            "n_convs",
            (F.col("seq") < F.col("last")).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * (F.col("stop") - F.col("upto") + F.col("words"))).alias("saved_tokens"),
            F.when(F.col("seq") == F.col("last"), F.col("top")).alias("ended"),
            F.when(F.col("seq") == F.col("depth") - 1, F.col("path")).alias("path"),
        )
    )
    chain = checkpointed(chain)
    # What each container, and each head's own chain, adds to the heads above.
    tops = swept.join(
        paths, (F.col("conv_id") == F.col("top")) & (swept["depth"] == paths["depth"])
    ).select("path", "n_leaves", "saved_tokens")
    below = tops.unionByName(
        chain.filter("path is not null").select("path", "n_leaves", "saved_tokens")
    ).unionByName(
        heads.select("path", F.lit(0).cast("long").alias("n_leaves"), F.col("chain").alias("saved_tokens"))
    )
    sums = (
        below.select(F.explode("path").alias("over"), "n_leaves", "saved_tokens")
        .groupBy(F.col("over.top").alias("top"), F.col("over.depth").alias("depth"))
        .agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    )
    # The children of a head's last node are containers and heads whose path ends in it.
    kids = paths.select("path").unionByName(
        chain.filter("path is not null").select("path")
    ).unionByName(heads.filter(F.size("path") > 0).select("path"))
    kids = (
        kids.select(F.try_element_at("path", F.lit(-1)).alias("over"))
        .groupBy(F.col("over.top").alias("top"), F.col("over.depth").alias("depth"))
        .agg(F.count(F.lit(1)).alias("kids"))
    )
    key = ["top", "depth"]
    heads = heads.join(sums, key, "left").join(kids, key, "left")
    upto = kept.select(F.col("rep").alias("of"), "seq", "upto", "words")
    # A node for each depth of the chain; the root has no turn.
    each = heads.withColumn("d", F.explode(F.sequence("depth", "until")))
    each = each.join(upto, (F.col("top") == F.col("of")) & (F.col("seq") == F.col("d") - 1), "left")
    first = heads.select(F.col("top").alias("h_top"), F.col("depth").alias("h_depth"), "chain")
    before = upto.select(F.col("of").alias("b_of"), (F.col("seq") + 1).alias("b_depth"), (F.col("upto") - F.col("words")).alias("start"))
    each = each.join(
        before, (F.col("top") == F.col("b_of")) & (F.col("depth") == F.col("b_depth")), "left"
    )
    spent = F.coalesce((F.col("n_convs") - 1) * (F.col("upto") - F.col("words") - F.col("start")), F.lit(0))
    headed = each.select(
        F.col("top").alias("conv_id"),
        F.col("d").alias("depth"),
        F.when(F.col("d") > F.col("depth"), F.col("top")).otherwise(F.col("up")).alias("parent_conv_id"),
        "n_convs",
        F.when(F.col("d") < F.col("until"), F.lit(1)).otherwise(F.coalesce("kids", F.lit(0))).cast("long").alias("n_children"),
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
        (F.coalesce("saved", F.lit(0)) + F.col("chain") - spent).alias("saved_tokens"),
        F.when(F.col("d") == F.col("until"), F.col("ended")).alias("ended"),
    )
    nodes = swept.select(names).unionByName(chain.select(names)).unionByName(headed.select(names))
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(
        ends.withColumnRenamed("rep", "ended"), "ended", "left"
    ).select(*names[:-1], F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def conversation_trie(
    conversations: DataFrame, head: Column, base: Column, burst: int = BURST
) -> DataFrame:
    """The trie of `prefix_trie` over ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``), each
    rebuilt: its first ``head`` turns are those of conversation ``base`` (all if it has fewer, none if
    it is absent), then come its own turns after its first ``head``.  Both are expressions of ``conv``.

    Turns go by ``turn`` (null first), ties by the first 64 characters of role and of text, then by
    hashes; repeated rows are turns of their own.  A null role or text is an empty one.  Turns are
    equal if role and text are (by two 64-bit hashes).  Rows with a null ``conv_id`` belong to no
    conversation and are left out.  A conversation without turns is a member of the root.  Other columns
    are left out, an empty table has no nodes.
    """
    turns, ids = rebuilt(checkpointed(turn_rows(conversations)), head, base)
    return prefix_trie(turns, ids, burst)
