"""Line dedup by site-relative frequency.

A line that a large part of a host's pages contain is boilerplate of that host.  A page is
a distinct text here: copies of one page are one page, so a page that was fetched many
times keeps its lines.  Lines are compared by two 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import checkpointed, free_name

#: Boilerplate lines, over all hosts, up to which they are sent to every executor (about 16 bytes each).
BROADCAST_LINES = 200_000


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate_lines(
    docs: DataFrame, host: str, text: str, max_ratio: float, min_times: int
) -> DataFrame:
    """``host`` and its array ``drop`` of line keys; it has at most (mean lines of a page) / ratio."""
    pages = (
        docs.filter(F.col(host).isNotNull() & F.col(text).isNotNull())
        .select(
            F.col(host).alias("host"),
            F.xxhash64(text).alias("page_a"),
            F.xxhash64(F.lit("page"), F.col(text)).alias("page_b"),
            F.array_distinct(
                F.transform(F.filter(F.split(text, "\n"), _has_word), _key)
            ).alias("lines"),
        )
        .dropDuplicates(["host", "page_a", "page_b"])
    )
    pages = checkpointed(pages.select("host", "lines"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = (
        pages.select("host", F.explode("lines").alias("line"))
        .groupBy("host", "line.a", "line.b")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_times)
    )
    return (
        counts.join(totals, "host")
        .filter(F.col("n") > max_ratio * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list(F.struct("a", "b")).alias("drop"))
    )


def line_dedup(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = 0.1,
    min_times: int = 3,
) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and ``n_lines`` and ``n_removed``.

    A line goes if more than ``max_ratio`` of its host's pages contain it, and ``min_times`` of them
    at least: on a host of few pages one page, or a pair, is a large part of them.  Lines without
    a word are kept as they are, and the others keep their order.  No row is dropped: a text of
    boilerplate alone becomes empty, a null text stays null with no lines.  Rows with a null host
    are left as they are.  Repeated rows are all
    returned.  Columns named ``n_lines`` or ``n_removed`` are replaced; others come back unchanged.
    """
    docs = docs.drop("n_lines", "n_removed")
    found = checkpointed(boilerplate_lines(docs, host, text, max_ratio, min_times))
    size = found.agg(F.sum(F.size("drop"))).first()[0] or 0
    drop, of = free_name(docs, "drop"), free_name(docs, "host_of")
    found = found.select(F.col("host").alias(of), F.col("drop").alias(drop))
    if size <= BROADCAST_LINES:
        found = F.broadcast(found)
    joined = docs.join(found, F.col(host) == F.col(of), "left")
    parts, kept = free_name(joined, "parts"), free_name(joined, "kept")
    stays = lambda line: ~(
        _has_word(line) & F.array_contains(F.col(drop), _key(line))
    )
    joined = joined.withColumn(parts, F.split(text, "\n")).withColumn(
        kept, F.when(F.col(drop).isNull(), F.col(parts)).otherwise(F.filter(parts, stays))
    )
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    return joined.withColumns(
        {
            text: F.when(count(kept) == count(parts), F.col(text)).otherwise(
                F.array_join(kept, "\n")
            ),
            "n_lines": F.greatest(count(parts), F.lit(0)),
            "n_removed": count(parts) - count(kept),
        }
    ).select(*docs.columns, "n_lines", "n_removed")
