"""Readers and writers for entity files and result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketry.sources import schemas
from basketry.sources.arrays import read_records


def read_entity(
    spark: SparkSession,
    entity: str,
    paths: str | Sequence[str],
    layout: str = "objects",
    documents: bool = False,
) -> DataFrame:
    """JSON files of one entity, numbers and booleans as text (``schemas.RAW``).

    ``layout`` is what the caller knows of the files: ``lines``, one record per line, which Spark's
    own reader splits, or ``objects``, an array of records or a run of them, on any number of
    lines, which is read in two scans by as many tasks as the files have blocks.  A record that is
    no JSON, or of another shape, makes the job fail: nothing is read as nulls in its place.
    Empty files have no records.

    With ``documents`` each row keeps its whole record as a VARIANT in ``document``, which is stored
    with the table, so fields that the schema does not have can be read later with `field`.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = schemas.RAW[entity]
    if layout not in ("lines", "objects"):
        raise ValueError(f"layout is lines or objects, not {layout}")
    if layout == "lines" and not documents:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)
    if layout == "lines":
        lines = spark.read.text(paths).select(F.col("value").alias("record"))
        records = lines.filter(F.trim("record") != "")
    else:
        records = read_records(spark, paths)
    parsed = F.from_json("record", schema, {"mode": "FAILFAST"}).alias("r")
    whole = [F.parse_json("record").alias("document")] if documents else []
    return records.select(parsed, *whole).select("r.*", *(["document"] if documents else []))


def field(path: str, kind: str, document: str = "document") -> Column:
    """The field at a path such as ``$.campaign.code`` of a kept document; null where it is absent or
    no ``kind``."""
    return F.try_variant_get(document, path, kind)


def load_sessions(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: str = "objects",
    documents: bool = False,
) -> DataFrame:
    """All session chunk files (a glob, a directory or a list) as one table."""
    return read_entity(spark, "sessions", paths, layout, documents)


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet table at ``path``, or None when nothing is there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def to_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    counts: Sequence[Column] = (),
    bloom: Sequence[str] = (),
) -> dict[str, int]:
    """Replace the table at ``path``; the number of ``rows`` written and the aggregates ``counts`` of them.

    The counts are taken by the tasks that write, so nothing is read again.  Columns in ``bloom`` get a
    Bloom filter in every row group, for equality reads of values that are spread over the table.
    """
    seen = Observation()
    writer = df.observe(seen, F.count("*").alias("rows"), *counts).write.mode("overwrite")
    for name in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.partitionBy(*partition_by).parquet(path)
    return seen.get


def to_json_records(df: DataFrame, path: str) -> None:
    """Replace the JSON records at ``path``, written by the executors, with ISO dates."""
    df.write.mode("overwrite").json(path)


def to_keyed_parquet(
    df: DataFrame,
    path: str,
    key: str = "row_key",
    partition_by: Sequence[str] = (),
    bloom: Sequence[str] = (),
) -> dict[str, int]:
    """Replace the keyed table at ``path``, laid out in key order, in folders by
    ``partition_by`` where given.

    Range partitioning on the full key gives every file a narrow key range, so range
    scans and point lookups skip files by their Parquet statistics, and one busy user
    or product spreads over several files instead of filling one task.  Counts and ``bloom`` as in
    `to_parquet`.
    """
    order = [*partition_by, key]
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return to_parquet(ordered, path, partition_by, bloom=bloom)
