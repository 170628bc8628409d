"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.sources.shared import new_folder, shared_folder, unique_name

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The maximal runs of characters other than ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


@contextmanager
def _shuffles_removed(session: SparkSession) -> Iterator[None]:
    """Shuffle files of what is planned and run here go when it ends, not when the driver's garbage does."""
    before = session.conf.get(CLEANUP)
    session.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        session.conf.set(CLEANUP, before)


class Workspace:
    """Tables that a job writes and reads on its way, in a database of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def store(self, df: DataFrame, table: str) -> DataFrame:
        """``df`` written, after what the table holds already, and the whole table read back."""
        with _shuffles_removed(self.spark):
            df.select("*").write.mode("append").saveAsTable(f"{self.name}.{table}", format="parquet")
        return self.spark.table(f"{self.name}.{table}")

    def drop(self, *tables: str) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE {self.name}.{table}")


@contextmanager
def workspace(spark: SparkSession) -> Iterator[Workspace]:
    """A `Workspace` below the shared folder; its tables and files go with it."""
    name = unique_name("work")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, 'work')}'")
    try:
        yield Workspace(spark, name)
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the cluster's shared checkpoint folder.

    The folder is the session's ``spark.checkpoint.dir``.  Only where none is set and all run on
    one machine, as in tests, a temporary folder is used; on a cluster that raises.  The shuffle files that led to it are
    no longer needed then and are removed at once, not when the driver's garbage is.
    """
    session = df.sparkSession
    context = session.sparkContext
    if not context.getConf().get("spark.checkpoint.dir") and not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(session))
    with _shuffles_removed(session):
        return df.select("*").checkpoint()  # the setting counts where a plan is made


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (case is ignored)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, group: str, order: list[str], number: str, buckets: int) -> DataFrame:
    """``df`` with a gapless ``number`` from 0 within each ``group``.

    A group may hold most rows, so no task sorts a whole group: rows are dealt to
    ``buckets`` by a hash of the ``order`` columns, counted per group and bucket, and
    numbered within their bucket from the count of the buckets before.  The buckets
    depend on the rows alone, so a recomputed task numbers its rows as before.
    """
    bucket, before = "_bucket", "_before"
    spread = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = spread.groupBy(group, bucket).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("_group"),
        F.col(bucket).alias("_of"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(before),
    )
    within = Window.partitionBy(group, bucket).orderBy(*order)
    return (
        spread.withColumn("_place", F.row_number().over(within) - 1)
        .join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col(bucket) == F.col("_of")))
        .withColumn(number, F.col(before) + F.col("_place"))
        .drop("_place", "_group", "_of", before, bucket)
    )
