"""Stored tables in folders, changed in place by batches.

A table lies in folders by some of its columns: by the range its key falls in, or by day or
month.  A batch changes the folders its own rows belong to: only those are read, merged and
written again, by Spark's dynamic partition overwrite, and the files of all others stay as
they are.  The job's new files replace a folder's old ones when all of them are written, so
a lost executor costs its tasks and a failed job changes nothing it has not committed.

A merge that was cut off while folders were being replaced is run again with the same batch.
Writing the last values twice gives the same rows; batches that add to what is stored carry a
number, and folders that have it already are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.keyed import upsert_latest
from basketry.sources.shared import stored

RANGE = "key_range"
#: A batch's folders are named one by one in the filter of the read up to this number.
NAMED_FOLDERS = 10_000

Combine = Callable[[DataFrame, DataFrame], DataFrame]


def key_borders(df: DataFrame, key: str, ranges: int) -> list[str]:
    """Borders, ``ranges`` - 1 at most, between which about as many rows lie."""
    dealt = df.filter(F.col(key).isNotNull()).select(key).repartitionByRange(ranges, key)
    least = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("least"))
    return sorted(row["least"] for row in least.collect())[1:]  # one row a range


def key_range(key: str, borders: Sequence[str]) -> Column:
    """The number of the range that the key lies in, by halving the borders; 0 for null."""

    def side(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(key) < F.lit(borders[middle]), side(low, middle)).otherwise(
            side(middle + 1, high)
        )

    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(side(0, len(borders))).cast("int")


def _write(df: DataFrame, path: str, folders: Sequence[str], order: Sequence[str], mode: str) -> None:
    """Rows of a folder spread over several files by their order, a busy folder too."""
    by = [*folders, *order]
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(*folders).parquet(path)


def create_folders(
    df: DataFrame, path: str, folders: Sequence[str], order: Sequence[str] = ()
) -> None:
    """Replace the table at ``path``, in folders by ``folders`` and sorted by ``order``."""
    _write(df, path, folders, order, "static")


def read_folders(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``; its columns keep the types and order of ``schema``."""
    return spark.read.schema(schema).parquet(path).select([f.name for f in schema])


def touched_folders(batch: DataFrame, folders: Sequence[str]) -> list[tuple]:
    """The folders that rows of ``batch`` belong to."""
    return [tuple(row) for row in batch.select(*folders).distinct().collect()]  # one row a folder


def _in_folders(table: DataFrame, folders: Sequence[str], names: list[tuple]) -> DataFrame:
    """Rows of the named folders; other folders' files are not opened."""
    if len(names) > NAMED_FOLDERS:
        raise ValueError(f"a batch of {len(names)} folders: rebuild the table instead")
    if len(folders) == 1:
        return table.filter(F.col(folders[0]).isin([name[0] for name in names]))
    same = F.lit(False)
    for name in names:
        one = F.lit(True)
        for column, value in zip(folders, name, strict=True):
            one &= F.col(column) == F.lit(value)
        same |= one
    return table.filter(same)


def merge_folders(
    batch: DataFrame,
    path: str,
    folders: Sequence[str],
    combine: Combine,
    order: Sequence[str] = (),
) -> list[tuple]:
    """Replace each folder that ``batch`` touches by ``combine(its stored rows, batch)``; the folders' names.

    ``batch`` has the columns of the table; its folder columns are not null.  ``combine`` gets the stored rows
    of the touched folders, none where a folder is new, and returns rows of these folders only.  It must keep at
    least one row of each folder: a folder without new rows would keep its old ones.  The batch is
    stored first, since it is read twice.
    """
    spark = batch.sparkSession
    batch = stored(batch, "batch")
    names = touched_folders(batch, folders)
    if not names:
        return []
    old = _in_folders(read_folders(spark, path, batch.schema), folders, names)
    merged = combine(old, batch).select(batch.columns)
    _write(merged, path, folders, order, "dynamic")
    return sorted(names)


class KeyedTable:
    """A table with a string key, stored in folders by key range.

    Borders are chosen from the rows the table is created with and kept beside it, so a key's folder
    never changes.  ``seq`` is a column that orders writes.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "row_key", seq: str = "written"):
        self.spark, self.path, self.key, self.seq = spark, path, key, seq

    def create(self, df: DataFrame, ranges: int = 64) -> None:
        """Replace the table by ``df``, a row for each key."""
        df = stored(df, "table")
        borders = key_borders(df, self.key, ranges)
        rows = df.withColumn(RANGE, key_range(self.key, borders))
        create_folders(rows, self.path, [RANGE], [self.key])
        # Readers pass over names that begin with an underscore.
        kept = self.spark.createDataFrame([(i, b) for i, b in enumerate(borders)], "place int, border string")
        kept.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_borders")

    def borders(self) -> list[str]:
        rows = self.spark.read.schema("place int, border string").parquet(f"{self.path}/_borders")
        return [row["border"] for row in rows.orderBy("place").collect()]  # one row a range

    def read(self) -> DataFrame:
        """The rows, with the folder column last, for pushed key filters."""
        return self.spark.read.parquet(self.path)

    def merge(self, batch: DataFrame, combine: Combine | None = None) -> list[tuple]:
        """Write ``batch`` over the table and return the ranges that were rewritten.

        By default each cell takes its last value that is not null, by ``seq``, and keys that are
        not stored yet are added: the same as writing all rows of table and batch anew.
        """
        seq, key = self.seq, self.key

        def last_cells(old: DataFrame, new: DataFrame) -> DataFrame:
            return upsert_latest(old.unionByName(new), key, seq, constant=[RANGE])

        rows = batch.withColumn(RANGE, key_range(key, self.borders()))
        return merge_folders(rows, self.path, [RANGE], combine or last_cells, [key])
