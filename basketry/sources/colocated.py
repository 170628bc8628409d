"""Parents and their children (orders and lines) stored in one layout, so that they join without a shuffle.

Both tables are bucketed by the parent's key into the same number of buckets.  A bucket is one
task's work, so a key with very many children must not lie in one: the children of such a key,
and rows without a key, are stored apart in plain Parquet, spread over many files.  Reports
join the two parts on their own and take both.  A key is heavy by its number of children alone, and at
most one key in ``heavy`` children can be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.sources.shared import stored

PARENTS, CHILDREN = "parents", "children"
#: Children of one key that a bucket takes; about a hundred MB of lines.
HEAVY = 1_000_000


class Colocated:
    """Two tables under ``path``, known to the catalog as ``name``_parents and ``name``_children.

    The catalog keeps the buckets.  A session whose catalog does not last calls `register`.
    """

    def __init__(self, spark: SparkSession, path: str, name: str, key: str, buckets: int):
        self.spark, self.path, self.name, self.key, self.buckets = spark, path, name, key, buckets

    def create(self, parents: DataFrame, children: DataFrame, heavy: int = HEAVY) -> None:
        """Replace both tables.  The key has one type; parents have one row for each key."""
        key = self.key
        kinds = parents.schema[key].dataType, children.schema[key].dataType
        if kinds[0] != kinds[1]:
            raise ValueError(f"{key} is {kinds[0]} in one table and {kinds[1]} in the other")
        counts = children.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        many = stored(counts.filter(F.col("n") > heavy).select(key), "heavy-keys")
        for table, rows in ((PARENTS, parents), (CHILDREN, children)):
            keyed, keyless = rows.filter(F.col(key).isNotNull()), rows.filter(F.col(key).isNull())
            self._write_buckets(table, keyed.join(many, key, "left_anti").select(rows.columns))
            apart = keyed.join(many, key, "left_semi").select(rows.columns).unionByName(keyless)
            apart.write.mode("overwrite").parquet(self._folder(table, "heavy"))

    def _folder(self, table: str, part: str) -> str:
        return f"{self.path}/{table}/{part}"

    def _write_buckets(self, table: str, rows: DataFrame) -> None:
        writer = rows.repartition(self.buckets, self.key).write.mode("overwrite").format("parquet")
        writer = writer.bucketBy(self.buckets, self.key).sortBy(self.key)
        writer.option("path", self._folder(table, "light")).saveAsTable(f"{self.name}_{table}")

    def register(self, parents: StructType, children: StructType) -> None:
        """Make tables that an earlier session wrote known to this one's catalog."""
        for table, schema in ((PARENTS, parents), (CHILDREN, children)):
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name}_{table} ({schema.toDDL()}) USING parquet "
                f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self._folder(table, 'light')}'"
            )

    def _parts(self, table: str) -> tuple[DataFrame, DataFrame]:
        light = self.spark.table(f"{self.name}_{table}")
        heavy = self.spark.read.schema(light.schema).parquet(self._folder(table, "heavy"))
        return light, heavy

    def read(self, table: str) -> DataFrame:
        """All rows of ``PARENTS`` or ``CHILDREN``."""
        light, heavy = self._parts(table)
        return light.unionByName(heavy)

    def joined(
        self,
        parent_columns: Sequence[str],
        child_columns: Sequence[str],
        only: Column | None = None,
    ) -> DataFrame:
        """Children with columns of their parent, of the parents for which ``only`` holds.

        Buckets are joined as they lie.  Heavy children meet the few heavy parents by a broadcast
        where Spark finds them small, else by a join whose skewed keys are split.
        """
        key = self.key
        found = []
        for parents, children in zip(self._parts(PARENTS), self._parts(CHILDREN), strict=True):
            wanted = parents if only is None else parents.filter(only)
            found.append(
                children.select(key, *child_columns).join(wanted.select(key, *parent_columns), key)
            )
        return found[0].unionByName(found[1])

    def per_key(self, *aggregates: Column) -> DataFrame:
        """Aggregates of children by key: of buckets without a shuffle, of heavy keys with sums before it."""
        light, heavy = [part.groupBy(self.key).agg(*aggregates) for part in self._parts(CHILDREN)]
        return light.unionByName(heavy)
