"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Source timestamps carry no zone.
    "spark.sql.session.timeZone": "UTC",
    # Sums that overflow raise.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where the next aggregation would have reused its
    # partitioning: one shuffle more, instead of one task with a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffled rows of one task.  Lines sorted for a join and then held in the maps of two or
    # three aggregations take some twelve times that; the default of 64 MB takes too much.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
