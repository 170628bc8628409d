"""Timestamp expressions for zone-less source data (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parsed(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a timestamp: ISO text is parsed (null when malformed), with or
    without fractional seconds; timestamp columns pass through."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def whole_days_between(first: Column, last: Column) -> Column:
    """Full 24-hour days from ``first`` to ``last``, rounded down."""
    micros = F.unix_micros(last) - F.unix_micros(first)
    return F.floor(micros / F.lit(86_400_000_000.0)).cast("bigint")
