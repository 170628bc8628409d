"""Row keys whose string order is the order a range read wants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The largest 64-bit integer, its number of digits, and the key separator.
MAX_LONG = 9223372036854775807
MAX_LONG_DIGITS = 19
SEPARATOR = "#"

# Wide enough for any position, because lpad cuts longer text.
POSITION_DIGITS = 19


def reverse_timestamp(ts: Column) -> Column:
    """Zero-padded text that sorts the newest timestamp first, times before 1970 included."""
    wide = "decimal(20,0)"
    left = F.lit(MAX_LONG).cast(wide) - F.unix_millis(ts).cast(wide)
    return F.lpad(left.cast("string"), MAX_LONG_DIGITS, "0")


def padded_position(position: Column) -> Column:
    """Position as text that sorts like the number."""
    return F.lpad(position.cast("string"), POSITION_DIGITS, "0")


def row_key(*parts: Column) -> Column:
    """Parts joined by the separator; null when a part is null."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit(SEPARATOR), part.cast("string")]
    return F.concat(*pieces)


def compact_day(ts: Column) -> Column:
    """Timestamp -> 'yyyyMMdd', which sorts like the date."""
    return F.date_format(ts, "yyyyMMdd")
