"""Money and ratio expressions that do not depend on how rows are partitioned.

Money columns hold dollars as doubles.  `total` sums them as whole dollars and millionths,
two bigints, so a sum is exact and the same whatever the order of the partial sums, parts of
a cent add up before anything is rounded, and the aggregation stays on Spark's fixed-width
hash path (several times faster than a wide decimal sum).  An amount or a sum beyond 9
quintillion dollars, and NaN, raise; no amount is left out of a sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


LARGEST = 9.0e18
MILLIONTHS = 1_000_000


def _checked(amount: Column, largest: float) -> Column:
    """``amount`` as double; one that is not below ``largest`` either way, or NaN, raises."""
    value = amount.cast("double")
    message = F.concat(F.lit("amount out of range: "), value.cast("string"))
    return F.when(F.abs(value) >= largest, F.raise_error(message)).otherwise(value)


def cents(dollars: Column) -> Column:
    """One dollar amount -> whole cents as bigint; null for null, an error out of range."""
    return F.rint(_checked(dollars, LARGEST / 100) * F.lit(100.0)).cast("bigint")


def total(amount: Column) -> Column:
    """Aggregate: the exact sum of dollar amounts, in cents with four more digits.

    Null amounts do not count; without any other the sum is null.
    """
    whole, parts = parts_of(amount)
    return total_of(F.sum(whole), F.sum(parts))


def parts_of(amount: Column) -> tuple[Column, Column]:
    """One dollar amount as whole dollars and millionths, two bigints."""
    value = _checked(amount, LARGEST)
    whole = F.floor(value)
    parts = F.rint((value - whole.cast("double")) * F.lit(float(MILLIONTHS))).cast("bigint")
    return whole, parts


def total_of(whole: Column, parts: Column) -> Column:
    """Sums of whole dollars and of millionths, apart until here, as one in cents."""
    wide = "decimal(20,0)"
    in_cents = whole.cast(wide) * F.lit(100) + parts.cast(wide) / F.lit(10_000)
    return in_cents.cast("decimal(30,4)")


def dollars(total_cents: Column) -> Column:
    """Sum in cents -> dollars as double, rounded half up to whole cents."""
    return F.round(total_cents, 0).cast("double") / F.lit(100.0)


def ratio(numerator: Column, denominator: Column, digits: int | None) -> Column:
    """Quotient of a sum and a whole number as double, null when the denominator is 0.

    With ``digits`` the quotient is rounded half up from an exact decimal, so averages
    that fall on half a cent do not depend on floating-point noise.
    """
    if digits is None:
        return F.try_divide(numerator.cast("double"), denominator.cast("double"))
    exact = F.try_divide(numerator.cast("decimal(28,4)"), denominator.cast("decimal(20,0)"))
    return F.round(exact, digits).cast("double")


def money_mean(total_cents: Column, count: Column, digits: int | None) -> Column:
    """Mean in dollars of ``count`` amounts that add up to ``total_cents``."""
    return ratio(total_cents, count * F.lit(100), digits)


def rounded(value: Column, digits: int | None) -> Column:
    """``value`` rounded to ``digits``, or as it is when ``digits`` is None."""
    return value if digits is None else F.round(value, digits)
