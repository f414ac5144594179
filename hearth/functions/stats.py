"""Aggregates that do not depend on the order in which rows arrive."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOW_BITS = 20


def exact_sum(c, digits: int = 2) -> Column:
    """Sum of values with at most ``digits`` decimals, as an exact DECIMAL.

    Task order and task retries cannot change the result, as they can for a sum
    of doubles. The values are added as whole numbers of the last digit, in two
    BIGINT halves: that is several times faster than adding decimals, and the
    halves hold trillions of rows per group.
    """
    c = F.col(c) if isinstance(c, str) else c
    units = F.rint(c * float(10**digits)).cast("bigint")
    high, low = F.sum(F.shiftright(units, _LOW_BITS)), F.sum(units.bitwiseAND(F.lit(2**_LOW_BITS - 1)))
    whole = high.cast("decimal(20,0)") * F.lit(Decimal(2**_LOW_BITS)) + low.cast("decimal(20,0)")
    return whole * F.lit(Decimal(1).scaleb(-digits))


def exact_mean(c, digits: int = 2) -> Column:
    """Mean of the non-NULL values; NULL for no values."""
    c = F.col(c) if isinstance(c, str) else c
    return exact_sum(c, digits).cast("double") / F.nullif(F.count(c), F.lit(0))
