"""Text-to-value cleaning as built-in column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c) -> Column:
    """Parse to DOUBLE; unparseable, NaN and infinite values become NULL."""
    v = _col(c).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v)


def number(c, digits: int) -> Column:
    return F.round(finite(c), digits)


def money(c) -> Column:
    """Amount with two decimals."""
    return number(c, 2)


def rate(c) -> Column:
    """Percentage or index with four decimals."""
    return number(c, 4)


def survey_amount(c) -> Column:
    """Amount from a survey that codes "missing" as a negative number."""
    v = finite(c)
    return F.round(F.when(v >= 0, v), 2)


def integer(c) -> Column:
    """Whole number, truncated toward zero."""
    return finite(c).try_cast("bigint")


def head_count(c) -> Column:
    """Positive whole number; zero, negative and unparseable become NULL."""
    v = finite(c)
    return F.when(v > 0, v).try_cast("bigint")


def flag_one(c) -> Column:
    """1 when the text form of the value is exactly "1", else 0."""
    return (F.coalesce(_col(c).cast("string"), F.lit("0")) == "1").cast("int")
