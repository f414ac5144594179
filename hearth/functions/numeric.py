"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NOISE_DIGITS = 8


def half_up(x, digits: int) -> Column:
    """Round half away from zero, as the decimal value would be rounded.

    A DOUBLE quotient that should end in exactly …5 may sit one bit below it. The
    first rounding removes that error, so ties come out as they do in DECIMAL.
    """
    return F.round(F.round(x, _NOISE_DIGITS), digits)
