"""Affordability formulas. Every function takes and returns Columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearth.functions.numeric import half_up


def _num(x) -> Column:
    if isinstance(x, str):
        x = F.col(x)
    return x.cast("double") if isinstance(x, Column) else F.lit(float(x))


def payment_unrounded(price, rate_pct, down=0.20, years=30) -> Column:
    """Level monthly payment of a fixed-rate loan; NULL unless price and rate are positive."""
    price, rate_pct, down = _num(price), _num(rate_pct), _num(down)
    months = _num(years) * 12
    m = rate_pct / 100 / 12
    growth = F.pow(1 + m, months)
    loan = price * (1 - down)
    return F.when((rate_pct > 0) & (price > 0), loan * (m * growth) / (growth - 1))


def monthly_payment(price, rate_pct, down=0.20, years=30) -> Column:
    return half_up(payment_unrounded(price, rate_pct, down, years), 2)


def ratio(numerator, denominator, digits: int) -> Column:
    """numerator / denominator where the denominator is positive, else NULL."""
    n, d = _num(numerator), _num(denominator)
    return half_up(n / F.when(d > 0, d), digits)


def _exact(x) -> Column:
    return (F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)).cast("decimal(28,6)")


def over(numerator, denominator, limit: float) -> Column:
    """1 when the ratio is above the limit, compared in DECIMAL; 0 otherwise, also when it is NULL or the denominator is not positive."""
    n, d = _exact(numerator), _exact(denominator)
    return F.when((d > 0) & (n > d * F.lit(Decimal(str(limit)))), 1).otherwise(0)


def pressure_score(rti, mti, unemployment, rent_limit=0.30, mortgage_limit=0.28, unemployment_limit=5.0) -> Column:
    """Composite index; 100 when all three inputs sit exactly on their limits."""
    return half_up(
        _num(rti) / rent_limit * 40
        + _num(mti) / mortgage_limit * 40
        + _num(unemployment) / unemployment_limit * 20,
        2,
    )


def years_to_save(down_payment, income, savings_rate=0.10) -> Column:
    inc = _num(income)
    return half_up(_num(down_payment) / (F.when(inc > 0, inc) * savings_rate), 2)


def growth(current, prior) -> Column:
    cur, old = _num(current), _num(prior)
    return half_up((cur - old) / F.nullif(old, F.lit(0.0)), 4)
