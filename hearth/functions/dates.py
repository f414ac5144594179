"""Date keys and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Monthly observation periods: M01..M12. M13 is an annual average.
MONTHLY_PERIOD = "^M(0[1-9]|1[0-2])$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_id(c) -> Column:
    """DATE -> yyyyMMdd integer, by arithmetic so that it stays in codegen."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def from_date_id(c) -> Column:
    i = _col(c)
    return F.make_date((i / 10000).cast("int"), ((i % 10000) / 100).cast("int"), i % 100)


def month_of(c) -> Column:
    """First day of the month."""
    return F.trunc(_col(c), "MM")


def month_index(c) -> Column:
    """Months since year 0; consecutive months differ by one."""
    d = _col(c)
    return (F.year(d) * 12 + F.month(d)).cast("int")


def is_monthly(period) -> Column:
    return _col(period).rlike(MONTHLY_PERIOD)


def period_date(year, period) -> Column:
    """("2020", "M03") -> 2020-03-01; anything that is no month gives NULL."""
    y, p = _col(year), _col(period)
    text = F.concat(F.lpad(F.trim(y), 4, "0"), F.lit("-"), F.substring(p, 2, 2), F.lit("-01"))
    return F.when(is_monthly(p), text.try_cast("date"))


def calendar_columns(c) -> dict[str, Column]:
    """The columns of the date dimension for one DATE column."""
    d = _col(c)
    return {
        "date_id": date_id(d),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day_of_month": F.dayofmonth(d),
        "is_year_end": (F.month(d) == 12) & (F.dayofmonth(d) == 31),
    }
