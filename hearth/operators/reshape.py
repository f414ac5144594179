"""Wide-to-long and long-to-wide."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions import clean


def _as_date(name: str) -> date | None:
    try:
        return datetime.fromisoformat(name.strip()).date()  # a date, or one with a time; nothing may follow
    except ValueError:
        return None


def date_columns(names: Sequence[str], since: date | None = None) -> dict[str, date]:
    """The column names that are dates, on or after ``since``, with their dates."""
    found = {n: _as_date(n) for n in names}
    return {n: d for n, d in found.items() if d is not None and (since is None or d >= since)}


def unpivot_dates(wide: DataFrame, ids: Sequence[str], value: str, name: str = "report_date", since: date | None = None) -> DataFrame:
    """One row per (ids, date column) with a usable number.

    Columns that are no date, or lie before ``since``, are left out while the
    plan is built: they are neither read nor expanded.
    """
    months = date_columns([c for c in wide.columns if c not in ids], since)
    if not months:
        raise ValueError("no date columns found")
    iso = [d.isoformat() for d in months.values()]
    renamed = wide.select(*ids, *[F.col(f"`{c}`").alias(i) for c, i in zip(months, iso)])
    long = renamed.unpivot(list(ids), [F.col(f"`{i}`") for i in iso], "__name", "__text")
    return long.select(
        *ids, F.col("__name").cast("date").alias(name), clean.money("__text").alias(value)
    ).filter(F.col(value).isNotNull())


def pivot_measures(long: DataFrame, keys: Sequence[str], measures: Sequence[str], order: Column | str, measure: str = "measure", value: str = "value") -> DataFrame:
    """One column per measure holding its first non-NULL value in ``order``.

    The measure list is fixed, so a measure that never occurs is a NULL column
    and the rows are aggregated in one pass. Keys with no value at all drop out.
    """
    order = F.col(order) if isinstance(order, str) else order
    cols = [
        F.min_by(value, F.when((F.col(measure) == m) & F.col(value).isNotNull(), order)).alias(m)
        for m in measures
    ]
    return long.filter(F.col(value).isNotNull()).groupBy(*keys).agg(*cols).dropna(how="all", subset=list(measures))
