"""The profiles that follow a load, one for each fact, and those of all columns that a refresh stores."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.operators.profile import columns_profile, newest_row, profile, top
from hearth.seeds import ALL_HOMES

CITY = ["city_display"]


def rent(rows: DataFrame, date: str = "full_date") -> DataFrame:
    """All-homes rents by city; ``rows`` has city_display."""
    return profile(rows.where(F.col("bedroom_type") == ALL_HOMES), CITY, span=date, mean={"avg_rent": ("monthly_rent", 2, 2)}).orderBy(*CITY)


def home(rows: DataFrame, date: str = "full_date") -> DataFrame:
    return profile(rows, CITY, span=date, mean={"avg_home_price": ("median_home_price", 2, 2)}).orderBy(F.desc("avg_home_price"))


def income(rows: DataFrame) -> DataFrame:
    value = "median_household_income"
    out = profile(rows, CITY, rows="year_count", span="survey_year", span_names=("earliest_year", "latest_year"), most={"max_income": value}, newest={"latest_income": (value, "survey_year")})
    return out.orderBy(F.desc("max_income"))


def labor(rows: DataFrame, date: str = "full_date") -> DataFrame:
    value = "unemployment_rate"
    return profile(rows, CITY, span=date, mean={"avg_unemp": (value, 2, 4)}, least={"min_unemp": value}, most={"max_unemp": value}).orderBy(F.desc("avg_unemp"))


def rate(rows: DataFrame, date: str = "full_date") -> DataFrame:
    value = "rate_30yr_fixed"
    return profile(rows, span=date, mean={"avg_rate": (value, 4, 4)}, least={"min_rate": value}, most={"max_rate": value})


def cpi(rows: DataFrame, cities: int = 10) -> DataFrame:
    """The first cities by name."""
    out = profile(rows, CITY, rows="months", span="report_date", least={"min_cpi": "cpi_index"}, most={"max_cpi": "cpi_index"})
    return top(out, [F.col("city_display")], cities)


def unmatched(facts: DataFrame) -> DataFrame:
    """Price rows without a place, by the city they name."""
    return profile(facts.where("geo_id IS NULL"), CITY, holding={"national_rows": F.col("is_national")})


def coverage(rents: DataFrame, date: str = "full_date") -> DataFrame:
    return profile(rents, ["bedroom_type"], distinct={"metros": "geo_id", "months": date})


def latest_rate(rates: DataFrame, date: str = "full_date") -> DataFrame:
    return newest_row(rates.select(date, "rate_30yr_fixed"), date)


def top_fmr(rows: DataFrame, count: int = 25) -> DataFrame:
    cols = ["city", "fmr_year", "fmr_1br", "fmr_2br", "fmr_3br"]
    return top(rows.select(*cols), [F.desc("fmr_2br"), F.asc("city"), F.asc("fmr_year")], count)


def of_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, row_count, null_count, least, most, values) of several tables, one pass over each."""
    return reduce(DataFrame.unionByName, [columns_profile(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()])
