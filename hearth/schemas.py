"""Schemas of stored tables and of the landed JSON responses."""

from __future__ import annotations

DIM_GEOGRAPHY = (
    "geo_id int, metro_name string, city_display string, state_abbr string, region string, "
    "census_cbsa string, zillow_name string, bls_area_code string, "
    "latitude decimal(9,6), longitude decimal(9,6), is_active boolean"
)
DIM_DATE = (
    "date_id int, full_date date, year smallint, quarter smallint, month smallint, "
    "month_name string, day_of_month smallint, is_year_end boolean"
)
DIM_SCENARIO = (
    "scenario_id int, scenario_name string, mortgage_rate decimal(6,4), "
    "down_payment_pct decimal(5,2), income_assumption decimal(12,2), loan_term_years int"
)

FACT_RENT = (
    "geo_id int, date_id int, monthly_rent decimal(10,2), annual_rent decimal(13,2), "
    "bedroom_type string, data_source string"
)
FACT_HOME = "geo_id int, date_id int, median_home_price decimal(12,2), home_type string, data_source string"
FACT_INCOME = (
    "geo_id int, survey_year int, median_household_income decimal(12,2), "
    "per_capita_income decimal(12,2), population bigint, data_source string"
)
FACT_LABOR = (
    "geo_id int, date_id int, unemployment_rate decimal(5,2), employment_level bigint, "
    "labor_force bigint, data_source string"
)
FACT_RATE = "date_id int, rate_30yr_fixed decimal(6,4), data_source string"
FACT_CPI = (
    "geo_id int, series_id string, city_display string, date_id int, report_date date, "
    "year int, month int, cpi_index decimal(10,4), cpi_category string, is_national boolean, "
    "data_source string, load_date date"
)
FACT_FMR = (
    "entity_id string, city string, metro_name string, fmr_year int, "
    "fmr_0br decimal(10,2), fmr_1br decimal(10,2), fmr_2br decimal(10,2), "
    "fmr_3br decimal(10,2), fmr_4br decimal(10,2), fmr_percentile int, "
    "smallarea_flag smallint, load_date date"
)

# Landed responses
SERIES_RESPONSE = (
    "status string, message array<string>, "
    "Results struct<series: array<struct<seriesID: string, "
    "data: array<struct<year: string, period: string, value: string>>>>>"
)
OBSERVATIONS_RESPONSE = "observations array<struct<date: string, value: string>>"
MATRIX = "array<array<string>>"


def columns(schema: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a flat DDL string above."""
    out, depth, part = [], 0, ""
    for ch in schema + ",":
        depth += (ch in "(<") - (ch in ")>")
        if ch == "," and depth == 0:
            name, kind = part.strip().split(" ", 1)
            out.append((name, kind))
            part = ""
        else:
            part += ch
    return out


def conform(df, schema: str):
    """Project ``df`` to a stored table's columns, order and types."""
    from pyspark.sql import functions as F

    return df.select(*[F.col(n).cast(t).alias(n) for n, t in columns(schema)])
