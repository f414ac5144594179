"""Staged source rows -> fact tables on shared geography and date keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth import schemas, seeds
from hearth.functions import dates


def geo_by_crosswalk(staged: DataFrame, crosswalk: DataFrame, geography: DataFrame) -> DataFrame:
    """Add geo_id by source name -> city -> geography; unmatched metros drop out."""
    named = crosswalk.select(F.col("source_key").alias("metro_raw"), "city_display")
    return staged.join(named, ["metro_raw"]).join(geography.select("geo_id", "city_display"), ["city_display"])


def first_key_in(text: str | Column, keys: Sequence[str]) -> Column:
    """The first of an ordered list of keys that occurs in the text; NULL if none does."""
    t = F.col(text) if isinstance(text, str) else text
    return F.get(F.filter(F.array(*[F.lit(k) for k in keys]), lambda k: t.contains(k)), F.lit(0))


def geo_by_pattern(staged: DataFrame, geography: DataFrame, keys: Sequence[str], text: str = "metro_raw", name: str = "metro_name") -> DataFrame:
    """Add geo_id where the geography's name contains the key found in the staged text.

    The key of each staged row, and the keys inside each geography name, are
    worked out once; what is left is an equi-join instead of comparing every
    pair with LIKE.
    """
    held = geography.select(
        "geo_id",
        F.explode(
            F.filter(F.array(*[F.lit(k) for k in keys]), lambda k: F.col(name).contains(k))
        ).alias("__key"),
    )
    return staged.withColumn("__key", first_key_in(text, keys)).join(held, ["__key"]).drop("__key")


def fact_rent(staged: DataFrame, crosswalk: DataFrame, geography: DataFrame) -> DataFrame:
    rows = geo_by_crosswalk(staged.filter(F.col("monthly_rent").isNotNull()), crosswalk, geography)
    rent = F.col("monthly_rent").cast("decimal(10,2)")
    return schemas.conform(
        rows.select("*", dates.date_id("report_date").alias("date_id"), (rent * 12).alias("annual_rent")), schemas.FACT_RENT
    )


def fact_home(staged: DataFrame, crosswalk: DataFrame, geography: DataFrame) -> DataFrame:
    rows = geo_by_crosswalk(staged.filter(F.col("median_home_price").isNotNull()), crosswalk, geography)
    return schemas.conform(rows.withColumn("date_id", dates.date_id("report_date")), schemas.FACT_HOME)


def fact_income(staged: DataFrame, geography: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    rows = staged.filter(F.col("median_household_income").isNotNull())
    return schemas.conform(geo_by_pattern(rows, geography, keys or seeds.income_match_keys()), schemas.FACT_INCOME)


def fact_labor(staged: DataFrame, geography: DataFrame) -> DataFrame:
    rows = staged.filter(F.col("unemployment_rate").isNotNull()).join(
        geography.select("geo_id", F.col("city_display").alias("metro_raw")), ["metro_raw"]
    )
    return schemas.conform(rows.withColumn("date_id", dates.date_id("report_date")), schemas.FACT_LABOR)


def fact_rate(staged: DataFrame) -> DataFrame:
    rows = staged.filter(F.col("rate_30yr_fixed").isNotNull())
    return schemas.conform(rows.withColumn("date_id", dates.date_id("report_date")), schemas.FACT_RATE)


def fact_cpi(cities: DataFrame, geography: DataFrame, calendar: DataFrame) -> DataFrame:
    """National and unknown series keep a NULL geo_id; days outside the calendar a NULL date_id."""
    rows = (
        cities.filter(F.col("cpi_index").isNotNull())
        .join(geography.select("geo_id", "city_display"), ["city_display"], "left")
        .join(calendar.select("date_id", F.col("full_date").alias("report_date")), ["report_date"], "left")
    )
    return schemas.conform(rows, schemas.FACT_CPI)


def cpi_or_national(spine: DataFrame, cpi: DataFrame) -> DataFrame:
    """(geo_id, report_date) rows with the city's index, or the national one where it has none."""
    city = cpi.filter(F.col("geo_id").isNotNull()).select("geo_id", "report_date", F.col("cpi_index").alias("__city"))
    nation = cpi.filter("is_national").select("report_date", F.col("cpi_index").alias("__nation"))
    return (
        spine.join(city, ["geo_id", "report_date"], "left")
        .join(nation, ["report_date"], "left")
        .select(*spine.columns, F.coalesce("__city", "__nation").alias("cpi_index"))
    )


def fact_fmr(staged: DataFrame) -> DataFrame:
    return schemas.conform(staged, schemas.FACT_FMR)


YEAR = "year_part"


def by_year(fact: DataFrame) -> DataFrame:
    """A dated fact with the year of its days, by which it is stored."""
    return fact.withColumn(YEAR, F.floor(F.col("date_id") / 10000).cast("int"))


def star_join(fact: DataFrame, geography: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fact rows with the columns of both dimensions; rows without a match drop out.

    Of a fact read with the year that it is stored by, only the years are read that what is left of the calendar has.
    """
    placed = fact.join(geography, ["geo_id"])
    if YEAR not in fact.columns:
        return placed.join(calendar, ["date_id"])
    return placed.join(calendar.withColumn(YEAR, F.col("year").cast("int")), ["date_id", YEAR]).drop(YEAR)
