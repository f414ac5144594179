"""Mortgage-rate series: JSON observations or a two-column CSV."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import schemas, seeds
from hearth.functions import clean, dates, stats
from hearth.functions.numeric import half_up
from hearth.sources.landing import first_readable

NO_VALUE = "."


def read_observations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(schemas.OBSERVATIONS_RESPONSE).json(path, multiLine=multi_line)


def observed_rates(responses: DataFrame) -> DataFrame:
    """(report_date, rate_30yr_fixed) of the observations that carry a value."""
    obs = responses.select(F.inline("observations"))
    return obs.filter(F.col("value") != NO_VALUE).select(
        F.try_to_date(F.col("date")).alias("report_date"), clean.rate("value").alias("rate_30yr_fixed")
    ).dropna()


def read_rate_csv(spark: SparkSession, path: str) -> DataFrame:
    """Two text columns named by position; the file's own header is replaced."""
    raw = spark.read.schema("c0 string, c1 string").option("header", True).option("enforceSchema", True).csv(path)
    return raw.toDF("report_date", "rate_30yr_fixed")


def weekly_rates(raw: DataFrame, since: date = seeds.SINCE) -> DataFrame:
    day = F.col("report_date").try_cast("date")
    return (
        raw.select(day.alias("report_date"), clean.finite("rate_30yr_fixed").alias("rate_30yr_fixed"))
        .dropna()
        .filter(F.col("report_date") >= F.lit(since))
    )


def monthly_rates(weekly: DataFrame) -> DataFrame:
    """Mean per calendar month, four decimals; a zero mean becomes NULL."""
    return weekly.groupBy(dates.month_of("report_date").alias("report_date")).agg(
        F.nullif(half_up(stats.exact_mean("rate_30yr_fixed", 4), 4), F.lit(0.0)).alias("rate_30yr_fixed")
    )


def read_rates(spark: SparkSession, json_candidates: Sequence[str], csv_candidates: Sequence[str], since: date = seeds.SINCE, skipped: list | None = None) -> DataFrame:
    """Monthly rates of the first file, JSON before CSV, that exists and holds a rate since ``since``.

    A file that is absent, cannot be parsed or has no such rate is passed over; ``skipped`` gets (path, reason) of it.
    """

    def read(path: str) -> DataFrame:
        if path in json_candidates:
            found = observed_rates(read_observations(spark, path)).filter(F.col("report_date") >= F.lit(since))
        else:
            found = weekly_rates(read_rate_csv(spark, path), since)
        if found.isEmpty():
            raise ValueError("no rate")
        return monthly_rates(found)

    return first_readable(spark, [*json_candidates, *csv_candidates], read, skipped)


def staged_rates(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("data_source", F.lit("FRED MORTGAGE30US"))
