"""Wide CSV files: one row per metro, one column per month (rents, home values)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import seeds
from hearth.operators.reshape import date_columns, unpivot_dates
from hearth.sources.landing import files, first_readable

KEY, FILE = "RegionName", "__file"


def _read_file(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if KEY not in raw.columns or not date_columns(raw.columns):
        raise ValueError(f"no column {KEY} or no month in the header")
    return raw


def read_wide(spark: SparkSession, candidates: Sequence[str], skipped: list | None = None) -> DataFrame:
    """All columns as text; the header names the months.

    Of the candidates (paths or patterns) the first with a readable file counts. Several files that match it
    are united by the names in their headers, and ``FILE`` numbers them in the order of their
    names: what a later file says about a month replaces what an earlier one says. ``skipped`` gets
    (path, reason) of the candidates and files passed over.
    """

    def read(pattern: str) -> DataFrame:
        parts = []
        for i, path in enumerate(files(spark, pattern)):
            try:
                parts.append((i, _read_file(spark, path)))
            except (ValueError, PySparkException) as e:
                if skipped is not None:
                    skipped.append((path, f"unreadable: {str(e).splitlines()[0][:200]}"))
        if not parts:
            raise ValueError("no readable file")
        if len(parts) == 1:
            return parts[0][1]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(FILE, F.lit(i)) for i, df in parts])

    return first_readable(spark, candidates, read, skipped)


def long_series(wide: DataFrame, crosswalk: DataFrame, value: str, since: date = seeds.SINCE, key: str = KEY) -> DataFrame:
    """(metro_raw, report_date, value) of the metros in the crosswalk; the newest file with a usable value wins.

    The metro filter sits below the unpivot, so only wanted metros are expanded.
    """
    wanted = wide.join(crosswalk.select(F.col("source_key").alias(key)), [key], "left_semi")
    if FILE not in wide.columns:
        return unpivot_dates(wanted, [key], value, since=since).withColumnRenamed(key, "metro_raw")
    long = unpivot_dates(wanted, [key, FILE], value, since=since)
    newest = long.groupBy(key, "report_date").agg(F.max(F.struct(FILE, value)).alias("cell"))  # of one file's rows for a metro the largest, so that runs agree
    return newest.select(F.col(key).alias("metro_raw"), "report_date", F.col(f"cell.{value}").alias(value))


def staged_rent(wide: DataFrame, crosswalk: DataFrame, since: date = seeds.SINCE) -> DataFrame:
    return long_series(wide, crosswalk, "monthly_rent", since).select(
        "*", F.lit(seeds.ALL_HOMES).alias("bedroom_type"), F.lit("Zillow ZORI").alias("data_source")
    )


def staged_home(wide: DataFrame, crosswalk: DataFrame, since: date = seeds.SINCE) -> DataFrame:
    return long_series(wide, crosswalk, "median_home_price", since).select(
        "*", F.lit(seeds.ALL_HOMES).alias("home_type"), F.lit("Zillow ZHVI").alias("data_source")
    )
