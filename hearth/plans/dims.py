"""Dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import schemas, seeds
from hearth.functions import dates


def date_spine(spark: SparkSession, first: date = seeds.DATE_SPINE[0], last: date = seeds.DATE_SPINE[1]) -> DataFrame:
    """One row per day, both ends included."""
    days = spark.range(0, (last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))
    return schemas.conform(days.select(*[c.alias(n) for n, c in dates.calendar_columns("d").items()]), schemas.DIM_DATE)


geography = seeds.geography
scenarios = seeds.scenarios
