"""Nested series responses: labor-market measures and consumer prices."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import schemas, seeds
from hearth.functions import clean, dates
from hearth.operators.lookup import first_per_key
from hearth.operators.reshape import pivot_measures

SUCCEEDED = "REQUEST_SUCCEEDED"


CORRUPT, SOURCE = "_corrupt_record", "source_file"


def read_responses(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Responses with their file. A document that cannot be parsed stays as a row without content, its text in ``CORRUPT``."""
    reader = spark.read.schema(f"{schemas.SERIES_RESPONSE}, {CORRUPT} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(paths, multiLine=multi_line).withColumn(SOURCE, F.col("_metadata.file_path"))


def skipped_responses(responses: DataFrame) -> DataFrame:
    """(source_file, reason) of the documents that add nothing: unreadable, or not answered."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "unreadable").when(
        ~F.col("status").eqNullSafe(SUCCEEDED), F.concat(F.lit("status: "), F.coalesce("status", F.lit("none")))
    )
    return responses.select(SOURCE, reason.alias("reason")).where("reason IS NOT NULL")


def observations(responses: DataFrame, window: int = 0) -> DataFrame:
    """(series_id, report_date, value_text, seq) of the monthly observations of answered requests.

    ``seq`` orders the readings of one series: by window, then by place in the
    response, then by text, so that the first one is the same in every run.
    """
    series = responses.filter(F.col("status") == SUCCEEDED).select(F.posexplode("Results.series").alias("s_no", "s"))
    obs = series.select("s_no", F.col("s.seriesID").alias("series_id"), F.posexplode("s.data").alias("o_no", "o"))
    return obs.filter(dates.is_monthly("o.period")).select(
        "series_id",
        dates.period_date("o.year", "o.period").alias("report_date"),
        F.col("o.value").alias("value_text"),
        F.struct(F.lit(window).alias("window"), F.col("s_no"), F.col("o_no"), F.col("o.value").alias("text")).alias("seq"),
    ).filter(F.col("report_date").isNotNull())


def union_windows(windows: Sequence[DataFrame]) -> DataFrame:
    """Observations of several request windows; an empty window adds nothing."""
    parts = [observations(w, i) for i, w in enumerate(windows)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_years(obs: DataFrame, first: int, last: int) -> DataFrame:
    """Years of the requested range for which nothing was read."""
    spark = obs.sparkSession
    wanted = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    return wanted.join(obs.select(F.year("report_date").alias("year")), ["year"], "left_anti")


def series_ids(areas: DataFrame, measures: DataFrame) -> DataFrame:
    """(series_id, city_display, measure) for every area and measure.

    Measures are expanded from a constant array, so no join is involved.
    """
    coded = [
        F.struct(F.lit(code).alias("measure_code"), F.lit(name).alias("measure")) for code, name in measures
    ]
    return areas.select("city_display", "state_fips", "cbsa", F.inline(F.array(*coded))).select(
        F.concat(F.lit("LAUMT"), "state_fips", "cbsa", F.lit("000000"), "measure_code").alias("series_id"),
        "city_display",
        "measure",
    )


def staged_labor(obs: DataFrame, ids: DataFrame, since: date = seeds.SINCE) -> DataFrame:
    """One row per city and month with a column per measure; unknown series drop out."""
    long = (
        obs.join(ids, ["series_id"], "inner")
        .filter(F.col("report_date") >= F.lit(since))
        .select("city_display", "report_date", "measure", "seq", clean.rate("value_text").alias("value"))
    )
    names = [name for _, name in seeds.LABOR_MEASURES]
    wide = pivot_measures(long, ["city_display", "report_date"], names, "seq")
    return wide.select(
        F.col("city_display").alias("metro_raw"),
        "report_date",
        "unemployment_rate",
        clean.integer("employment_level").alias("employment_level"),
        clean.integer("labor_force").alias("labor_force"),
        F.lit("BLS LAUS").alias("data_source"),
    )


def staged_cpi(obs: DataFrame, load_date) -> DataFrame:
    """One row per series and month, the first reading winning."""
    valued = obs.select("series_id", "report_date", "seq", clean.finite("value_text").alias("cpi_index")).dropna()
    once = first_per_key(valued, ["series_id", "report_date"], "seq", ["cpi_index"])
    return once.select(
        "series_id",
        "report_date",
        F.year("report_date").alias("year"),
        F.month("report_date").alias("month"),
        "cpi_index",
        F.lit("All Items").alias("cpi_category"),
        F.lit("BLS CPI").alias("data_source"),
        F.lit(load_date).cast("date").alias("load_date"),
    )


def fan_out_cpi(staged: DataFrame, bridge: DataFrame) -> DataFrame:
    """A row per city that a series serves; series without a city are kept as 'Unknown'."""
    return staged.join(bridge, ["series_id"], "left").withColumns(
        {
            "city_display": F.coalesce("city_display", F.lit("Unknown")),
            "is_national": F.coalesce(F.col("city_display") == seeds.NATIONAL_CITY, F.lit(False)),
        }
    )
