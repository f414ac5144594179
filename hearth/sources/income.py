"""Income survey: a JSON matrix per year whose first row is the header."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import schemas
from hearth.functions import clean

# The survey's column codes.
INCOME, PER_CAPITA, POPULATION = "B19013_001E", "B19301_001E", "B01003_001E"
CODE_COLUMN_HINT = "statistical"


def read_years(spark: SparkSession, paths: Mapping[int, str]) -> DataFrame:
    """(survey_year, payload) with one response per row; years without a file are left out."""
    from hearth.operators.upsert import path_exists

    found = {y: p for y, p in paths.items() if path_exists(spark, p)}
    if not found:
        raise ValueError("income survey: no year was found")
    parts = [
        spark.read.text(p, wholetext=True).select(F.lit(y).alias("survey_year"), F.col("value").alias("payload"))
        for y, p in sorted(found.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def matrix_rows(responses: DataFrame, payload: str = "payload") -> DataFrame:
    """(…, header, row): every data row of every response next to its header."""
    others = [c for c in responses.columns if c != payload]
    table = responses.select(*others, F.from_json(payload, schemas.MATRIX).alias("m"))
    return table.select(
        *others, F.get("m", F.lit(0)).alias("header"), F.explode(F.slice("m", 2, F.greatest(F.size("m") - 1, F.lit(0)))).alias("row")
    ).filter(F.size("header") == F.size("row"))


def cell(name: Column) -> Column:
    """The row's text under a header name; NULL when there is no such column."""
    return F.get("row", F.array_position("header", name).cast("int") - 1)


def code_column() -> Column:
    """The header entry that names the metro-code column, whatever its exact title is."""
    return F.get(F.filter("header", lambda h: F.lower(h).contains(CODE_COLUMN_HINT)), F.lit(0))


def skipped_years(responses: DataFrame) -> DataFrame:
    """(survey_year, reason) of the responses that hold no table of a header and at least one row."""
    table = responses.select("survey_year", F.from_json("payload", schemas.MATRIX).alias("m"))
    reason = F.when(F.col("m").isNull(), "unreadable").when(F.size("m") < 2, "no rows")
    return table.select("survey_year", reason.alias("reason")).where("reason IS NOT NULL")


def staged_income(responses: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """(metro_raw, survey_year, incomes, population) of the metros in the crosswalk."""
    rows = matrix_rows(responses).select(
        "survey_year",
        cell(code_column()).alias("source_key"),
        cell(F.lit("NAME")).alias("metro_raw"),
        clean.survey_amount(cell(F.lit(INCOME))).alias("median_household_income"),
        clean.survey_amount(cell(F.lit(PER_CAPITA))).alias("per_capita_income"),
        clean.head_count(cell(F.lit(POPULATION))).alias("population"),
        F.lit("Census ACS 5-Year").alias("data_source"),
    )
    return rows.join(crosswalk.select("source_key"), ["source_key"], "left_semi")
