"""The flat table, its quality gate, and named views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions import dates, finance, stats
from hearth.functions.numeric import half_up
from hearth.operators import quality, versions
from hearth.operators.lookup import join_per_key, with_prior
from hearth.plans import indicators
from hearth.plans.metrics import latest_snapshot
from hearth.plans.steps import Failed, Steps

GRAINS = {
    "fact_rent": ["geo_id", "date_id", "bedroom_type"],
    "fact_home_prices": ["geo_id", "date_id", "home_type"],
    "fact_income": ["geo_id", "survey_year"],
    "fact_labor": ["geo_id", "date_id"],
    "fact_mortgage_rates": ["date_id"],
}


def affordability_final(metrics: DataFrame, income: DataFrame) -> DataFrame:
    """One row per row of the view, with every indicator that has a value for it.

    Adds pressure score, years to save, growth of rent and income over one year,
    the z-score of the row's rent burden within its metro and bedroom type, the
    year's rent-income divergence, and the city class. ``metrics`` is read
    several times, so pass a stored table. Each indicator comes back by an
    equi-join on its own grain.
    """
    kind = ["geo_id", "bedroom_type"]
    rows = indicators.with_years_to_save(indicators.with_pressure(metrics)).withColumn("__m", dates.month_index("full_date"))
    rent = metrics.select(*kind, dates.month_index("full_date").alias("__m"), F.col("monthly_rent").cast("double").alias("__rent"))
    prior = with_prior(rent, kind, "__m", 12, "__rent", "__prior").select(
        *kind, "__m", finance.growth("__rent", "__prior").alias("rent_growth_yoy")
    )
    earned = indicators.income_yoy(income).select("geo_id", F.col("survey_year").alias("year"), "income_growth_yoy")
    history = metrics.groupBy(*kind).agg(
        stats.exact_mean("rent_to_income_ratio", 4).alias("__mean"), F.stddev_samp("rent_to_income_ratio").alias("__sd")
    )
    diverged = indicators.rent_income_divergence(metrics, income).select("geo_id", "year", "divergence")
    classes = indicators.classify(metrics).select("geo_id", "city_classification")
    z = (F.col("rent_to_income_ratio") - F.col("__mean")) / F.when(F.col("__sd") > indicators.NO_SPREAD, F.col("__sd"))
    rows = rows.join(prior, [*kind, "__m"], "left").join(earned, ["geo_id", "year"], "left").join(diverged, ["geo_id", "year"], "left")
    rows = join_per_key(rows, history, kind, "__m").withColumn("zscore", half_up(z, 4))
    return join_per_key(rows, classes, ["geo_id"], "__m").drop("__m", "__mean", "__sd")


#: Tables that the view joins by month, and what else makes a row of them unique.
MONTHLY = {"fact_home_prices": ["geo_id", "home_type"], "fact_labor": ["geo_id"], "fact_mortgage_rates": []}


def standard_checks(tables: Mapping[str, DataFrame], geography: DataFrame, calendar: DataFrame) -> dict[str, DataFrame]:
    """Failing rows per check: uniqueness on the grain, and place or date keys that do not exist."""
    checks = {}
    for name, grain in GRAINS.items():
        checks[f"unique {name}"] = quality.duplicate_keys(tables[name], grain)
        if "geo_id" in grain:
            checks[f"geography of {name}"] = quality.orphans(tables[name], geography, ["geo_id"])
        if "date_id" in grain:
            checks[f"calendar of {name}"] = quality.orphans(tables[name], calendar, ["date_id"])
    for name, others in MONTHLY.items():  # a second row in a month would multiply the rows of the view
        by_month = tables[name].withColumn("month_id", F.floor(F.col("date_id") / 100))
        checks[f"one row a month in {name}"] = quality.duplicate_keys(by_month, [*others, "month_id"])
    return checks


def run_checks(steps: Steps, checks: Mapping[str, DataFrame]) -> None:
    """One step for each check, all counted in one job; every check is reported, and one that fails holds back what follows."""
    counted = {r["step"]: r["failed_rows"] for r in quality.check_results(checks).collect()} if checks and steps.error is None else {}  # one row a check

    def verdict(name: str):
        if counted[name]:
            raise Failed(f"{counted[name]} rows", counted[name])
        return True, 0

    first = None
    for name in checks:
        steps.run(f"check: {name}", lambda: verdict(name))
        if counted and steps.error is not None:  # the next check is still worth its verdict
            first, steps.error = first or steps.error, None
    steps.error = steps.error or first


def publish(spark: SparkSession, warehouse: str, tables: Mapping[str, DataFrame], checks: Mapping[str, DataFrame], steps: Steps | None = None) -> Steps:
    """Write ``tables`` as the next version of the warehouse, which becomes the current one only if every check passes."""
    steps = steps or Steps()
    run_checks(steps, checks)
    draft = versions.begin(spark, warehouse)
    for name, df in tables.items():
        steps.run(f"write {name}", lambda: (draft.write(name, df), draft.rows[name]))
    steps.run("publish", lambda: (draft.commit(), len(tables)))
    return steps


def register_views(tables: Mapping[str, DataFrame], metrics: DataFrame) -> None:
    """Make the star and the derived tables available to SQL by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    metrics.createOrReplaceTempView("vw_affordability_metrics")
    latest_snapshot(metrics).createOrReplaceTempView("vw_latest_snapshot")
    indicators.classify(metrics).createOrReplaceTempView("vw_city_classification")
