"""What-if tables: scenarios, rate grids, city-to-city comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth import seeds
from hearth.functions import finance
from hearth.functions.numeric import half_up
from hearth.plans.indicators import CITY, classify, latest_city_rows
from hearth.plans.metrics import RENT_LIMIT


def _scenario_array(scenarios: Sequence[tuple]):
    """The scenarios as one constant array, expanded per row; no join is involved."""
    num = lambda x: F.lit(None if x is None else float(x)).cast("double")
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("scenario_id"), F.lit(name).alias("scenario_name"), num(rate).alias("mortgage_rate"),
                num(down).alias("down_payment_pct"), num(income).alias("income_assumption"), F.lit(years).alias("loan_term_years"),
            )
            for i, (name, rate, down, income, years) in enumerate(scenarios, start=1)
        ]
    )


def scenario_payment(metrics: DataFrame, scenarios: Sequence[tuple] = tuple(seeds.SCENARIOS)) -> DataFrame:
    """Payment and its share of income for every metrics row under every scenario."""
    price = F.col("median_home_price").cast("double")
    share = F.col("down_payment_pct") / 100
    income = F.coalesce("income_assumption", F.col("median_household_income").cast("double"))
    payment = finance.payment_unrounded(price, "mortgage_rate", share, F.col("loan_term_years"))
    rows = metrics.select(
        *CITY, "full_date", "bedroom_type", "median_home_price", "median_household_income", F.inline(_scenario_array(scenarios))
    )
    return rows.select(
        *CITY, "full_date", "bedroom_type", "scenario_id", "scenario_name",
        income.alias("scenario_income"),
        half_up(price * share, 2).alias("down_payment"),
        half_up(payment, 2).alias("scenario_payment"),
        finance.ratio(payment * 12, income, 4).alias("scenario_mti"),
    )


def scenario_rent_burden(metrics: DataFrame, incomes: Sequence[float]) -> DataFrame:
    """Share of each assumed income that the rent takes."""
    rows = metrics.select(
        *CITY, "full_date", "bedroom_type", "annual_rent",
        F.explode(F.array(*[F.lit(float(i)) for i in incomes])).alias("input_income"),
    )
    return rows.select(
        *CITY, "full_date", "bedroom_type", "input_income",
        finance.ratio("annual_rent", "input_income", 4).alias("rent_burden"),
        finance.over("annual_rent", "input_income", RENT_LIMIT).alias("is_cost_burdened"),
    )


def rate_sensitivity(metrics: DataFrame, low: float, step: float, count: int) -> DataFrame:
    """Payment of every metrics row over an even grid of rates, and its change from the lowest."""
    grid = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.round(F.lit(low) + i * step, 4))
    rows = metrics.select(*CITY, "full_date", "bedroom_type", "median_home_price", F.explode(grid).alias("rate"))
    at_rate = finance.payment_unrounded("median_home_price", "rate")
    at_low = finance.payment_unrounded("median_home_price", F.lit(low))
    return rows.select(
        *CITY, "full_date", "bedroom_type", "rate",
        half_up(at_rate, 2).alias("payment"), half_up(at_rate - at_low, 2).alias("extra_payment"),
    )


COMPARED = [
    "monthly_rent", "rent_to_income_ratio", "mortgage_to_income_ratio", "home_price_to_income_ratio",
    "unemployment_rate", "median_household_income",
]


def compare_to(metrics: DataFrame, city: str, others: Sequence[str] | None = None) -> DataFrame:
    """Every city (or those named) next to one chosen city, month by month and per bedroom type.

    The chosen city has one row per month and bedroom type, so this is one match
    per row and never all pairs of cities.
    """
    base = metrics.filter(F.col("city_display") == city).select(
        "full_date", "bedroom_type", *[F.col(c).cast("double").alias(f"base_{c}") for c in COMPARED]
    )
    rows = metrics.filter(F.col("city_display") != city)
    if others is not None:
        rows = rows.filter(F.col("city_display").isin(*others))
    both = rows.join(base, ["full_date", "bedroom_type"])
    return both.select(
        *CITY, "full_date", "bedroom_type", F.lit(city).alias("base_city"),
        *[F.col(c).cast("double").alias(c) for c in COMPARED],
        *[F.col(f"base_{c}") for c in COMPARED],
        *[half_up(F.col(c).cast("double") - F.col(f"base_{c}"), 4).alias(f"diff_{c}") for c in COMPARED],
    )


def relocation_savings(metrics: DataFrame, destination: str | None = None, income: float = 75000.0) -> DataFrame:
    """Rent saved per month and per year by moving from each city to the destination.

    Without a named destination it is the 'Opportunity City' with the lowest
    newest rent, found by an aggregate.
    """
    cities = latest_city_rows(metrics, [*CITY, "monthly_rent"])
    if destination is None:
        good = classify(metrics).filter(F.col("city_classification") == "Opportunity City").select("geo_id")
        pool = cities.join(good, ["geo_id"], "left_semi")
    else:
        pool = cities.filter(F.col("city_display") == destination)
    target = pool.agg(
        F.min(F.struct(F.col("monthly_rent").cast("double").alias("rent"), F.col("city_display").alias("city")))
    ).scalar()
    rent = F.col("monthly_rent").cast("double")
    there = F.col("__to.rent")
    return cities.withColumn("__to", target).select(
        *CITY, rent.alias("monthly_rent"), F.col("__to.city").alias("destination"),
        half_up(rent - there, 2).alias("monthly_saving"),
        half_up((rent - there) * 12, 2).alias("annual_saving"),
        finance.ratio(rent * 12, F.lit(income), 4).alias("burden_here"),
        finance.ratio(there * 12, F.lit(income), 4).alias("burden_there"),
    )
