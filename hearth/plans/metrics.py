"""The affordability view: rent as the time spine, every other source joined on its own grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions import dates, finance
from hearth.functions.numeric import half_up
from hearth.operators.lookup import (
    asof_all, asof_left, exact_or_latest, exact_or_latest_scalar, join_per_key, latest_per_key, latest_rows,
)

RENT_LIMIT, SEVERE_LIMIT, DOWN_PAYMENT, TERM_YEARS = 0.30, 0.50, 0.20, 30
INCOME_COLS = ["median_household_income", "per_capita_income", "population"]
LABOR_COLS = ["unemployment_rate", "employment_level"]
SNAPSHOT_KEYS = ("geo_id", "bedroom_type")


def _dated(fact: DataFrame) -> DataFrame:
    """Facts carry date_id; a frame that already has full_date is taken as it is."""
    return fact if "full_date" in fact.columns else fact.withColumn("full_date", dates.from_date_id("date_id"))


def spine(rent: DataFrame, geography: DataFrame) -> DataFrame:
    """Rent rows of active metros with their calendar columns."""
    places = geography.filter("is_active").drop("is_active", "census_cbsa", "zillow_name", "bls_area_code")
    r = _dated(rent).select("geo_id", "full_date", "monthly_rent", "annual_rent", "bedroom_type")
    d = F.col("full_date")
    return r.join(places, ["geo_id"]).withColumns(
        {
            "year": F.year(d),
            "quarter": F.quarter(d),
            "month": F.month(d),
            "month_name": F.date_format(d, "MMMM"),
            "__month": dates.month_of(d),
        }
    )


def with_income(df: DataFrame, income: DataFrame, mode: str) -> DataFrame:
    """mode: 'latest' survey for all history, 'exact' year, or 'asof' (last survey so far)."""
    src = income.select("geo_id", F.col("survey_year").alias("income_year"), *INCOME_COLS)
    if mode == "latest":
        newest = latest_per_key(src, ["geo_id"], "income_year", [*INCOME_COLS, "income_year"])
        return join_per_key(df, newest, ["geo_id"], "full_date")
    if mode == "exact":
        src = src.withColumn("year", F.col("income_year"))
        return df.join(src, ["geo_id", "year"], "left")
    if mode == "asof":
        src = src.withColumn("__since", F.col("income_year"))
        return asof_left(df, src, ["geo_id"], "year", "__since", [*INCOME_COLS, "income_year"])
    raise ValueError(f"income_mode: {mode}")


def _with_monthly(df: DataFrame, src: DataFrame, cols: list[str], fallback: str) -> DataFrame:
    src = _dated(src).select("geo_id", dates.month_of("full_date").alias("__month"), *cols)
    if fallback == "latest":
        return exact_or_latest(df, src, ["geo_id"], "__month", cols)
    if fallback == "asof":
        return asof_left(df, src.withColumnRenamed("__month", "__since"), ["geo_id"], "__month", "__since", cols)
    if fallback == "none":
        return df.join(src, ["geo_id", "__month"], "left")
    raise ValueError(f"fallback: {fallback}")


def with_rate(df: DataFrame, rates: DataFrame, fallback: str) -> DataFrame:
    src = _dated(rates).select(dates.month_of("full_date").alias("__month"), "rate_30yr_fixed")
    if fallback == "latest":
        return exact_or_latest_scalar(df, src, "__month", "rate_30yr_fixed")
    if fallback == "asof":
        one = src.select(F.lit(1).alias("__one"), F.col("__month").alias("__since"), "rate_30yr_fixed")
        return asof_left(df.withColumn("__one", F.lit(1)), one, ["__one"], "__month", "__since", ["rate_30yr_fixed"]).drop("__one")
    return df.join(src, ["__month"], "left")


def add_metrics(df: DataFrame, down: float = DOWN_PAYMENT, years: int = TERM_YEARS) -> DataFrame:
    """Ratios, payment, gap and burden flags from the joined source columns."""
    inc = F.col("median_household_income").cast("double")
    affordable = inc * RENT_LIMIT / 12
    payment = finance.payment_unrounded("median_home_price", "rate_30yr_fixed", down, years)
    return df.withColumns(
        {
            "rent_to_income_ratio": finance.ratio("annual_rent", inc, 4),
            "affordable_monthly_rent": half_up(affordable, 2),
            "monthly_rent_gap": half_up(F.col("monthly_rent").cast("double") - affordable, 2),
            "is_cost_burdened": finance.over("annual_rent", inc, RENT_LIMIT),
            "is_severely_burdened": finance.over("annual_rent", inc, SEVERE_LIMIT),
            "home_price_to_income_ratio": finance.ratio("median_home_price", inc, 2),
            "est_monthly_mortgage": half_up(payment, 2),
            "mortgage_to_income_ratio": finance.ratio(payment * 12, inc, 4),
            "down_payment_required": half_up(F.col("median_home_price").cast("double") * down, 2),
        }
    )


#: The sources behind each column that is not the rents' own.
BEHIND = {
    **dict.fromkeys([*INCOME_COLS, "income_year", "rent_to_income_ratio", "affordable_monthly_rent", "monthly_rent_gap", "is_cost_burdened", "is_severely_burdened"], {"income"}),
    **dict.fromkeys(LABOR_COLS, {"labor"}),
    **dict.fromkeys(["median_home_price", "down_payment_required"], {"home"}),
    "rate_30yr_fixed": {"rates"}, "home_price_to_income_ratio": {"home", "income"}, "est_monthly_mortgage": {"home", "rates"},
    "mortgage_to_income_ratio": {"home", "rates", "income"},
}
#: The typed NULLs that stand for the columns of a source that is left out.
_ABSENT = {
    "income": {**dict.fromkeys(INCOME_COLS[:2], "decimal(12,2)"), "population": "bigint", "income_year": "int"},
    "labor": {"unemployment_rate": "decimal(5,2)", "employment_level": "bigint"}, "home": {"median_home_price": "decimal(12,2)"}, "rates": {"rate_30yr_fixed": "decimal(6,4)"},
}


def sources_of(columns: Sequence[str] | None) -> set[str]:
    """The sources that the view joins to its rents for these columns; all of them for None."""
    return set().union(*BEHIND.values()) if columns is None else set().union(*(BEHIND.get(c, set()) for c in columns))


def _with_all_asof(df: DataFrame, sources: Mapping[str, DataFrame], geography: DataFrame) -> DataFrame:
    """All sources as they were known in each month, in one pass over the rents. The national rates count in every metro."""
    events = []
    if "income" in sources:
        src = sources["income"].select("geo_id", F.col("survey_year").alias("income_year"), *INCOME_COLS)
        events.append((src.withColumn("__since", F.make_date("income_year", F.lit(1), F.lit(1))), [*INCOME_COLS, "income_year"]))
    for name, cols in (("labor", LABOR_COLS), ("home", ["median_home_price"])):
        if name in sources:
            events.append((_dated(sources[name]).select("geo_id", dates.month_of("full_date").alias("__since"), *cols), cols))
    if "rates" in sources:
        known = _dated(sources["rates"]).select(dates.month_of("full_date").alias("__since"), "rate_30yr_fixed").where("__since IS NOT NULL")
        series = known.agg(F.collect_list(F.struct("__since", "rate_30yr_fixed")).alias("s")).scalar()  # one national value a month
        events.append((geography.select("geo_id", F.inline(series)), ["rate_30yr_fixed"]))
    return asof_all(df, ["geo_id"], "__month", [(src, "__since", cols) for src, cols in events], "full_date")


def affordability_metrics(
    rent: DataFrame,
    home: DataFrame | None,
    income: DataFrame | None,
    labor: DataFrame | None,
    rates: DataFrame | None,
    geography: DataFrame,
    income_mode: str = "latest",
    fallback: str = "latest",
    home_type: str = "All Homes",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per rent observation, with incomes, labor, prices, rates and all metrics.

    Where a source has no row for the month, ``fallback`` decides: its newest row
    ('latest'), its last row so far ('asof') or NULL ('none'). With ``columns``, sources behind none of
    them are not joined (they may be None), and what rests on these is NULL.
    """
    prices = None if home is None else home.filter(F.col("home_type") == home_type)
    sources = {n: s for n, s in (("income", income), ("labor", labor), ("home", prices), ("rates", rates)) if n in sources_of(columns)}
    df = spine(rent, geography)
    if income_mode == fallback == "asof":
        df = _with_all_asof(df, sources, geography) if sources else df
    else:
        if "income" in sources:
            df = with_income(df, sources["income"], income_mode)
        for name, cols in (("labor", LABOR_COLS), ("home", ["median_home_price"])):
            if name in sources:
                df = _with_monthly(df, sources[name], cols, fallback)
        if "rates" in sources:
            df = with_rate(df, sources["rates"], fallback)
    absent = {c: F.lit(None).cast(kind) for name, cols in _ABSENT.items() if name not in sources for c, kind in cols.items()}
    return add_metrics(df.drop("__month").withColumns(absent) if absent else df.drop("__month"))


def metrics_exact(rent, home, income, labor, rates, geography) -> DataFrame:
    """First version of the view: same day for every source, same year for income, no fallback."""
    df = spine(rent, geography).drop("__month")
    df = with_income(df, income, "exact").drop("income_year")
    df = df.join(_dated(labor).select("geo_id", "full_date", *LABOR_COLS), ["geo_id", "full_date"], "left")
    df = df.join(_dated(home).select("geo_id", "full_date", "median_home_price"), ["geo_id", "full_date"], "left")
    df = df.join(_dated(rates).select("full_date", "rate_30yr_fixed"), ["full_date"], "left")
    return add_metrics(df)


def latest_snapshot(metrics: DataFrame) -> DataFrame:
    """Newest row of each metro and bedroom type."""
    return latest_rows(metrics, SNAPSHOT_KEYS, "full_date")


def snapshot_report(metrics: DataFrame) -> DataFrame:
    cols = [
        "city_display", "full_date", "monthly_rent", "median_household_income", "unemployment_rate",
        "rent_to_income_ratio", "est_monthly_mortgage", "mortgage_to_income_ratio",
    ]
    rows = latest_snapshot(metrics.filter(F.col("bedroom_type") == "All Homes"))
    return rows.select(*cols).orderBy(F.col("rent_to_income_ratio").desc_nulls_last())
