"""Indicators built on the affordability view."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions import dates, finance, stats
from hearth.functions.numeric import half_up
from hearth.operators.lookup import latest_per_key, with_prior
from hearth.operators.ranking import rank_desc
from hearth.seeds import ALL_HOMES

CITY = ["geo_id", "city_display"]
# A constant series can show a spread of the order of rounding errors.
NO_SPREAD = 1e-9


def latest_city_rows(metrics: DataFrame, cols: list[str]) -> DataFrame:
    """One row per city: its newest all-homes row."""
    rows = metrics.filter(F.col("bedroom_type") == ALL_HOMES)
    rest = [c for c in cols if c != "geo_id"]
    return latest_per_key(rows, ["geo_id"], "full_date", rest).select(*cols)


def with_pressure(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn(
        "pressure_score",
        finance.pressure_score("rent_to_income_ratio", "mortgage_to_income_ratio", "unemployment_rate"),
    )


def with_years_to_save(metrics: DataFrame, savings_rate: float = 0.10) -> DataFrame:
    return metrics.withColumn(
        "years_to_save", finance.years_to_save("down_payment_required", "median_household_income", savings_rate)
    )


def classify(metrics: DataFrame, center: str = "mean") -> DataFrame:
    """Quadrant of each city against the cross-city centre of rent burden and unemployment.

    A value equal to the centre counts as low; a missing input gives 'Unclassified'.
    """
    cols = [
        "geo_id", "city_display", "state_abbr", "region", "rent_to_income_ratio", "unemployment_rate",
        "median_household_income",
    ]
    cities = latest_city_rows(metrics, cols)
    if center == "mean":
        mid_rti, mid_unemp = stats.exact_mean("rent_to_income_ratio", 4), stats.exact_mean("unemployment_rate", 2)
    elif center == "median":
        mid_rti, mid_unemp = F.median("rent_to_income_ratio"), F.median("unemployment_rate")
    else:
        raise ValueError(f"center: {center}")
    middle = cities.agg(F.struct(mid_rti.alias("rti"), mid_unemp.alias("unemp")).alias("m")).scalar()
    rti, unemp = F.col("rent_to_income_ratio"), F.col("unemployment_rate").cast("double")
    mid = F.col("__mid")
    dear, slack = rti > mid["rti"], unemp > mid["unemp"]
    label = (
        F.when(dear.isNull() | slack.isNull(), "Unclassified")
        .when(~dear & ~slack, "Opportunity City")
        .when(dear & ~slack, "Lifestyle Premium City")
        .when(~dear & slack, "Budget Risk City")
        .otherwise("Pressure City")
    )
    return cities.withColumn("__mid", middle).withColumn("city_classification", label).drop("__mid")


def pressure_ranking(metrics: DataFrame) -> DataFrame:
    """Cities by pressure score, and by rent burden, highest first."""
    cols = [*CITY, "full_date", "rent_to_income_ratio", "pressure_score"]
    cities = latest_city_rows(with_pressure(metrics), cols)
    return rank_desc(rank_desc(cities, "pressure_score", "pressure_rank"), "rent_to_income_ratio", "burden_rank")


def most_stressed(metrics: DataFrame, k: int = 5) -> DataFrame:
    """The k cities with the highest score in their newest month."""
    cities = latest_city_rows(with_pressure(metrics), [*CITY, "pressure_score"])
    return cities.orderBy(F.col("pressure_score").desc_nulls_last(), "geo_id").limit(k)


def stressed_trend(metrics: DataFrame, k: int = 5) -> DataFrame:
    """The whole all-homes history of the k most stressed cities."""
    top = most_stressed(metrics, k).select("geo_id")
    rows = with_pressure(metrics).filter(F.col("bedroom_type") == ALL_HOMES)
    return rows.join(top, ["geo_id"], "left_semi").select(
        *CITY, "full_date", "rent_to_income_ratio", "mortgage_to_income_ratio", "unemployment_rate", "pressure_score"
    )


def rent_yoy(rent: DataFrame) -> DataFrame:
    """Growth of each rent over the same month one year before; NULL where that month is missing."""
    monthly = rent.select("geo_id", "bedroom_type", dates.month_index("full_date").alias("m"), F.col("monthly_rent").cast("double").alias("monthly_rent"))
    paired = with_prior(monthly, ["geo_id", "bedroom_type"], "m", 12, "monthly_rent", "prior_rent")
    year = F.floor((F.col("m") - 1) / 12).cast("int")
    return paired.select(
        "geo_id", "bedroom_type", year.alias("year"), (F.col("m") - year * 12).alias("month"),
        "monthly_rent", "prior_rent", finance.growth("monthly_rent", "prior_rent").alias("rent_growth_yoy"),
    )


def income_yoy(income: DataFrame) -> DataFrame:
    annual = income.select("geo_id", "survey_year", F.col("median_household_income").cast("double").alias("income"))
    paired = with_prior(annual, ["geo_id"], "survey_year", 1, "income", "prior_income")
    return paired.withColumn("income_growth_yoy", finance.growth("income", "prior_income"))


def annual_rent_means(rent: DataFrame) -> DataFrame:
    """(geo_id, year, rent): mean all-homes rent of the year."""
    rows = rent.filter(F.col("bedroom_type") == ALL_HOMES)
    return rows.groupBy("geo_id", F.year("full_date").alias("year")).agg(stats.exact_mean("monthly_rent").alias("rent"))


def _annual_income(income: DataFrame) -> DataFrame:
    return income.select("geo_id", F.col("survey_year").alias("year"), F.col("median_household_income").cast("double").alias("income"))


def rent_income_divergence(rent: DataFrame, income: DataFrame, base_year: int | None = None) -> DataFrame:
    """Cumulative rent growth minus cumulative income growth since the base year.

    The base is the city's first year with both values, or the first such year
    from ``base_year`` on. The window below holds one row per city and year.
    """
    both = annual_rent_means(rent).join(_annual_income(income), ["geo_id", "year"])
    if base_year is not None:
        both = both.filter(F.col("year") >= base_year)
    w = Window.partitionBy("geo_id").orderBy("year")
    grown = both.withColumns(
        {
            "base_year": F.first("year").over(w),
            "rent_growth": finance.growth("rent", F.first("rent").over(w)),
            "income_growth": finance.growth("income", F.first("income").over(w)),
        }
    )
    return grown.select(
        "geo_id", "year", "base_year", "rent_growth", "income_growth",
        half_up(F.col("rent_growth") - F.col("income_growth"), 4).alias("divergence"),
    )


def growth_gap_by_year(rent: DataFrame, income: DataFrame) -> DataFrame:
    """Cross-city mean growth of rents and of incomes, per year."""
    rents = with_prior(annual_rent_means(rent), ["geo_id"], "year", 1, "rent", "prior")
    rents = rents.select("geo_id", "year", finance.growth("rent", "prior").alias("rent_growth"))
    incomes = with_prior(_annual_income(income), ["geo_id"], "year", 1, "income", "prior")
    incomes = incomes.select("geo_id", "year", finance.growth("income", "prior").alias("income_growth"))
    per_year = lambda df, c: df.groupBy("year").agg(half_up(stats.exact_mean(c, 4), 4).alias(f"avg_{c}"))
    out = per_year(rents, "rent_growth").join(per_year(incomes, "income_growth"), ["year"], "left")
    return out.withColumn("growth_gap", half_up(F.col("avg_rent_growth") - F.col("avg_income_growth"), 4))


def zscore(metrics: DataFrame, unusual: float = 2.0, population: bool = False) -> DataFrame:
    """Newest rent burden of each city against the city's own history.

    One aggregation gives the newest value, mean and spread. NULL where the
    city has fewer than two values or no spread.
    """
    rti = F.col("rent_to_income_ratio")
    spread = F.stddev_pop(rti) if population else F.stddev_samp(rti)
    per_city = metrics.filter(F.col("bedroom_type") == ALL_HOMES).groupBy(*CITY).agg(
        F.max_by(rti, "full_date").alias("current_rti"),
        stats.exact_mean(rti, 4).alias("__mean"),
        spread.alias("__sd"),
        F.count(rti).alias("months"),
    )
    z = (F.col("current_rti") - F.col("__mean")) / F.when(F.col("__sd") > NO_SPREAD, F.col("__sd"))
    return per_city.select(
        *CITY, "current_rti", half_up("__mean", 4).alias("mean_rti"), half_up("__sd", 4).alias("sd_rti"), "months",
        half_up(z, 4).alias("zscore"), F.when(z > unusual, 1).otherwise(0).alias("is_unusual"),
    )


def annual_zscore(metrics: DataFrame) -> DataFrame:
    """(geo_id, year, zscore): the year's mean rent burden against the city's history."""
    rows = metrics.filter(F.col("bedroom_type") == ALL_HOMES).select("geo_id", "year", "rent_to_income_ratio")
    yearly = rows.groupBy("geo_id", "year").agg(
        stats.exact_mean("rent_to_income_ratio", 4).alias("rti"),
        F.count("rent_to_income_ratio").alias("n"),
        F.sum(F.col("rent_to_income_ratio").cast("decimal(10,4)") * F.col("rent_to_income_ratio").cast("decimal(10,4)")).alias("sq"),
        stats.exact_sum("rent_to_income_ratio", 4).alias("s"),
    )
    # The yearly sums add up to the history's; one row per city and year from here on.
    w = Window.partitionBy("geo_id")
    n, s, sq = F.sum("n").over(w), F.sum("s").over(w).cast("double"), F.sum("sq").over(w).cast("double")
    sd = F.sqrt(F.greatest((sq - s * s / F.nullif(n, F.lit(0))) / F.nullif(n - 1, F.lit(0)), F.lit(0.0)))
    return yearly.select(
        "geo_id", "year",
        half_up((F.col("rti") - s / F.nullif(n, F.lit(0))) / F.when(sd > NO_SPREAD, sd), 4).alias("zscore"),
    )


def signals(metrics: DataFrame, rent: DataFrame, income: DataFrame) -> DataFrame:
    """Z-score, divergence and mean pressure score of each city and year."""
    pressure = (
        with_pressure(metrics).filter(F.col("bedroom_type") == ALL_HOMES)
        .groupBy(*CITY, "year").agg(half_up(stats.exact_mean("pressure_score"), 2).alias("pressure_score"))
    )
    return (
        pressure.join(annual_zscore(metrics), ["geo_id", "year"])
        .join(rent_income_divergence(rent, income).select("geo_id", "year", "divergence"), ["geo_id", "year"])
    )


def driver_split(metrics: DataFrame) -> DataFrame:
    """Whether a city's rent burden comes from its incomes, its rents, or both (our own definition).

    Each is compared with the cross-city mean of the newest month's values.
    """
    cities = latest_city_rows(metrics, [*CITY, "median_household_income", "monthly_rent", "rent_to_income_ratio"])
    middle = cities.agg(
        F.struct(
            stats.exact_mean("median_household_income").alias("income"), stats.exact_mean("monthly_rent").alias("rent")
        )
    ).scalar()
    rich = F.col("median_household_income").cast("double") > F.col("__mid.income")
    cheap = F.col("monthly_rent").cast("double") <= F.col("__mid.rent")
    label = (
        F.when(rich.isNull() | cheap.isNull(), "unknown")
        .when(rich & cheap, "high income and cheap housing")
        .when(rich, "high income")
        .when(cheap, "cheap housing")
        .otherwise("neither")
    )
    return cities.withColumn("__mid", middle).withColumn("driver", label).drop("__mid")


def stress_lead_time(metrics: DataFrame, rent: DataFrame, income: DataFrame, divergence_limit: float = 0.0, burden_limit: float = 0.30) -> DataFrame:
    """Days from a city's first year of divergence to its first month above the burden limit.

    Positive: the divergence came first (our own definition).
    """
    first_signal = (
        rent_income_divergence(rent, income).filter(F.col("divergence") > divergence_limit)
        .groupBy("geo_id").agg(F.make_date(F.min("year"), F.lit(1), F.lit(1)).alias("first_divergence"))
    )
    exact = {"annual_rent", "median_household_income"} <= set(metrics.columns)  # the stored ratio is rounded
    burdened = finance.over("annual_rent", "median_household_income", burden_limit) == 1 if exact else F.col("rent_to_income_ratio") > burden_limit
    cities = metrics.filter(F.col("bedroom_type") == ALL_HOMES).groupBy(*CITY).agg(
        F.min(F.when(burdened, F.col("full_date"))).alias("first_burden")
    )
    return cities.join(first_signal, ["geo_id"], "left").select(
        *CITY, "first_divergence", "first_burden", F.datediff("first_burden", "first_divergence").alias("lead_days")
    )
