"""The registered queries: every operator of the library on the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth import seeds
from hearth.functions import clean, dates, stats
from hearth.functions.numeric import half_up
from hearth.operators import lookup, quality, reshape, versions
from hearth.operators.upsert import quarantine
from hearth.plans import conform, dims, indicators, profiles, publish, whatif
from hearth.plans import metrics as view
from hearth.seeds import ALL_HOMES
from hearth.session import materialize, scratch_path
from hearth.sources import fmr, income, rates, series, wide
from hearth.sources.landing import files
from hearth.twin import landed
from hearth.twin import tables as t

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
LOAD_DATE = date(2001, 12, 31)
SINCE = date(1996, 1, 1)


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Stored types as plain ones: decimals as doubles, short integers as integers."""
    def one(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        return F.col(f.name).cast("int").alias(f.name) if isinstance(f.dataType, T.ShortType) else F.col(f.name)

    return df.select(*[one(f) for f in df.schema])


def metrics(spark: SparkSession, sf: str, columns=None, **options) -> DataFrame:
    """The view; with ``columns``, only the sources behind them are built and joined."""
    return view.affordability_metrics(**t.star(spark, sf, view.sources_of(columns)), columns=columns, **options)


def stored_metrics(spark: SparkSession, sf: str, columns=None) -> DataFrame:
    """The view written as a table, for indicators that read it more than once."""
    return materialize(metrics(spark, sf, columns), "metrics")


def places(spark: SparkSession, sf: str) -> DataFrame:
    return t.geography(spark, sf)


PRICE_AND_INCOME = ["median_home_price", "median_household_income"]
VIEW_COLS = [
    "geo_id", "city_display", "metro_name", "state_abbr", "region", "full_date", "year", "quarter", "month", "month_name",
    "monthly_rent", "annual_rent", "bedroom_type", "median_household_income", "per_capita_income", "population",
    "income_year", "unemployment_rate", "employment_level", "median_home_price", "rate_30yr_fixed",
    "rent_to_income_ratio", "affordable_monthly_rent", "monthly_rent_gap", "is_cost_burdened", "is_severely_burdened",
    "home_price_to_income_ratio", "est_monthly_mortgage", "mortgage_to_income_ratio", "down_payment_required",
]


# --- sources ---------------------------------------------------------------


@query
def src_wide_rent(spark, sf):
    """Two files that share some months, the older one outdated there, behind a candidate that is absent and one that cannot be read."""
    rents = t.rent(spark, sf).filter(F.col("bedroom_type") == ALL_HOMES)
    folder = scratch_path(spark, "rent_files")
    table = materialize(landed.wide(spark, sf, rents, "monthly_rent"), "wide_rent")
    for name, part in zip(("rent_1", "rent_2"), landed.overlapping(table), strict=True):
        part.write.option("header", True).csv(f"{folder}/{name}")
    t.read(spark, sf, "region").select("r_name").write.option("header", True).csv(f"{folder}/other")
    raw = wide.read_wide(spark, [f"{folder}/absent*", f"{folder}/other*", f"{folder}/rent_*"])
    return wide.staged_rent(raw, t.listing(places(spark, sf)), SINCE)


@query
def src_wide_home(spark, sf):
    path = landed.write_csv(landed.wide(spark, sf, t.home(spark, sf), "median_home_price"), "home_csv")
    return wide.staged_home(wide.read_wide(spark, [path]), t.listing(places(spark, sf)), SINCE)


@query
def src_rate_csv(spark, sf):
    path = landed.write_csv(landed.rate_csv(spark, sf), "rate_csv")
    return rates.weekly_rates(rates.read_rate_csv(spark, path), SINCE)


@query
def src_rate_json(spark, sf):
    path = landed.write_json(landed.rate_json(spark, sf), "rate_json")
    return rates.observed_rates(rates.read_observations(spark, path, multi_line=False))


@query
def src_rate_fallback(spark, sf):
    """Monthly rates from the CSV, as the JSON is broken off."""
    broken = scratch_path(spark, "rate_broken")
    landed.cut_off(landed.rate_json(spark, sf)).coalesce(1).write.text(broken)
    return rates.read_rates(spark, [broken + "__absent", broken], [landed.write_csv(landed.rate_csv(spark, sf), "rate_csv")], SINCE)


@query
def src_income_matrix(spark, sf):
    return income.staged_income(landed.income_matrix(spark, sf), landed.code_crosswalk(places(spark, sf)))


@query
def src_multi_year_union(spark, sf):
    """All survey years that have landed, one folder each."""
    path = scratch_path(spark, "income_years")
    landed.income_matrix(spark, sf).repartition("survey_year").write.partitionBy("survey_year").text(path)
    years = {int(f.rsplit("=", 1)[1]): f for f in files(spark, f"{path}/survey_year=*")}
    return income.staged_income(income.read_years(spark, years), landed.code_crosswalk(places(spark, sf)))


def _labor_ids(spark, sf):
    return series.series_ids(landed.labor_areas(places(spark, sf)), seeds.LABOR_MEASURES)


@query
def src_labor_json(spark, sf):
    labor = materialize(t.labor(spark, sf), "labor")
    (first, last), _ = landed.windows(labor, 1)
    path = landed.write_json(landed.labor_responses(spark, sf, first, last, labor), "labor_json")
    obs = series.observations(series.read_responses(spark, path, multi_line=False))
    return series.staged_labor(obs, _labor_ids(spark, sf), SINCE)


@query
def src_cpi_json(spark, sf):
    path = landed.write_json(landed.cpi_responses(spark, sf), "cpi_json")
    obs = series.observations(series.read_responses(spark, path, multi_line=False))
    named = series.fan_out_cpi(series.staged_cpi(obs, LOAD_DATE), t.cpi_bridge(spark, sf))
    return plain(named.drop("load_date"))


def landed_fmr(spark, sf):
    path = landed.write_json(landed.fmr_responses(spark, sf), "fmr_json")
    return spark.read.schema("entity_id string, requested_year int, payload string").json(path)


@query
def src_fmr_variant(spark, sf):
    return fmr.parse(landed_fmr(spark, sf))


@query
def fmr_newest_year(spark, sf):
    return fmr.staged_fmr(landed_fmr(spark, sf), landed.fmr_crosswalk(places(spark, sf)), LOAD_DATE).drop("load_date")


def _landed_windows(spark, sf):
    """Three request windows, one without a month, and one whose documents are cut off."""
    labor = materialize(t.labor(spark, sf), "labor")
    folder = scratch_path(spark, "labor_windows")
    for i, (a, b) in enumerate(landed.windows(labor, 3)):
        landed.labor_responses(spark, sf, a, b, labor).write.json(f"{folder}/window_{i}")
    landed.cut_off(landed.labor_responses(spark, sf, *landed.windows(labor, 1)[0], labor)).write.text(f"{folder}/window_cut")
    return [series.read_responses(spark, f, multi_line=False) for f in files(spark, f"{folder}/window_*")]


@query
def union_windows(spark, sf):
    """What the readable documents of all landed windows say."""
    obs = series.union_windows(_landed_windows(spark, sf))
    return obs.select("series_id", "report_date", clean.rate("value_text").alias("value"))


@query
def skipped_windows(spark, sf):
    """The documents that were passed over, by window and reason."""
    parts = [series.skipped_responses(w) for w in _landed_windows(spark, sf)]
    window = F.regexp_extract(series.SOURCE, "(window_[0-9a-z]+)/[^/]*$", 1)
    return reduce(DataFrame.unionByName, parts).groupBy(window.alias("request_window"), "reason").agg(F.count("*").alias("documents"))


@query
def series_id_build(spark, sf):
    ids = _labor_ids(spark, sf)
    sizes = t.read(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("geo_id")).agg(F.count("*").alias("customers"))
    named = places(spark, sf).select("geo_id", "city_display").join(sizes, ["geo_id"], "left")
    return ids.join(named.drop("geo_id"), ["city_display"])


# --- dimensions and conformed facts ------------------------------------------


@query
def dim_geography(spark, sf):
    sizes = t.read(spark, sf, "customer").groupBy((F.col("c_nationkey") + 1).alias("geo_id")).agg(
        F.count("*").alias("customers")
    )
    geo = dims.geography(spark).drop("is_active")
    return plain(geo.join(sizes, ["geo_id"], "left"))


@query
def dim_date(spark, sf):
    per_day = t.read(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(F.count("*").alias("orders"))
    spine = dims.date_spine(spark, *t.span(spark, sf))
    return plain(spine.join(per_day, ["full_date"], "left").fillna({"orders": 0}))


@query
def dim_scenario(spark, sf):
    paid = whatif.scenario_payment(metrics(spark, sf, PRICE_AND_INCOME))
    used = paid.groupBy("scenario_id").agg(
        F.count("*").alias("metric_rows"), half_up(stats.exact_mean("scenario_payment"), 2).alias("mean_payment")
    )
    return plain(dims.scenarios(spark).join(used, ["scenario_id"], "left"))


@query
def crosswalk_values_join(spark, sf):
    geo = places(spark, sf)
    staged = t.rent(spark, sf).join(geo.select("geo_id", "city_display", "state_abbr"), ["geo_id"]).select(
        t.listing_name(F.col("city_display"), F.col("state_abbr")).alias("metro_raw"), "full_date", "bedroom_type", "monthly_rent"
    )
    return plain(conform.geo_by_crosswalk(staged, t.listing(geo), geo).drop("city_display"))


def staged_rent(spark, sf):
    geo = places(spark, sf).select("geo_id", "city_display", "state_abbr")
    return t.rent(spark, sf).join(geo, ["geo_id"]).select(
        t.listing_name(F.col("city_display"), F.col("state_abbr")).alias("metro_raw"),
        F.col("full_date").alias("report_date"), "monthly_rent", "bedroom_type", F.lit("Zillow ZORI").alias("data_source"),
    )


def staged_home(spark, sf):
    geo = places(spark, sf).select("geo_id", "city_display", "state_abbr")
    return t.home(spark, sf).join(geo, ["geo_id"]).select(
        t.listing_name(F.col("city_display"), F.col("state_abbr")).alias("metro_raw"),
        F.col("full_date").alias("report_date"), "median_home_price", "home_type", F.lit("Zillow ZHVI").alias("data_source"),
    )


def staged_income(spark, sf):
    named = t.income(spark, sf).join(places(spark, sf).select("geo_id", F.col("metro_name").alias("metro_raw")), ["geo_id"])
    return named.drop("geo_id").withColumn("data_source", F.lit("Census ACS 5-Year"))


def staged_labor(spark, sf):
    named = t.labor(spark, sf).join(places(spark, sf).select("geo_id", F.col("city_display").alias("metro_raw")), ["geo_id"])
    return named.drop("geo_id").withColumnRenamed("full_date", "report_date").withColumn("data_source", F.lit("BLS LAUS"))


def staged_fmr(spark, sf):
    named = t.fmr(spark, sf).join(places(spark, sf).select("geo_id", F.col("city_display").alias("city"), "metro_name"), ["geo_id"])
    return named.select(
        landed.entity("geo_id").alias("entity_id"), "city", "metro_name", "fmr_year", *[n for n, _ in fmr.BEDROOMS],
        F.lit(40).alias("fmr_percentile"), F.lit(1).alias("smallarea_flag"), F.lit(LOAD_DATE).alias("load_date"),
    )


@query
def fact_rent(spark, sf):
    geo = places(spark, sf)
    return plain(conform.fact_rent(staged_rent(spark, sf), t.listing(geo), geo))


@query
def fact_home(spark, sf):
    geo = places(spark, sf)
    return plain(conform.fact_home(staged_home(spark, sf), t.listing(geo), geo))


@query
def fact_income(spark, sf):
    return plain(conform.fact_income(staged_income(spark, sf), places(spark, sf), t.NATION_KEYS))


@query
def fact_labor(spark, sf):
    return plain(conform.fact_labor(staged_labor(spark, sf), places(spark, sf)))


@query
def fact_rate(spark, sf):
    staged = rates.staged_rates(t.rates(spark, sf).withColumnRenamed("full_date", "report_date"))
    return plain(conform.fact_rate(staged))


def _cpi_cities(spark, sf):
    staged = t.cpi(spark, sf).withColumns(
        {
            "year": F.year("report_date"), "month": F.month("report_date"), "cpi_category": F.lit("All Items"),
            "data_source": F.lit("BLS CPI"), "load_date": F.lit(LOAD_DATE),
        }
    )
    return series.fan_out_cpi(staged, t.cpi_bridge(spark, sf))


@query
def fact_cpi(spark, sf):
    calendar = dims.date_spine(spark, *t.span(spark, sf))
    facts = conform.fact_cpi(_cpi_cities(spark, sf), places(spark, sf), calendar)
    return plain(facts.withColumn("is_national", F.col("is_national").cast("int")))


@query
def cpi_fanout(spark, sf):
    facts = materialize(conform.fact_cpi(_cpi_cities(spark, sf), places(spark, sf), dims.date_spine(spark, *t.span(spark, sf))), "fact_cpi")
    spine = t.rent(spark, sf).select("geo_id", F.col("full_date").alias("report_date")).distinct()
    return plain(conform.cpi_or_national(spine, facts))


@query
def fact_fmr(spark, sf):
    return plain(conform.fact_fmr(staged_fmr(spark, sf)))


@query
def star_join(spark, sf):
    geo = places(spark, sf)
    facts = conform.fact_rent(staged_rent(spark, sf), t.listing(geo), geo)
    joined = conform.star_join(facts, geo, dims.date_spine(spark, *t.span(spark, sf)))
    return plain(joined.select("geo_id", "date_id", "city_display", "region", "full_date", "year", "quarter", "month_name", "bedroom_type", "monthly_rent"))


@query
def like_join(spark, sf):
    staged = staged_income(spark, sf).select("metro_raw", "survey_year", "median_household_income")
    keys = [r.n_name for r in t.read(spark, sf, "nation").orderBy("n_nationkey").select("n_name").collect()]  # the metros
    return plain(conform.geo_by_pattern(staged, places(spark, sf), keys))


# --- sinks -------------------------------------------------------------------


@query
def staging_overwrite(spark, sf):
    """A staging table replaced by a part of itself."""
    warehouse = scratch_path(spark, "warehouse")
    versions.replace(spark, warehouse, {"staging_labor": staged_labor(spark, sf)})
    again = versions.read(spark, warehouse, "staging_labor").filter(F.col("report_date") >= F.lit(SINCE))
    versions.replace(spark, warehouse, {"staging_labor": again})
    return plain(versions.read(spark, warehouse, "staging_labor"))


@query
def upsert_fmr(spark, sf):
    """Later years merged into a table by its years; earlier years keep their files."""
    rows = materialize(conform.fact_fmr(staged_fmr(spark, sf)), "fmr")
    warehouse = scratch_path(spark, "warehouse")
    later = rows.filter("fmr_year >= 2000").withColumn("fmr_2br", (F.col("fmr_2br") + 1).cast("decimal(10,2)"))
    for part in (rows.filter("fmr_year <= 2000"), later):
        draft = versions.begin(spark, warehouse)
        draft.merge("fact_fmr", part, ["entity_id", "fmr_year"], "fmr_year")
        draft.commit()
    return plain(versions.read(spark, warehouse, "fact_fmr"))


@query
def quarantine_rows(spark, sf):
    """Every row with its outcome, written in one pass."""
    rows = landed.dirty_amounts(spark, sf).select("o_orderkey", "o_orderpriority", "raw")
    good, bad, _ = quarantine(rows, clean.survey_amount("raw").isNotNull(), scratch_path(spark, "quarantine"))
    return good.withColumn("outcome", F.lit("good")).unionByName(bad.withColumn("outcome", F.lit("quarantined")))


@query
def affordability_final(spark, sf):
    star = t.star(spark, sf)
    m = materialize(view.affordability_metrics(**star), "metrics")
    final = publish.affordability_final(m, star["income"])
    stored = versions.replace(spark, scratch_path(spark, "warehouse"), {"affordability_final": final})
    return plain(stored["affordability_final"].select(
        "geo_id", "full_date", "bedroom_type", "monthly_rent", "rent_to_income_ratio", "mortgage_to_income_ratio",
        "unemployment_rate", "pressure_score", "years_to_save", "rent_growth_yoy", "income_growth_yoy",
        "zscore", "divergence", "city_classification",
    ))


def _gate(spark, sf, *more):
    """The star and the flat table published behind the standard checks and ``more`` (name, failing rows of the tables)."""
    star = t.star(spark, sf)
    geo = star["geography"]
    dated = lambda df: df.withColumn("date_id", dates.date_id("full_date"))
    tables = {
        "fact_rent": dated(star["rent"]), "fact_home_prices": dated(star["home"]), "fact_income": star["income"],
        "fact_labor": dated(star["labor"]), "fact_mortgage_rates": dated(star["rates"]),
    }
    checks = publish.standard_checks(tables, geo, dims.date_spine(spark, *t.span(spark, sf)))
    checks |= {name: failing(tables) for name, failing in more}
    final = publish.affordability_final(materialize(view.affordability_metrics(**star), "metrics"), star["income"])
    steps = publish.publish(spark, scratch_path(spark, "gated"), {**tables, "affordability_final": final}, checks)
    return steps.status(spark).drop("message")


@query
def publish_gate(spark, sf):
    """A check that fails (no metro has a labor month) holds back all tables."""
    return _gate(spark, sf, ("no labor months", lambda tables: tables["fact_labor"]))


@query
def publish_gate_passed(spark, sf):
    """All checks pass, and the tables are published."""
    return _gate(spark, sf)



# --- cleaning, filters, reshaping ---------------------------------------------


def _cleaned(spark, sf, cleaner):
    return landed.dirty_amounts(spark, sf).select("o_orderkey", "raw", cleaner("raw").alias("cleaned"))


@query
def clean_money(spark, sf):
    return _cleaned(spark, sf, clean.money)


@query
def clean_rate(spark, sf):
    return _cleaned(spark, sf, clean.rate)


@query
def clean_income(spark, sf):
    return _cleaned(spark, sf, clean.survey_amount)


@query
def clean_int(spark, sf):
    return _cleaned(spark, sf, clean.integer)


@query
def clean_population(spark, sf):
    return _cleaned(spark, sf, clean.head_count)


@query
def rate_weekly_to_monthly(spark, sf):
    return rates.monthly_rates(rates.weekly_rates(landed.rate_csv(spark, sf).toDF("report_date", "rate_30yr_fixed"), t.span(spark, sf)[0] - timedelta(days=7)))


@query
def filter_metro_semi(spark, sf):
    geo = places(spark, sf)
    label = F.when(F.col("c_mktsegment") == "BUILDING", "Unknown Metro").otherwise(F.col("n_name"))
    c, n = t.read(spark, sf, "customer"), t.read(spark, sf, "nation")
    labelled = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", label.alias("city_display"), "c_mktsegment", "c_acctbal")
    return labelled.join(geo.select("city_display"), ["city_display"], "left_semi")


@query
def filter_since(spark, sf):
    o = t.read(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit(datetime(1998, 1, 1)).cast("timestamp_ntz"))
    return o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))


@query
def filter_monthly_period(spark, sf):
    line = t.read(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("m")).agg(F.count("*").alias("n"))
    monthly = line.select("year", F.concat(F.lit("M"), F.lpad(F.col("m").cast("string"), 2, "0")).alias("period"), "n")
    annual = line.groupBy("year").agg(F.sum("n").alias("n")).select("year", F.lit("M13").alias("period"), "n")
    quarter = line.select("year", F.concat(F.lit("Q0"), F.ceil(F.col("m") / 3).cast("string")).alias("period"), "n")
    kept = monthly.unionByName(annual).unionByName(quarter).filter(dates.is_monthly("period"))
    return kept.withColumn("report_date", dates.period_date(F.col("year").cast("string"), "period"))


@query
def unpivot_wide(spark, sf):
    table = landed.wide(spark, sf, t.rent(spark, sf).filter(F.col("bedroom_type") == ALL_HOMES), "monthly_rent")
    known = table.join(t.listing(places(spark, sf)).select(F.col("source_key").alias("RegionName")), ["RegionName"], "left_semi")
    return reshape.unpivot_dates(known, ["RegionName"], "monthly_rent")


@query
def pivot_measures(spark, sf):
    names = [n for _, n in seeds.LABOR_MEASURES]
    long = plain(t.labor(spark, sf)).select(
        "geo_id", "full_date", F.inline(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).cast("double").alias("value")) for n in names]))
    )
    return reshape.pivot_measures(long, ["geo_id", "full_date"], [*names, "absent_measure"], "measure")


@query
def fmr_by_bedroom(spark, sf):
    return plain(fmr.by_bedroom(plain(staged_fmr(spark, sf))))


@query
def dedupe_series(spark, sf):
    cpi = t.cpi(spark, sf)
    later = cpi.withColumn("cpi_index", F.col("cpi_index") + 1).filter(F.year("report_date") >= 1997)
    first = cpi.filter(F.year("report_date") <= 1998)
    readings = first.withColumn("seq", F.lit(0)).unionByName(later.withColumn("seq", F.lit(1)))
    return plain(lookup.first_per_key(readings, ["series_id", "report_date"], "seq", ["cpi_index"]))


@query
def date_parts(spark, sf):
    days = t.read(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.count("*").alias("orders"))
    parts = dates.calendar_columns("d")
    return days.select("orders", *[c.alias(n) for n, c in parts.items()]).withColumns(
        {"is_year_end": F.col("is_year_end").cast("int"), "month_start": dates.month_of("full_date"), "next_day": F.date_add("full_date", 1)}
    )


# --- joins ---------------------------------------------------------------------


@query
def affordability_metrics(spark, sf):
    return plain(metrics(spark, sf).select(*VIEW_COLS))


@query
def metrics_exact(spark, sf):
    star = t.star(spark, sf)
    return plain(view.metrics_exact(**star).select(*[c for c in VIEW_COLS if c != "income_year"]))


@query
def metrics_asof(spark, sf):
    cols = ["geo_id", "full_date", "bedroom_type", "median_household_income", "income_year", "unemployment_rate", "median_home_price", "rate_30yr_fixed", "rent_to_income_ratio"]
    return plain(metrics(spark, sf, income_mode="asof", fallback="asof").select(*cols))


@query
def join_latest_fallback(spark, sf):
    homes = t.home(spark, sf).select("geo_id", "full_date", "median_home_price")
    spine = t.rent(spark, sf).select("geo_id", "full_date", "bedroom_type")
    return plain(lookup.exact_or_latest(spine, homes, ["geo_id"], "full_date", ["median_home_price"]))


@query
def latest_income_join(spark, sf):
    sums = materialize(t.order_sums(spark, sf), "order_sums")
    rents = t.rent(spark, sf, sums).select("geo_id", "full_date", "bedroom_type", "monthly_rent")
    return plain(view.with_income(rents, t.income(spark, sf, sums), "latest"))


@query
def asof_income(spark, sf):
    sums = materialize(t.order_sums(spark, sf), "order_sums")
    rents = t.rent(spark, sf, sums).select("geo_id", "full_date", "bedroom_type", F.year("full_date").alias("year"))
    return plain(view.with_income(rents, t.income(spark, sf, sums), "asof").select("geo_id", "full_date", "bedroom_type", "income_year", "median_household_income"))


@query
def cross_scalar(spark, sf):
    spine = t.rent(spark, sf).select("geo_id", "full_date", "bedroom_type")
    return plain(lookup.exact_or_latest_scalar(spine, t.rates(spark, sf), "full_date", "rate_30yr_fixed"))


@query
def latest_snapshot(spark, sf):
    return plain(view.latest_snapshot(metrics(spark, sf)).select(*VIEW_COLS))


@query
def latest_snapshot_correlated(spark, sf):
    """The same by a correlated subquery in SQL, over the named view."""
    stored_metrics(spark, sf).createOrReplaceTempView("twin_affordability_metrics")
    return plain(spark.sql(f"""
        SELECT {", ".join(VIEW_COLS)} FROM twin_affordability_metrics a
        WHERE full_date = (SELECT MAX(b.full_date) FROM twin_affordability_metrics b
                           WHERE b.geo_id = a.geo_id AND b.bedroom_type = a.bedroom_type)
    """))


@query
def coverage_anti(spark, sf):
    """Months without a rent between the first and the last one, for every metro and bedroom type."""
    rents = materialize(t.rent(spark, sf), "rents")
    first, last = rents.agg(F.min("full_date"), F.max("full_date")).first()
    months = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))).alias("full_date")
    kinds = F.explode(F.array(F.lit(ALL_HOMES), F.lit("1br"))).alias("bedroom_type")
    grid = places(spark, sf).select("geo_id", months).select("geo_id", "full_date", kinds)
    return quality.missing_keys(grid, rents, "geo_id", "full_date", "bedroom_type")


@query
def city_compare(spark, sf):
    return whatif.compare_to(stored_metrics(spark, sf), "NATION_0")


# --- profiles and quality ---------------------------------------------------------


def _named(df, spark, sf):
    return df.join(places(spark, sf).select("geo_id", "city_display"), ["geo_id"])


@query
def profile_rent(spark, sf):
    return profiles.rent(_named(t.rent(spark, sf), spark, sf))


@query
def profile_home(spark, sf):
    return profiles.home(_named(t.home(spark, sf), spark, sf))


@query
def profile_income(spark, sf):
    return plain(profiles.income(_named(t.income(spark, sf), spark, sf)))


@query
def profile_labor(spark, sf):
    return plain(profiles.labor(_named(t.labor(spark, sf), spark, sf)))


@query
def profile_rate(spark, sf):
    return plain(profiles.rate(t.rates(spark, sf)))


@query
def profile_cpi(spark, sf):
    return plain(profiles.cpi(_cpi_cities(spark, sf)))


@query
def dq_null_counts(spark, sf):
    exact = view.metrics_exact(**t.star(spark, sf))
    return quality.null_counts(exact, ["monthly_rent", "median_household_income", "unemployment_rate", "median_home_price", "rate_30yr_fixed"])


@query
def dq_unmatched_geo(spark, sf):
    return profiles.unmatched(conform.fact_cpi(_cpi_cities(spark, sf), places(spark, sf), dims.date_spine(spark, *t.span(spark, sf))))


@query
def profile_columns(spark, sf):
    """Every column of the larger tables; distinct values are left to the sketches, whose estimates are no exact counts."""
    tables = {n: t.read(spark, sf, n) for n in ("customer", "orders", "lineitem")}
    return profiles.of_tables(tables).select("table_name", "column_name", "row_count", "null_count")


@query
def dq_row_counts(spark, sf):
    star = t.star(spark, sf)
    return quality.row_counts({k: star[k] for k in ("rent", "home", "income", "labor", "rates")})


@query
def coverage_counts(spark, sf):
    return profiles.coverage(t.rent(spark, sf))


@query
def dq_unique(spark, sf):
    return quality.duplicate_keys(t.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_orphans(spark, sf):
    return quality.orphans(t.labor(spark, sf), t.home(spark, sf), ["geo_id", "full_date"]).select("geo_id", "full_date", "employment_level")


# --- indicators -------------------------------------------------------------------


@query
def snapshot_report(spark, sf):
    return plain(view.snapshot_report(metrics(spark, sf)))


@query
def city_classification(spark, sf):
    return plain(indicators.classify(stored_metrics(spark, sf)))


@query
def city_classification_median(spark, sf):
    return plain(indicators.classify(stored_metrics(spark, sf), center="median"))


@query
def affordability_zscore(spark, sf):
    return indicators.zscore(metrics(spark, sf, ["rent_to_income_ratio"]))


@query
def rent_yoy(spark, sf):
    return indicators.rent_yoy(t.rent(spark, sf))


@query
def income_yoy(spark, sf):
    return indicators.income_yoy(t.income(spark, sf))


@query
def rent_income_divergence(spark, sf):
    sums = materialize(t.order_sums(spark, sf), "order_sums")
    return indicators.rent_income_divergence(t.rent(spark, sf, sums), t.income(spark, sf, sums))


@query
def growth_gap_by_year(spark, sf):
    sums = materialize(t.order_sums(spark, sf), "order_sums")
    return indicators.growth_gap_by_year(t.rent(spark, sf, sums), t.income(spark, sf, sums))


@query
def pressure_score(spark, sf):
    return plain(indicators.with_pressure(metrics(spark, sf)).select("geo_id", "full_date", "bedroom_type", "pressure_score"))


@query
def years_to_save(spark, sf):
    return plain(indicators.with_years_to_save(metrics(spark, sf, ["down_payment_required", "median_household_income"])).select("geo_id", "full_date", "bedroom_type", "down_payment_required", "years_to_save"))


@query
def pressure_ranking(spark, sf):
    return indicators.pressure_ranking(stored_metrics(spark, sf))


@query
def top5_stressed_trend(spark, sf):
    return plain(indicators.stressed_trend(stored_metrics(spark, sf)))


@query
def signals_join(spark, sf):
    star = t.star(spark, sf)
    m = materialize(view.affordability_metrics(**star), "metrics")
    return indicators.signals(m, star["rent"], star["income"])


@query
def driver_split(spark, sf):
    return plain(indicators.driver_split(stored_metrics(spark, sf, ["median_household_income", "monthly_rent", "rent_to_income_ratio"])))


@query
def stress_lead_time(spark, sf):
    wanted = ["annual_rent", "median_household_income", "rent_to_income_ratio"]
    star = t.star(spark, sf, view.sources_of(wanted))
    return indicators.stress_lead_time(view.affordability_metrics(**star, columns=wanted), star["rent"], star["income"])


@query
def latest_rate(spark, sf):
    return plain(profiles.latest_rate(t.rates(spark, sf)))


@query
def top_fmr(spark, sf):
    return plain(profiles.top_fmr(staged_fmr(spark, sf)))


# --- what-if -----------------------------------------------------------------------


@query
def scenario_payment(spark, sf):
    return plain(whatif.scenario_payment(metrics(spark, sf, PRICE_AND_INCOME)))


@query
def scenario_rent_burden(spark, sf):
    return plain(whatif.scenario_rent_burden(metrics(spark, sf, ["annual_rent"]), [50000, 75000, 100000]))


@query
def rate_sensitivity(spark, sf):
    return whatif.rate_sensitivity(metrics(spark, sf, ["median_home_price"]), 3.0, 0.5, 11)


@query
def relocation_savings(spark, sf):
    return plain(whatif.relocation_savings(stored_metrics(spark, sf)))
