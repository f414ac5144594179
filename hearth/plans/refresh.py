"""Full refresh: landed files -> staging -> facts -> view -> published flat table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import seeds
from hearth.operators import quality, versions
from hearth.plans import conform, dims, profiles, publish
from hearth.plans.metrics import affordability_metrics
from hearth.plans.steps import Failed, Steps
from hearth.sources import fmr, income, rates, series, wide
from hearth.sources.landing import files

# Landed file of each source below the landing folder, in order of preference.
RENT_FILES = ["rent/Metro_zori.csv", "rent/Metro_zori_*.csv"]
HOME_FILES = ["home/Metro_zhvi.csv", "home/Metro_zhvi_*.csv"]
RATE_JSON, RATE_CSV = ["rates/observations.json"], ["rates/rates.csv"]
INCOME_FILES, LABOR_FILES, CPI_FILES = "income/*.json", "labor/*/*.json", "cpi/*/*.json"
FMR_TABLE = "fmr"


@dataclass
class Landed:
    """Reads the landed files of each source; ``skipped`` collects (source, file, reason) of what could not be used."""

    spark: SparkSession
    folder: str
    load_date: date
    since: date = seeds.SINCE
    skipped: list[tuple[str, str, str]] = field(default_factory=list)

    def _at(self, names: Sequence[str]) -> list[str]:
        return [f"{self.folder}/{n}" for n in names]

    def _passed(self, source: str, found: Iterable[tuple]) -> None:
        self.skipped += [(source, str(f), reason) for f, reason in found]

    def _wide(self, source: str, names: Sequence[str]) -> DataFrame:
        passed: list = []
        try:
            return wide.read_wide(self.spark, self._at(names), passed)
        finally:
            self._passed(source, passed)

    def _windows(self, source: str, pattern: str) -> DataFrame:
        """Observations of the request windows that have landed, one folder each, in order of their names; unreadable ones are passed over."""
        folders = sorted({p.rsplit("/", 1)[0] for p in files(self.spark, f"{self.folder}/{pattern}")})
        if not folders:
            raise FileNotFoundError(f"{source}: no response has landed")
        read = [series.read_responses(self.spark, f"{f}/*.json") for f in folders]
        for r in read:
            self._passed(source, (tuple(x) for x in series.skipped_responses(r).collect()))  # one row a document that failed
        return series.union_windows(read)

    def hud_fmr(self) -> DataFrame:
        responses = self.spark.read.schema("entity_id string, requested_year int, payload string").json(f"{self.folder}/{FMR_TABLE}")
        return fmr.staged_fmr(responses, seeds.fmr_crosswalk(self.spark), self.load_date)

    def rent(self) -> DataFrame:
        return wide.staged_rent(self._wide("rent", RENT_FILES), seeds.listing_crosswalk(self.spark), self.since)

    def home_prices(self) -> DataFrame:
        return wide.staged_home(self._wide("home_prices", HOME_FILES), seeds.listing_crosswalk(self.spark), self.since)

    def income(self) -> DataFrame:
        named = {p.rsplit("/", 1)[1].removesuffix(".json"): p for p in files(self.spark, f"{self.folder}/{INCOME_FILES}")}
        surveys = income.read_years(self.spark, {int(n): p for n, p in named.items() if n.isdigit()})
        self._passed("income", (tuple(x) for x in income.skipped_years(surveys).collect()))  # one row a year that failed
        return income.staged_income(surveys, seeds.cbsa_crosswalk(self.spark))

    def labor(self) -> DataFrame:
        ids = series.series_ids(seeds.labor_areas(self.spark), seeds.LABOR_MEASURES)
        return series.staged_labor(self._windows("labor", LABOR_FILES), ids, self.since)

    def mortgage_rates(self) -> DataFrame:
        passed: list = []
        try:
            return rates.staged_rates(rates.read_rates(self.spark, self._at(RATE_JSON), self._at(RATE_CSV), self.since, passed))
        finally:
            self._passed("mortgage_rates", passed)

    def cpi(self) -> DataFrame:
        staged = series.staged_cpi(self._windows("cpi", CPI_FILES), self.load_date)
        return series.fan_out_cpi(staged, seeds.cpi_bridge(self.spark))


#: Facts that are stored by the year of their days.
BY_YEAR = {"fact_rent", "fact_home_prices", "fact_labor", "fact_mortgage_rates"}
#: The sources in the order of their loads.
SOURCES = ["hud_fmr", "rent", "home_prices", "income", "labor", "mortgage_rates", "cpi"]


def stage(spark: SparkSession, landing: str, load_date: date, since: date = seeds.SINCE) -> dict[str, DataFrame]:
    """Cleaned rows of every source. A source without any usable file raises."""
    landed = Landed(spark, landing, load_date, since)
    return {name: getattr(landed, name)() for name in SOURCES}


def facts(spark: SparkSession, staged: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """How each dimension and fact table is made. Fair-market rents are rows to merge, all others whole tables."""
    geo, calendar = dims.geography(spark), dims.date_spine(spark)
    listing = seeds.listing_crosswalk(spark)
    return {
        "dim_geography": lambda: geo,
        "dim_date": lambda: calendar,
        "dim_scenario": lambda: dims.scenarios(spark),
        "fact_rent": lambda: conform.fact_rent(staged["rent"], listing, geo),
        "fact_home_prices": lambda: conform.fact_home(staged["home_prices"], listing, geo),
        "fact_income": lambda: conform.fact_income(staged["income"], geo),
        "fact_labor": lambda: conform.fact_labor(staged["labor"], geo),
        "fact_mortgage_rates": lambda: conform.fact_rate(staged["mortgage_rates"]),
        "fact_cpi": lambda: conform.fact_cpi(staged["cpi"], geo, calendar),
        "fact_hud_fmr": lambda: conform.fact_fmr(staged["hud_fmr"]),
    }


def missing_metros(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, geo_id, city_display) of the active metros for which a source has nothing."""
    geo = tables["dim_geography"].where("is_active")
    parts = [
        quality.missing_keys(geo, tables[name], "geo_id").join(geo.select("geo_id", "city_display"), "geo_id").select(F.lit(name).alias("table_name"), "geo_id", "city_display")
        for name in ("fact_rent", "fact_home_prices", "fact_income", "fact_labor")
    ]
    return reduce(DataFrame.unionByName, parts)


def metrics_of(tables: Mapping[str, DataFrame], **options) -> DataFrame:
    return affordability_metrics(
        tables["fact_rent"], tables["fact_home_prices"], tables["fact_income"], tables["fact_labor"],
        tables["fact_mortgage_rates"], tables["dim_geography"], **options,
    )


def run(spark: SparkSession, landing: str, warehouse: str, load_date: date, **options) -> tuple[Steps, dict[str, DataFrame]]:
    """Refresh the warehouse from the landing folder, step by step.

    Each source's load, each table and each check is a step with a status and its rows. All tables are
    written to fresh folders, so that every later step reads files that survive the loss of executors; they become
    the current version together in the last step, and only if every one before it has passed.
    Returns the steps and, whatever their outcome, what was written so far.
    """
    steps, landed, draft = Steps(), Landed(spark, landing, load_date), versions.begin(spark, warehouse)
    staged: dict[str, DataFrame] = {}
    tables: dict[str, DataFrame] = {}

    def load(name: str):
        df = draft.write(f"staging/{name}", getattr(landed, name)())
        if not draft.rows[f"staging/{name}"]:
            raise ValueError(f"{name}: no rows")
        return df, draft.rows[f"staging/{name}"]

    def table(name: str, df: DataFrame):
        if name == "fact_hud_fmr":
            return draft.merge(name, df, ["entity_id", "fmr_year"], "fmr_year"), draft.rows[name]
        if name in BY_YEAR:
            return draft.write(name, conform.by_year(df), part=[conform.YEAR]), draft.rows[name]
        return draft.write(name, df), draft.rows[name]

    for name in SOURCES:
        staged[name] = steps.run(f"load {name}", lambda: load(name))
    for name, make in facts(spark, staged).items():
        tables[name] = steps.run(f"table {name}", lambda: table(name, make()))
    tables["metrics"] = steps.run("table affordability_metrics", lambda: table("affordability_metrics", metrics_of(tables, **options)))
    if steps.error is None:
        publish.run_checks(steps, publish.standard_checks(tables, tables["dim_geography"], tables["dim_date"]))
    final = lambda: publish.affordability_final(tables["metrics"], tables["fact_income"])
    tables["affordability_final"] = steps.run("table affordability_final", lambda: table("affordability_final", final()))
    steps.run("table profiles", lambda: table("profiles", profiles.of_tables({k: v for k, v in tables.items() if k.startswith("fact_")})))
    steps.run("publish", lambda: (draft.commit(), len(draft.tables)))
    out = {k: v for k, v in tables.items() if v is not None}
    counts = [(k.replace("staging/", "staging."), v) for k, v in draft.rows.items()]
    out["row_counts"] = spark.createDataFrame(counts, "table_name string, row_count bigint")
    out["skipped"] = spark.createDataFrame(landed.skipped, "source string, file string, reason string")
    out["status"] = steps.status(spark)
    return steps, out


def build_all(spark: SparkSession, landing: str, warehouse: str, load_date: date, **options) -> dict[str, DataFrame]:
    """``run``, with the new tables registered for SQL if they were published.

    A step that could not be done raises its error, as nothing was changed; a check that failed is a row of ``status``.
    """
    steps, out = run(spark, landing, warehouse, load_date, **options)
    if steps.error is not None:
        if isinstance(steps.error, Failed):
            return out
        raise steps.error
    star = {k: v for k, v in out.items() if k.startswith(("dim_", "fact_"))}
    publish.register_views(star, out["metrics"])
    return {**out, "missing_metros": missing_metros(out)}
