"""Landed files derived from the test tables, in the shapes the readers expect.

Each response document groups months of one series, or metros of one year, so
its size is bounded by the calendar or the number of metros, not by the rows
behind them: the raw tables are aggregated to months first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import materialize, scratch_path
from hearth.twin import tables as t


def text2(c) -> Column:
    """Two-decimal text, the same in every engine."""
    return F.col(c).cast("decimal(18,2)").cast("string")


def write_csv(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", True).csv(path)
    return path


def write_json(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.json(path)
    return path


def cut_off(df: DataFrame) -> DataFrame:
    """The first documents as text, each broken off in its middle."""
    text = F.to_json(F.struct(*df.columns))
    return df.select(text.alias("value")).orderBy("value").limit(3).select(F.expr("left(value, length(value) div 2)").alias("value"))


def wide(spark: SparkSession, sf: str, long: DataFrame, value: str) -> DataFrame:
    """One row per metro and one text column per month, plus one row per region (unknown metros)."""
    geo = t.geography(spark, sf).select("geo_id", "city_display", "state_abbr", "region")
    named = long.join(geo, ["geo_id"])
    names = F.array(t.listing_name(F.col("city_display"), F.col("state_abbr")), F.col("region"))
    rows = named.select(
        F.explode(names).alias("RegionName"), F.col("state_abbr").alias("State"), F.col("full_date"), text2(value).alias("v")
    )
    rows = materialize(rows, "wide_rows")
    months = [r[0].isoformat() for r in rows.select("full_date").distinct().orderBy("full_date").collect()]  # one a month
    by_month = rows.withColumn("month", F.col("full_date").cast("string")).groupBy("RegionName", "State")
    return by_month.pivot("month", months).agg(F.max("v"))


def overlapping(table: DataFrame, ids: tuple[str, ...] = ("RegionName", "State")) -> tuple[DataFrame, DataFrame]:
    """(older, newer): two wide tables with some months in both, for which the older one has outdated values."""
    months = [c for c in table.columns if c not in ids]
    first, last = len(months) // 3, 2 * len(months) // 3
    outdated = [F.when(F.col(f"`{m}`").isNotNull(), "0.01").alias(m) for m in months[first:last]]
    return table.select(*ids, *[F.col(f"`{m}`") for m in months[:first]], *outdated), table.select(*ids, *[F.col(f"`{m}`") for m in months[first:]])


def rate_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly rates as text, with one unreadable value per year."""
    weekly = t.weekly_rates(spark, sf)
    bad = weekly.select(F.trunc("report_date", "year").alias("d")).distinct().select(
        F.col("d").cast("string").alias("DATE"), F.lit(".").alias("VALUE")
    )
    return weekly.select(F.col("report_date").cast("string").alias("DATE"), F.col("rate").cast("string").alias("VALUE")).unionByName(bad)


def rate_json(spark: SparkSession, sf: str) -> DataFrame:
    """One document of monthly observations per year, each ending with a "no value" mark."""
    obs = t.rates(spark, sf).select(
        F.year("full_date").alias("y"),
        F.struct(F.col("full_date").cast("string").alias("date"), F.col("rate_30yr_fixed").cast("string").alias("value")).alias("o"),
    )
    mark = F.struct(F.concat(F.col("y").cast("string"), F.lit("-12-31")).alias("date"), F.lit(".").alias("value"))
    return obs.groupBy("y").agg(F.array_sort(F.collect_list("o")).alias("obs")).select(
        F.concat("obs", F.array(mark)).alias("observations")
    )


def income_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """(survey_year, payload): a header row and one row per metro; regions come along as unknown metros.

    The code column is titled differently before and after 1998, and per-capita
    income is coded as missing in one region.
    """
    geo = t.geography(spark, sf)
    rows = t.income(spark, sf).join(geo, ["geo_id"])
    per_capita = F.when(F.col("region") == "AFRICA", "-666666666").otherwise(F.col("per_capita_income").cast("string"))
    codes = F.array(metro_code("geo_id"), F.concat(F.lit("R-"), "region", F.lit("-"), metro_code("geo_id")))
    cells = F.array(
        F.col("metro_name"), F.col("median_household_income").cast("string"), per_capita,
        F.col("population").cast("string"), F.col("code"),
    )
    title = F.when(F.col("survey_year") < 1998, "metropolitan statistical area/micropolitan statistical area").otherwise(
        "Renamed Statistical Area"
    )
    header = F.array(F.lit("NAME"), F.lit("B19013_001E"), F.lit("B19301_001E"), F.lit("B01003_001E"), title)
    return (
        rows.withColumn("code", F.explode(codes))
        .groupBy("survey_year")
        .agg(F.array_sort(F.collect_list(cells)).alias("rows"))
        .select("survey_year", F.to_json(F.concat(F.array(header), "rows")).alias("payload"))
    )


def metro_code(c) -> Column:
    return F.lpad(F.col(c).cast("string"), 5, "0")


def code_crosswalk(geo: DataFrame) -> DataFrame:
    return geo.select(metro_code("geo_id").alias("source_key"), "city_display")


def labor_areas(geo: DataFrame) -> DataFrame:
    return geo.select(
        "city_display", F.lpad(F.col("geo_id").cast("string"), 2, "0").alias("state_fips"), metro_code("geo_id").alias("cbsa")
    )


def _response(docs: DataFrame, status: Column) -> DataFrame:
    return docs.select(
        status.alias("status"), F.array().cast("array<string>").alias("message"), F.struct("series").alias("Results")
    )


def windows(labor: DataFrame, count: int) -> list[tuple[int, int]]:
    """The years of ``labor`` in ``count`` request windows (first, last), and one behind them for which there is nothing."""
    first, last = labor.agg(F.min(F.year("full_date")), F.max(F.year("full_date"))).first()
    cuts = [first + (last + 1 - first) * i // count for i in range(count + 1)]
    return [(a, b - 1) for a, b in zip(cuts, cuts[1:], strict=False) if a < b] + [(last + 1, last + 3)]


def labor_responses(spark: SparkSession, sf: str, first: int, last: int, labor: DataFrame | None = None) -> DataFrame:
    """One answered request per city for a window of years, and a refused one with the same content.

    Every measure carries an annual average (M13), and each request asks for a
    series nobody knows.
    """
    geo = t.geography(spark, sf)
    labor = t.labor(spark, sf) if labor is None else labor
    rows = labor.filter(F.year("full_date").between(first, last)).join(geo.select("geo_id", "city_display"), ["geo_id"])
    measures = [("03", "unemployment_rate"), ("05", "employment_level"), ("06", "labor_force"), ("99", "labor_force")]
    area = F.concat(F.lit("LAUMT"), F.lpad(F.col("geo_id").cast("string"), 2, "0"), metro_code("geo_id"), F.lit("000000"))
    one = lambda code, c: F.struct(F.concat(area, F.lit(code)).alias("seriesID"), F.col(c).cast("string").alias("value"))
    obs = rows.select("geo_id", "full_date", F.inline(F.array(*[one(code, c) for code, c in measures])))
    year, month = F.date_format("full_date", "yyyy"), F.concat(F.lit("M"), F.date_format("full_date", "MM"))
    entry = F.struct(year.alias("year"), month.alias("period"), F.col("value"))
    annual = F.transform(
        F.sequence(F.lit(first), F.lit(last)),
        lambda y: F.struct(y.cast("string").alias("year"), F.lit("M13").alias("period"), F.lit("1.0").alias("value")),
    )
    per_series = obs.groupBy("geo_id", "seriesID").agg(F.array_sort(F.collect_list(entry)).alias("data"))
    docs = per_series.groupBy("geo_id").agg(
        F.array_sort(F.collect_list(F.struct("seriesID", F.concat("data", annual).alias("data")))).alias("series")
    )
    doubled = docs.select("series", F.explode(F.array(F.lit("REQUEST_SUCCEEDED"), F.lit("REQUEST_NOT_PROCESSED"))).alias("st"))
    return _response(doubled, F.col("st"))


def cpi_responses(spark: SparkSession, sf: str) -> DataFrame:
    """One answered request per series, including one series without a city."""
    known = t.cpi(spark, sf)
    lonely = known.filter(F.col("series_id") == "SERIES_US").withColumn("series_id", F.lit(t.UNKNOWN_SERIES))
    rows = known.unionByName(lonely)
    year, month = F.date_format("report_date", "yyyy"), F.concat(F.lit("M"), F.date_format("report_date", "MM"))
    entry = F.struct(year.alias("year"), month.alias("period"), F.col("cpi_index").cast("string").alias("value"))
    docs = rows.groupBy("series_id").agg(F.array_sort(F.collect_list(entry)).alias("data")).select(
        F.array(F.struct(F.col("series_id").alias("seriesID"), "data")).alias("series")
    )
    return _response(docs, F.lit("REQUEST_SUCCEEDED"))


def entity(c) -> Column:
    return F.concat(F.lit("METRO"), metro_code(c))


def fmr_responses(spark: SparkSession, sf: str) -> DataFrame:
    """(entity_id, requested_year, payload) in every shape; the region decides which.

    In 2001 one region has only zero amounts and another an unreadable payload.
    """
    rows = t.fmr(spark, sf).join(t.geography(spark, sf).select("geo_id", "city_display", "region"), ["geo_id"])
    gone = (F.col("fmr_year") == 2001) & (F.col("region") == "AMERICA")
    keys = [("Efficiency", "fmr_0br"), ("One-Bedroom", "fmr_1br"), ("Two-Bedroom", "fmr_2br"), ("Three-Bedroom", "fmr_3br"), ("Four-Bedroom", "fmr_4br")]
    amount = lambda c: F.when(gone, F.lit(0.0)).otherwise(F.col(c).cast("double"))
    amounts = [amount(c).alias(k) for k, c in keys]
    outer = [F.col("fmr_year").cast("string").alias("year"), F.col("city_display").alias("metro_name"), F.lit("1").alias("smallarea_status"), F.lit(40).alias("FMR Percentile")]
    other = [F.lit(1.0).alias(k) for k, _ in keys]
    listed = F.array(
        F.struct(F.lit("00501").alias("zip_code"), *other), F.struct(F.lit(" MSA level ").alias("zip_code"), *amounts)
    )
    first = F.array(F.struct(F.lit("00501").alias("zip_code"), *amounts), F.struct(F.lit("00502").alias("zip_code"), *other))
    as_list = F.to_json(F.struct(F.struct(*outer, listed.alias("basicdata")).alias("data")))
    as_first = F.to_json(F.struct(F.struct(*outer, first.alias("basicdata")).alias("data")))
    nested = F.struct(*outer, F.struct(*amounts).alias("basicdata"))
    as_object = F.to_json(F.struct(nested.alias("data")))
    as_root = F.to_json(F.struct(F.struct(*outer, *amounts).alias("data")))
    as_text = F.to_json(F.struct(F.to_json(nested).alias("data")))
    broken = F.to_json(F.struct(F.lit("{not json").alias("data")))
    payload = (
        F.when(F.col("region") == "AFRICA", as_list)
        .when(F.col("region") == "AMERICA", as_object)
        .when(F.col("region") == "ASIA", as_root)
        .when((F.col("region") == "EUROPE") & (F.col("fmr_year") == 2001), broken)
        .when(F.col("region") == "EUROPE", as_text)
        .otherwise(as_first)
    )
    return rows.select(entity("geo_id").alias("entity_id"), F.col("fmr_year").alias("requested_year"), payload.alias("payload"))


def fmr_crosswalk(geo: DataFrame) -> DataFrame:
    return geo.select(entity("geo_id").alias("entity_id"), F.col("city_display").alias("city"))


def dirty_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """(o_orderpriority, o_orderstatus, raw): order values as text, spoiled in ways that depend on the row's codes."""
    o = t.read(spark, sf, "orders")
    good = text2("o_totalprice")
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    raw = (
        F.when(p == "1-URGENT", F.concat(good, F.lit("371")))
        .when(p == "2-HIGH", F.concat(F.lit("-"), good))
        .when((p == "3-MEDIUM") & (s == "F"), "NaN")
        .when((p == "3-MEDIUM") & (s == "O"), "inf")
        .when((p == "3-MEDIUM") & (s == "P"), "")
        .when((p == "4-NOT SPECIFIED") & (s == "F"), "n/a")
        .when((p == "4-NOT SPECIFIED") & (s == "O"), "0")
        .otherwise(good)
    )
    return o.select("o_orderkey", "o_orderpriority", "o_orderstatus", raw.alias("raw"))
