"""A star derived from the TPC-H-like test tables.

Nations stand for metros, regions for price areas; order months give rents,
shipments give prices, labor and rates, each for every month that the tables have.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.functions import dates, stats
from hearth.functions.numeric import half_up
from hearth.seeds import ALL_HOMES, NATIONAL_CITY
from hearth.session import materialize_all

NATION_KEYS = [f"NATION_{i} Metro" for i in range(25)]
UNKNOWN_SERIES = "SERIES_X"


_SCHEMAS: dict[str, T.StructType] = {}


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files once per process."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def span(spark: SparkSession, sf: str) -> tuple[date, date]:
    """First day of the first and last day of the last year in which something was ordered or shipped."""
    days = [read(spark, sf, n).agg(F.min(c).cast("date"), F.max(c).cast("date")).first() for n, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))]
    seen = [d for r in days for d in r if d is not None] or [date(2000, 1, 1)]
    return date(min(seen).year, 1, 1), date(max(seen).year, 12, 31)


def mean(total: str = "s", count: str = "n") -> Column:
    return F.col(total).cast("double") / F.col(count)


def geography(spark: SparkSession, sf: str) -> DataFrame:
    n, r = read(spark, sf, "nation"), read(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("geo_id"),
        F.concat("n_name", F.lit(" Metro, "), "r_name").alias("metro_name"),
        F.col("n_name").alias("city_display"),
        F.upper(F.substring("r_name", 1, 2)).alias("state_abbr"),
        F.col("r_name").alias("region"),
        F.lit(None).cast("decimal(9,6)").alias("latitude"),
        F.lit(None).cast("decimal(9,6)").alias("longitude"),
        F.lit(True).alias("is_active"),
    )


def listing(geo: DataFrame) -> DataFrame:
    """Crosswalk from the names used in wide files to cities."""
    return geo.select(listing_name(F.col("city_display"), F.col("state_abbr")).alias("source_key"), "city_display")


def listing_name(city: Column, state: Column) -> Column:
    return F.concat(city, F.lit(", "), state)


def order_sums(spark: SparkSession, sf: str) -> DataFrame:
    """(geo_id, full_date, urgent, s, n): order values per customer nation and month."""
    o = read(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy(
            F.col("c_nationkey").alias("geo_id"),
            dates.month_of("o_orderdate").alias("full_date"),
            (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        )
        .agg(stats.exact_sum("o_totalprice").alias("s"), F.count("*").alias("n"))
    )


def rent(spark: SparkSession, sf: str, sums: DataFrame | None = None) -> DataFrame:
    """Monthly rents: all homes, and one-bedroom rents from the urgent orders."""
    sums = order_sums(spark, sf) if sums is None else sums
    kinds = F.when(F.col("urgent"), F.array(F.lit(ALL_HOMES), F.lit("1br"))).otherwise(F.array(F.lit(ALL_HOMES)))
    rows = (
        sums.withColumn("bedroom_type", F.explode(kinds))
        .groupBy("geo_id", "full_date", "bedroom_type")
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    )
    value = half_up(mean() / 130, 2).cast("decimal(10,2)")
    return rows.select("geo_id", "full_date", value.alias("monthly_rent"), (value * 12).alias("annual_rent"), "bedroom_type")


def income(spark: SparkSession, sf: str, sums: DataFrame | None = None) -> DataFrame:
    sums = order_sums(spark, sf) if sums is None else sums
    rows = (
        sums.groupBy("geo_id", F.year("full_date").alias("survey_year"))
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    )
    return rows.select(
        "geo_id", "survey_year",
        half_up(mean() * 0.3, 2).cast("decimal(12,2)").alias("median_household_income"),
        half_up(mean() * 0.12, 2).cast("decimal(12,2)").alias("per_capita_income"),
        (F.col("n") * 1000).alias("population"),
    )


def line_sums(spark: SparkSession, sf: str) -> DataFrame:
    """(geo_id, full_date, price, discount, tax, n) per supplier nation and ship month.

    Lines are summed by supplier and month before they meet their supplier, so partial sums are shuffled
    and not lines. Lines without a known supplier stay, under a NULL nation: the national rate
    counts them too. Prices, rates, consumer prices and fair-market rents all
    follow from this one pass over the lines.
    """
    line = read(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax")
    s = read(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("geo_id"))
    own = line.groupBy("l_suppkey", dates.month_of("l_shipdate").alias("full_date")).agg(
        stats.exact_sum("l_extendedprice").alias("price"), stats.exact_sum("l_discount").alias("discount"),
        stats.exact_sum("l_tax").alias("tax"), F.count("*").alias("n"),
    )
    placed = own.join(s, own.l_suppkey == s.s_suppkey, "left")
    return placed.groupBy("geo_id", "full_date").agg(*[F.sum(c).alias(c) for c in ("price", "discount", "tax", "n")])


def home(spark: SparkSession, sf: str, sums: DataFrame | None = None) -> DataFrame:
    if sums is None:
        sums = line_sums(spark, sf)
    rows = sums.filter(F.col("geo_id").isNotNull())
    return rows.select(
        "geo_id", "full_date", half_up(mean("price") * 8, 2).cast("decimal(12,2)").alias("median_home_price"),
        F.lit(ALL_HOMES).alias("home_type"),
    )


def labor(spark: SparkSession, sf: str) -> DataFrame:
    """Returned lines per customer nation and month.

    Orders meet customers first, so the lines are shuffled only once.
    """
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("geo_id"))
    placed = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "geo_id")
    line = read(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag")
    sums = (
        line.join(placed, line.l_orderkey == placed.o_orderkey)
        .groupBy("geo_id", dates.month_of("l_shipdate").alias("full_date"))
        .agg(F.count_if(F.col("l_returnflag") == "R").alias("r"), F.count("*").alias("n"))
    )
    return sums.select(
        "geo_id", "full_date",
        half_up((F.col("r") * 100).cast("double") / F.col("n") / 6, 2).cast("decimal(5,2)").alias("unemployment_rate"),
        (F.col("n") * 1000).alias("employment_level"),
        (F.col("n") * 1060).alias("labor_force"),
    )


def rates(spark: SparkSession, sf: str, sums: DataFrame | None = None) -> DataFrame:
    """National monthly rate; from the lines alone when no sums are at hand."""
    if sums is None:
        line = read(spark, sf, "lineitem").select("l_shipdate", "l_discount")
        sums = line.groupBy(dates.month_of("l_shipdate").alias("full_date")).agg(
            stats.exact_sum("l_discount").alias("discount"), F.count("*").alias("n")
        )
    else:
        sums = sums.groupBy("full_date").agg(F.sum("discount").alias("discount"), F.sum("n").alias("n"))
    return sums.select("full_date", half_up(mean("discount") * 130, 4).cast("decimal(6,4)").alias("rate_30yr_fixed"))


def weekly_rates(spark: SparkSession, sf: str) -> DataFrame:
    line = read(spark, sf, "lineitem").select("l_shipdate", "l_discount")
    week = F.date_trunc("week", F.col("l_shipdate").cast("date")).cast("date")
    sums = line.groupBy(week.alias("report_date")).agg(stats.exact_sum("l_discount").alias("s"), F.count("*").alias("n"))
    return sums.select("report_date", half_up(mean() * 130, 2).cast("decimal(6,2)").alias("rate"))


def cpi(spark: SparkSession, sf: str) -> DataFrame:
    """(series_id, report_date, cpi_index) per region and month, and one national series."""
    n = read(spark, sf, "nation").select(F.col("n_nationkey").alias("geo_id"), "n_regionkey")
    sums = line_sums(spark, sf).filter(F.col("geo_id").isNotNull()).join(n, ["geo_id"])
    series = F.array(F.concat(F.lit("SERIES_"), F.col("n_regionkey").cast("string")), F.lit("SERIES_US"))
    return (
        sums.withColumn("series_id", F.explode(series))
        .groupBy("series_id", F.col("full_date").alias("report_date"))
        .agg(F.sum("tax").alias("s"), F.sum("n").alias("n"))
        .select("series_id", "report_date", half_up(mean() * 100 + 250, 4).cast("decimal(10,4)").alias("cpi_index"))
    )


def cpi_bridge(spark: SparkSession, sf: str) -> DataFrame:
    """One region's series serves every nation of the region."""
    cities = read(spark, sf, "nation").select(
        F.concat(F.lit("SERIES_"), F.col("n_regionkey").cast("string")).alias("series_id"), F.col("n_name").alias("city_display")
    )
    national = spark.createDataFrame([("SERIES_US", NATIONAL_CITY)], "series_id string, city_display string")
    return cities.unionByName(national)


def fmr(spark: SparkSession, sf: str) -> DataFrame:
    """(geo_id, fmr_year, fmr_0br..fmr_4br) from the mean line value of each nation and year."""
    sums = (
        line_sums(spark, sf).filter(F.col("geo_id").isNotNull())
        .groupBy("geo_id", F.year("full_date").alias("fmr_year"))
        .agg(F.sum("price").alias("s"), F.sum("n").alias("n"))
    )
    factors = [("fmr_0br", 0.75), ("fmr_1br", 0.85), ("fmr_2br", 1.0), ("fmr_3br", 1.25), ("fmr_4br", 1.4)]
    return sums.select(
        "geo_id", "fmr_year", *[half_up(mean() / 40 * f, 2).cast("decimal(10,2)").alias(name) for name, f in factors]
    )


FACTS = ("rent", "income", "home", "rates", "labor")


def star(spark: SparkSession, sf: str, wanted: Iterable[str] = FACTS) -> dict[str, DataFrame | None]:
    """The facts behind the affordability view; those that are not wanted are None.

    The raw tables are read once each for the order sums, the line sums and the
    labor counts; these small results are written, so that the view, which needs
    most facts twice, never goes back to the raw tables.
    """
    wanted = {"rent", *wanted}
    behind = {"order_sums": ({"rent", "income"}, order_sums), "line_sums": ({"home", "rates"}, line_sums), "labor": ({"labor"}, labor)}
    sums = materialize_all({name: make(spark, sf) for name, (facts, make) in behind.items() if facts & wanted})
    made = {
        "rent": lambda: rent(spark, sf, sums["order_sums"]), "income": lambda: income(spark, sf, sums["order_sums"]),
        "home": lambda: home(spark, sf, sums["line_sums"]), "rates": lambda: rates(spark, sf, sums["line_sums"]), "labor": lambda: sums["labor"],
    }
    return {name: make() if name in wanted else None for name, make in made.items()} | {"geography": geography(spark, sf)}
