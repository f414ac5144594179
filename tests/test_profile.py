"""Profiles against plain Python, and merged from parts."""

from datetime import date

from pyspark.sql import functions as F

from hearth.operators.profile import columns_profile, estimated, merged, newest_row, profile
from hearth.plans import profiles

ROWS = [("a", 1, 2.0, date(2020, 1, 1)), ("a", 2, None, date(2020, 3, 1)), ("a", 2, 5.0, date(2020, 2, 1)), ("b", 3, 1.25, date(2019, 1, 1)), (None, None, None, None)]
SCHEMA = "city_display string, k int, v double, d date"


def test_one_aggregate_with_every_kind_of_measure(spark, rows):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = profile(
        df, ["city_display"], span="d", mean={"avg": ("v", 2, 2)}, least={"low": "v"}, most={"high": "v"}, newest={"last": ("v", "d")},
        nulls={"gone": "v"}, holding={"large": F.col("v") > 1.5}, distinct={"ks": "k"},
    )
    assert rows(got) == [
        (None, 1, None, None, None, None, None, None, 1, 0, 0), ("a", 3, date(2020, 1, 1), date(2020, 3, 1), 3.5, 2.0, 5.0, None, 1, 2, 2),
        ("b", 1, date(2019, 1, 1), date(2019, 1, 1), 1.25, 1.25, 1.25, 1.25, 0, 0, 1),
    ]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1  # one pass
    assert profile(df.limit(0), rows="n").collect()[0].n == 0 and newest_row(df.limit(0), "d").count() == 0
    assert newest_row(df, "d").first().d == date(2020, 3, 1)


def test_profiles_of_parts_merge(spark):
    df = spark.range(20000).selectExpr("id % 3 AS g", "id % 7001 AS k", "id AS v", "CAST(NULL AS int) AS e")
    of = lambda part: profile(part, ["g"], least={"low": "v"}, most={"high": "v"}, sketches={"ks": "k"})
    parts = of(df.where("v < 9000")).unionByName(of(df.where("v >= 5000 AND v >= 9000")))
    both = estimated(merged(parts, ["g"], least=["low"], most=["high"], sketches=["ks"]), "ks").orderBy("g").collect()
    whole = profile(df, ["g"], least={"low": "v"}, most={"high": "v"}, distinct={"ks": "k"}).orderBy("g").collect()
    for m, w in zip(both, whole, strict=True):
        assert (m.g, m.row_count, m.low, m.high) == (w.g, w.row_count, w.low, w.high)
        assert abs(m.ks - w.ks) < 0.04 * w.ks  # several deviations of the sketch
    columns = {r.column_name: r for r in estimated(columns_profile(df), "values").collect()}
    assert columns["e"].null_count == columns["e"].row_count == 20000 and columns["e"]["values"] == 0
    assert (columns["v"].least, columns["v"].most) == ("0", "19999") and abs(columns["k"]["values"] - 7001) < 300


def test_reports_keep_to_their_tables(spark, rows):
    rates = spark.createDataFrame([(date(2020, 1, 1), 3.5), (date(2020, 2, 1), 3.25)], "full_date date, rate_30yr_fixed double")
    assert rows(profiles.latest_rate(rates)) == [(date(2020, 2, 1), 3.25)]
    assert rows(profiles.rate(rates)) == [(2, date(2020, 1, 1), date(2020, 2, 1), 3.375, 3.25, 3.5)]
    tables = profiles.of_tables({"a": rates, "b": rates.limit(0)})
    assert sorted((r.table_name, r.column_name, r.row_count) for r in tables.collect()) == [
        ("a", "full_date", 2), ("a", "rate_30yr_fixed", 2), ("b", "full_date", 0), ("b", "rate_30yr_fixed", 0),
    ]
