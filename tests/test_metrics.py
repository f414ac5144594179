"""The view, snapshot, classes and indicators on small hand-made facts."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from hearth.operators import quality
from hearth.operators import versions
from hearth.operators.upsert import quarantine
from hearth.plans import dims, indicators, publish, whatif
from hearth.plans.metrics import affordability_metrics, latest_snapshot, metrics_exact, snapshot_report

JAN, FEB, MAR = date(2020, 1, 1), date(2020, 2, 1), date(2020, 3, 1)


@pytest.fixture
def facts(spark):
    c = spark.createDataFrame
    return {
        "rent": c([(1, JAN, 2000.0, 24000.0, "All Homes"), (1, MAR, 2100.0, 25200.0, "All Homes"), (1, FEB, 1500.0, 18000.0, "1br"),
                   (2, FEB, 1000.0, 12000.0, "All Homes"), (3, MAR, 900.0, 10800.0, None), (99, MAR, 1.0, 12.0, "All Homes")],
                  "geo_id int, full_date date, monthly_rent double, annual_rent double, bedroom_type string"),
        "home": c([(1, JAN, 400000.0, "All Homes"), (1, FEB, 410000.0, "All Homes"), (1, MAR, 1.0, "Condo"), (2, JAN, 200000.0, "All Homes")],
                  "geo_id int, full_date date, median_home_price double, home_type string"),
        "income": c([(1, 2018, 70000.0, 30000.0, 5), (1, 2019, 80000.0, 31000.0, 6), (1, 2021, 90000.0, 32000.0, 7), (2, 2020, 0.0, 1.0, 1)],
                    "geo_id int, survey_year int, median_household_income double, per_capita_income double, population bigint"),
        "labor": c([(1, JAN, 4.0, 100), (1, FEB, None, 110), (2, MAR, 6.0, 50)],
                   "geo_id int, full_date date, unemployment_rate double, employment_level bigint"),
        "rates": c([(JAN, 6.0), (FEB, 7.0)], "full_date date, rate_30yr_fixed double"),
        "geography": dims.geography(spark).withColumn("is_active", F.col("geo_id") != 3),
    }


def one(df, geo, day, *cols):
    r = [tuple(x) for x in df.filter((F.col("geo_id") == geo) & (F.col("full_date") == F.lit(day))).select(*cols).collect()]
    assert len(r) == 1
    return r[0]


def test_view_fallbacks(spark, facts):
    m = affordability_metrics(**facts)
    assert m.count() == 4  # the inactive and the unknown metro are gone
    cols = ["median_home_price", "unemployment_rate", "employment_level", "rate_30yr_fixed", "median_household_income", "income_year"]
    assert one(m, 1, JAN, *cols) == (400000.0, 4.0, 100, 6.0, 90000.0, 2021)
    # March has no row anywhere: the newest row of each source, where a NULL stays NULL.
    assert one(m, 1, MAR, *cols) == (410000.0, None, 110, 7.0, 90000.0, 2021)
    assert one(m, 2, FEB, "unemployment_rate", "median_home_price", "rent_to_income_ratio", "is_cost_burdened") == (6.0, 200000.0, None, 0)


def test_view_modes(spark, facts):
    asof = affordability_metrics(**facts, income_mode="asof", fallback="asof")
    assert one(asof, 1, MAR, "income_year", "median_home_price", "rate_30yr_fixed") == (2019, 410000.0, 7.0)
    assert one(asof, 2, FEB, "unemployment_rate", "income_year") == (None, 2020)
    none = affordability_metrics(**facts, income_mode="exact", fallback="none")
    assert one(none, 1, MAR, "income_year", "median_home_price", "rate_30yr_fixed") == (None, None, None)
    with pytest.raises(ValueError):
        affordability_metrics(**facts, income_mode="guess")


def test_exact_view(spark, facts):
    m = metrics_exact(**facts)
    assert one(m, 1, JAN, "median_household_income", "unemployment_rate", "rate_30yr_fixed") == (None, 4.0, 6.0)
    assert one(m, 2, FEB, "median_household_income", "median_home_price") == (0.0, None)


def test_no_rates_leave_the_rows(spark, facts):
    m = affordability_metrics(**{**facts, "rates": facts["rates"].filter("false")})
    assert m.count() == 4 and m.filter("est_monthly_mortgage is not null").count() == 0


def test_facts_by_date_id(spark, facts):
    keyed = {k: (v.withColumn("date_id", F.date_format("full_date", "yyyyMMdd").cast("int")).drop("full_date") if "full_date" in v.columns else v) for k, v in facts.items()}
    a, b = affordability_metrics(**keyed), affordability_metrics(**facts)
    assert a.select(*b.columns).exceptAll(b).count() == 0 and a.count() == b.count()


def test_snapshot(spark, facts, rows):
    m = affordability_metrics(**facts)
    s = latest_snapshot(m)
    assert rows(s, "geo_id", "bedroom_type", "full_date") == [(1, "1br", FEB), (1, "All Homes", MAR), (2, "All Homes", FEB)]
    report = snapshot_report(m).collect()
    assert [r.city_display for r in report] == ["New York", "Los Angeles"]  # NULL burden comes last


def cities(spark, data):
    """(geo, rti, unemployment) -> one newest all-homes row per city."""
    df = spark.createDataFrame(data, "geo_id int, rent_to_income_ratio double, unemployment_rate double")
    return df.select(
        "*", F.concat(F.lit("C"), "geo_id").alias("city_display"), F.lit("XX").alias("state_abbr"), F.lit("R").alias("region"),
        F.lit(50000.0).alias("median_household_income"), F.lit("All Homes").alias("bedroom_type"), F.lit(JAN).alias("full_date"),
    )


def test_classes(spark):
    # means: 0.3 and 5.0; a value on the mean counts as low
    data = [(1, 0.3, 5.0), (2, 0.2, 7.0), (3, 0.4, 3.0), (4, 0.5, 8.0), (5, 0.1, 2.0), (6, None, 5.0), (7, 0.3, None)]
    got = {r.geo_id: r.city_classification for r in indicators.classify(cities(spark, data)).collect()}
    assert got == {
        1: "Opportunity City", 2: "Budget Risk City", 3: "Lifestyle Premium City", 4: "Pressure City", 5: "Opportunity City",
        6: "Unclassified", 7: "Unclassified",
    }
    median = indicators.classify(cities(spark, data), center="median")
    assert median.count() == 7
    assert "Pressure City" in {r.city_classification for r in median.collect()}


def test_zscore(spark):
    df = spark.createDataFrame(
        [(1, "a", "All Homes", date(2020, i + 1, 1), v) for i, v in enumerate([0.30, 0.30, 0.30, 0.30, 0.30, 0.40])]
        + [(2, "b", "All Homes", JAN, 0.3)] + [(3, "c", "All Homes", date(2020, i + 1, 1), 0.3) for i in range(5)],
        "geo_id int, city_display string, bedroom_type string, full_date date, rent_to_income_ratio double",
    )
    got = {r.geo_id: r for r in indicators.zscore(df).collect()}
    assert got[1].zscore == 2.0412 and got[1].is_unusual == 1
    assert got[2].zscore is None and got[3].zscore is None and got[3].is_unusual == 0


def test_divergence_and_lead_time(spark, rows):
    rent = spark.createDataFrame(
        [(1, date(y, 1, 1), "All Homes", v) for y, v in [(2015, 1000.0), (2016, 1100.0), (2017, 1300.0)]],
        "geo_id int, full_date date, bedroom_type string, monthly_rent double",
    )
    inc = spark.createDataFrame([(1, 2016, 50000.0), (1, 2017, 55000.0)], "geo_id int, survey_year int, median_household_income double")
    got = indicators.rent_income_divergence(rent, inc)
    assert rows(got) == [(1, 2016, 2016, 0.0, 0.0, 0.0), (1, 2017, 2016, 0.1818, 0.1, 0.0818)]
    m = spark.createDataFrame([(1, "a", "All Homes", date(2017, 3, 1), 0.29), (1, "a", "All Homes", date(2017, 5, 1), 0.31)],
                              "geo_id int, city_display string, bedroom_type string, full_date date, rent_to_income_ratio double")
    assert rows(indicators.stress_lead_time(m, rent, inc)) == [(1, "a", date(2017, 1, 1), date(2017, 5, 1), 120)]


def test_scenarios_and_relocation(spark, facts):
    m = affordability_metrics(**facts)
    paid = whatif.scenario_payment(m)
    assert paid.count() == 7 * m.count()
    first = paid.filter("geo_id = 1 and scenario_id = 1 and full_date = DATE'2020-01-01'").first()
    assert (first.scenario_payment, first.down_payment, first.scenario_income) == (2517.17, 40000.0, 90000.0)
    moved = {r.geo_id: r for r in whatif.relocation_savings(m, "Los Angeles").collect()}
    assert (moved[1].monthly_saving, moved[1].annual_saving) == (1100.0, 13200.0)
    rates = whatif.rate_sensitivity(m, 3.0, 0.5, 5).filter("geo_id = 1 and full_date = DATE'2020-01-01'").orderBy("rate").collect()
    assert [r.rate for r in rates] == [3.0, 3.5, 4.0, 4.5, 5.0] and rates[0].extra_payment == 0.0
    assert all(a.payment < b.payment for a, b in zip(rates, rates[1:]))
    pair = whatif.compare_to(m, "New York", ["Los Angeles"])
    assert pair.count() == 0  # no common month
    burden = whatif.scenario_rent_burden(m, [80000]).filter("geo_id = 1 and full_date = DATE'2020-01-01'").first()
    assert (burden.rent_burden, burden.is_cost_burdened) == (0.3, 0)


def test_merge_is_idempotent(spark, rows, tmp_path):
    old = spark.createDataFrame([("a", 2020, 1.0), ("a", 2021, 2.0)], "entity_id string, fmr_year int, v double")
    new = spark.createDataFrame([("a", 2021, 9.0), ("b", 2021, 3.0)], "entity_id string, fmr_year int, v double")
    for part in (old, new, new):
        draft = versions.begin(spark, str(tmp_path))
        table = draft.merge("t", part, ["entity_id", "fmr_year"], "fmr_year")
        draft.commit()
        assert rows(table) == rows(versions.read(spark, str(tmp_path), "t"))
    assert rows(table) == [("a", 2020, 1.0), ("a", 2021, 9.0), ("b", 2021, 3.0)]


def test_quarantine_keeps_every_row_in_one_pass(spark, tmp_path, rows):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    good, bad, counts = quarantine(df, F.col("v") > 0, str(tmp_path / "q"))
    assert rows(good) == [(1,)] and rows(bad) == [(None,), (-1,)] and counts == {"good": 1, "quarantined": 2}
    assert "PartitionFilters: [isnotnull(outcome" in good._jdf.queryExecution().executedPlan().toString()
    _, bad, counts = quarantine(df.where("v = 1"), F.col("v") > 0, str(tmp_path / "clean"))
    assert bad.count() == 0 and counts["quarantined"] == 0


def test_gate_holds_back_the_tables(spark, tmp_path, facts):
    dup = facts["income"].unionByName(facts["income"].limit(1))
    checks = {"geo": quality.orphans(facts["rent"], facts["geography"], ["geo_id"]), "unique": quality.duplicate_keys(dup, ["geo_id", "survey_year"]), "none": dup.filter("false")}
    path = str(tmp_path / "wh")
    steps = publish.publish(spark, path, {"final": facts["rent"]}, checks)
    assert versions.current(spark, path) == (0, {}) and steps.error is not None
    assert [(r.step, r.status, r.row_count) for r in steps.status(spark).orderBy("step_no").collect()] == [
        ("check: geo", "FAILED", 1), ("check: unique", "FAILED", 1), ("check: none", "PASSED", 0), ("write final", "SKIPPED", 0), ("publish", "SKIPPED", 0),
    ]
    steps = publish.publish(spark, path, {"final": facts["rent"]}, {"none": dup.filter("false")})
    assert steps.error is None and versions.read(spark, path, "final").count() == 6


def test_quality(spark, facts, rows):
    assert rows(quality.null_counts(facts["labor"], ["unemployment_rate", "employment_level"])) == [("employment_level", 0, 3), ("unemployment_rate", 1, 3)]
    assert rows(quality.missing_keys(facts["geography"].filter("geo_id <= 4"), facts["rent"], "geo_id")) == [(4,)]
    with pytest.raises(ValueError):
        quality.require_rows(facts["rent"].filter("false"), "rent")
