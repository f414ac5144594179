"""Worked cases and edge cases of the formulas."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hearth.functions import clean, dates, finance, stats
from hearth.functions.numeric import half_up
from hearth.plans.metrics import add_metrics

GOLDEN = [
    # price, rate, income, rent, unemployment, payment, RTI, MTI, P/I, affordable, gap, down, years, score
    (400000, 6.5, 80000, 2000, 4.0, 2022.62, 0.3, 0.3034, 5.00, 2000.00, 0.00, 80000, 10.00, 99.34),
    (950000, 6.8, 92000, 2900, 5.5, 4954.63, 0.3783, 0.6463, 10.33, 2300.00, 600.00, 190000, 20.65, 164.77),
    (260000, 6.8, 78000, 1350, 3.6, 1356.00, 0.2077, 0.2086, 3.33, 1950.00, -600.00, 52000, 6.67, 71.89),
]


def view_row(spark, price, rate, income, rent, unemployment):
    df = spark.createDataFrame(
        [(price, rate, income, rent, None if rent is None else rent * 12, unemployment)],
        "median_home_price double, rate_30yr_fixed double, median_household_income double, monthly_rent double, "
        "annual_rent double, unemployment_rate double",
    )
    df = add_metrics(df)
    return df.select(
        "*",
        finance.years_to_save("down_payment_required", "median_household_income").alias("years"),
        finance.pressure_score("rent_to_income_ratio", "mortgage_to_income_ratio", "unemployment_rate").alias("score"),
    ).first()


@pytest.mark.parametrize("case", GOLDEN)
def test_golden(spark, case):
    price, rate, income, rent, unemp, *want = map(float, case)
    r = view_row(spark, price, rate, income, rent, unemp)
    got = [
        r.est_monthly_mortgage, r.rent_to_income_ratio, r.mortgage_to_income_ratio, r.home_price_to_income_ratio,
        r.affordable_monthly_rent, r.monthly_rent_gap, r.down_payment_required, r.years, r.score,
    ]
    assert got == pytest.approx(want, abs=1e-9)


def test_burden_at_the_limit_is_not_over_it(spark):
    r = view_row(spark, 400000.0, 6.5, 80000.0, 2000.0, 4.0)
    assert (r.rent_to_income_ratio, r.is_cost_burdened, r.is_severely_burdened) == (0.3, 0, 0)
    assert view_row(spark, 400000.0, 6.5, 80000.0, 2000.01, 4.0).is_cost_burdened == 1
    assert view_row(spark, 400000.0, 6.5, 40000.0, 2000.0, 4.0).is_severely_burdened == 1


@pytest.mark.parametrize("income", [None, 0.0])
def test_no_income(spark, income):
    r = view_row(spark, 400000.0, 6.5, income, 2000.0, 4.0)
    assert r.rent_to_income_ratio is None and r.mortgage_to_income_ratio is None and r.home_price_to_income_ratio is None
    assert (r.is_cost_burdened, r.is_severely_burdened) == (0, 0)
    assert r.years is None and r.score is None
    assert r.est_monthly_mortgage == 2022.62


@pytest.mark.parametrize("price,rate", [(None, 6.5), (400000.0, None), (0.0, 6.5), (400000.0, 0.0), (-1.0, 6.5)])
def test_no_payment(spark, price, rate):
    r = view_row(spark, price, rate, 80000.0, 2000.0, 4.0)
    assert r.est_monthly_mortgage is None and r.mortgage_to_income_ratio is None


def test_score_is_100_on_all_limits(spark):
    assert spark.range(1).select(finance.pressure_score(F.lit(0.30), F.lit(0.28), F.lit(5.0))).first()[0] == 100.0


def test_payment_of_scenarios_and_monotone_in_rate(spark):
    pay = lambda d, r: finance.monthly_payment(F.lit(400000.0), F.lit(r), d)
    assert spark.range(1).select(pay(0.10, 7.5), pay(0.20, 6.0)).first()[:] == (2517.17, 1918.56)
    grid = spark.range(1, 200).select(finance.monthly_payment(F.lit(400000.0), F.col("id") / 10).alias("p"), "id").orderBy("id")
    p = [r.p for r in grid.collect()]
    assert p == sorted(p) and len(set(p)) == len(p)


def test_growth(spark):
    got = spark.sql("SELECT * FROM VALUES (110.0D, 100.0D), (110.0D, 0.0D), (110.0D, NULL) AS t(a, b)")
    assert [r[0] for r in got.select(finance.growth("a", "b")).collect()] == [0.1, None, None]


def test_clean_text(spark):
    texts = ["1.239", "-1.5", "NaN", "inf", "-Infinity", "", "abc", None, "0", "1e400", "12.999", "99999999999999999999"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = {
        name: [r[0] for r in df.orderBy("i").select(fn("x")).collect()]
        for name, fn in [("money", clean.money), ("survey", clean.survey_amount), ("int", clean.integer), ("heads", clean.head_count)]
    }
    nothing = [None] * 6
    assert got["money"] == [1.24, -1.5, *nothing, 0.0, None, 13.0, 1e20]
    assert got["survey"] == [1.24, None, *nothing, 0.0, None, 13.0, 1e20]
    assert got["int"] == [1, -1, *nothing, 0, None, 12, None]
    assert got["heads"] == [1, None, *nothing, None, None, 12, None]


def test_dates(spark):
    df = spark.sql("SELECT DATE'2020-12-31' AS d, '2020' AS y, 'M03' AS p, 'M13' AS q, 'Q01' AS r, 'abcd' AS bad")
    row = df.select(
        dates.date_id("d"), dates.from_date_id(dates.date_id("d")), dates.period_date("y", "p"), dates.period_date("y", "q"),
        dates.period_date("y", "r"), dates.period_date("bad", "p"), dates.month_index("d"), dates.calendar_columns("d")["is_year_end"],
    ).first()
    assert row[0] == 20201231 and str(row[1]) == "2020-12-31" and str(row[2]) == "2020-03-01"
    assert row[3] is None and row[4] is None and row[5] is None
    assert row[6] == 2020 * 12 + 12 and row[7] is True


def test_half_up_on_ties(spark):
    df = spark.sql("SELECT * FROM VALUES (1.005D), (2.675D), (-1.005D), (0.18584999999999998D) AS t(x)")
    assert [r[0] for r in df.select(half_up("x", 2)).collect()] == [1.01, 2.68, -1.01, 0.19]
    assert df.select(half_up("x", 4)).collect()[3][0] == 0.1859


def test_exact_sum_matches_decimal_sum(spark):
    df = spark.range(20000).select(F.round(F.rand(7) * 2e7 - 1e7, 2).alias("x"))
    a, b, n, m = df.agg(
        stats.exact_sum("x"), F.sum(F.col("x").cast("decimal(18,2)")), F.count("x"), stats.exact_mean("x")
    ).first()
    assert a == b and m == float(b) / n
    empty = df.filter("x is null").agg(stats.exact_sum("x"), stats.exact_mean("x")).first()
    assert tuple(empty) == (None, None)


def test_burden_flag_on_the_limit(spark):
    """Rents at exactly 30 % of income are not above the limit, one cent more is."""
    incomes = spark.range(10000, 40000, 10).select(F.col("id").cast("decimal(12,2)").alias("income"))
    rents = incomes.withColumn("rent", (F.col("income") * Decimal("0.30")).cast("decimal(12,2)"))
    flags = rents.select(finance.over("rent", "income", 0.30).alias("at"), finance.over(F.col("rent") + Decimal("0.01"), "income", 0.30).alias("above"))
    r = flags.agg(F.sum("at"), F.min("above")).first()
    assert tuple(r) == (0, 1)
    odd = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, -1.0), (-1.0, -10.0)], "n double, d double")
    assert {x[0] for x in odd.select(finance.over("n", "d", 0.3)).collect()} == {0}
