"""The registered queries once more, as plain SQL for DuckDB, written from the definitions."""

from __future__ import annotations

import re

from hearth import seeds

# Shared sub-queries. Each statement takes in those it names.
CTES = {
    "span": """
        SELECT make_date(CAST(MIN(YEAR(d)) AS BIGINT), 1, 1) AS first_day, make_date(CAST(MAX(YEAR(d)) AS BIGINT), 12, 31) AS last_day
        FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)""",
    "geo": """
        SELECT n_nationkey AS geo_id, n_name AS city_display, n_name || ' Metro, ' || r_name AS metro_name,
               UPPER(SUBSTR(r_name, 1, 2)) AS state_abbr, r_name AS region,
               n_name || ', ' || UPPER(SUBSTR(r_name, 1, 2)) AS listing
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "ob": """
        SELECT c_nationkey AS geo_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS full_date,
               o_orderpriority AS p, CAST(o_totalprice AS DECIMAL(18,2)) AS v
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "rent": """
        SELECT geo_id, full_date, 'All Homes' AS bedroom_type, ROUND(CAST(SUM(v) AS DOUBLE) / COUNT(*) / 130, 2) AS monthly_rent
        FROM ob GROUP BY geo_id, full_date
        UNION ALL
        SELECT geo_id, full_date, '1br', ROUND(CAST(SUM(v) AS DOUBLE) / COUNT(*) / 130, 2)
        FROM ob WHERE p = '1-URGENT' GROUP BY geo_id, full_date""",
    "income": """
        SELECT geo_id, CAST(YEAR(full_date) AS INT) AS survey_year,
               ROUND(CAST(SUM(v) AS DOUBLE) / COUNT(*) * 0.3, 2) AS median_household_income,
               ROUND(CAST(SUM(v) AS DOUBLE) / COUNT(*) * 0.12, 2) AS per_capita_income,
               COUNT(*) * 1000 AS population
        FROM ob GROUP BY 1, 2""",
    "home": """
        SELECT s_nationkey AS geo_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS full_date,
               ROUND(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) * 8, 2) AS median_home_price
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""",
    "labor": """
        SELECT c_nationkey AS geo_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS full_date,
               ROUND(CAST(100 * SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) / 6, 2) AS unemployment_rate,
               COUNT(*) * 1000 AS employment_level, COUNT(*) * 1060 AS labor_force
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        GROUP BY 1, 2""",
    "rates": """
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS full_date,
               ROUND(CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) * 130, 4) AS rate_30yr_fixed
        FROM lineitem GROUP BY 1""",
    "weekly": """
        SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS report_date,
               ROUND(CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) * 130, 2) AS rate_30yr_fixed
        FROM lineitem GROUP BY 1""",
    "taxed": """
        SELECT n_regionkey AS rk, CAST(date_trunc('month', l_shipdate) AS DATE) AS report_date, CAST(l_tax AS DECIMAL(18,2)) AS v
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "cpi": """
        SELECT 'SERIES_' || CAST(rk AS VARCHAR) AS series_id, report_date,
               ROUND(250 + CAST(SUM(v) AS DOUBLE) / COUNT(*) * 100, 4) AS cpi_index FROM taxed GROUP BY rk, report_date
        UNION ALL
        SELECT 'SERIES_US', report_date, ROUND(250 + CAST(SUM(v) AS DOUBLE) / COUNT(*) * 100, 4) FROM taxed GROUP BY report_date""",
    "bridge": """
        SELECT 'SERIES_' || CAST(n_regionkey AS VARCHAR) AS series_id, n_name AS city_display FROM nation
        UNION ALL SELECT 'SERIES_US', 'United States'""",
    "cpi_city": "SELECT c.series_id, c.report_date, c.cpi_index, b.city_display FROM cpi c JOIN bridge b ON b.series_id = c.series_id",
    "fmr_base": """
        SELECT s_nationkey AS geo_id, CAST(YEAR(l_shipdate) AS INT) AS fmr_year,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) / 40 AS x
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""",
    "fmr": """
        SELECT 'METRO' || LPAD(CAST(f.geo_id AS VARCHAR), 5, '0') AS entity_id, g.city_display AS city, g.metro_name, g.region, fmr_year,
               ROUND(x * 0.75, 2) AS fmr_0br, ROUND(x * 0.85, 2) AS fmr_1br, ROUND(x * 1.0, 2) AS fmr_2br,
               ROUND(x * 1.25, 2) AS fmr_3br, ROUND(x * 1.4, 2) AS fmr_4br
        FROM fmr_base f JOIN geo g ON g.geo_id = f.geo_id""",
    "fmr_read": """
        SELECT entity_id, city, fmr_year, fmr_0br, fmr_1br, fmr_2br, fmr_3br, fmr_4br FROM fmr
        WHERE NOT (fmr_year = 2001 AND region IN ('AMERICA', 'EUROPE'))""",
    "newest_income": "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY geo_id ORDER BY survey_year DESC) AS rn FROM income) WHERE rn = 1",
    "newest_labor": "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY geo_id ORDER BY full_date DESC) AS rn FROM labor) WHERE rn = 1",
    "newest_home": "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY geo_id ORDER BY full_date DESC) AS rn FROM home) WHERE rn = 1",
    "newest_rate": "SELECT rate_30yr_fixed FROM rates ORDER BY full_date DESC LIMIT 1",
    "spine": """
        SELECT g.geo_id, g.city_display, g.metro_name, g.state_abbr, g.region, r.full_date, CAST(YEAR(r.full_date) AS INT) AS year,
               CAST(QUARTER(r.full_date) AS INT) AS quarter, CAST(MONTH(r.full_date) AS INT) AS month, monthname(r.full_date) AS month_name,
               r.monthly_rent, ROUND(r.monthly_rent * 12, 2) AS annual_rent, r.bedroom_type
        FROM rent r JOIN geo g ON g.geo_id = r.geo_id""",
    "joined": """
        SELECT s.*, i.median_household_income, i.per_capita_income, i.population, i.survey_year AS income_year,
               COALESCE(l.unemployment_rate, nl.unemployment_rate) AS unemployment_rate,
               COALESCE(l.employment_level, nl.employment_level) AS employment_level,
               COALESCE(h.median_home_price, nh.median_home_price) AS median_home_price,
               COALESCE(q.rate_30yr_fixed, (SELECT rate_30yr_fixed FROM newest_rate)) AS rate_30yr_fixed
        FROM spine s
        LEFT JOIN newest_income i ON i.geo_id = s.geo_id
        LEFT JOIN labor l ON l.geo_id = s.geo_id AND l.full_date = s.full_date
        LEFT JOIN newest_labor nl ON nl.geo_id = s.geo_id
        LEFT JOIN home h ON h.geo_id = s.geo_id AND h.full_date = s.full_date
        LEFT JOIN newest_home nh ON nh.geo_id = s.geo_id
        LEFT JOIN rates q ON q.full_date = s.full_date""",
    "exact": """
        SELECT s.*, i.median_household_income, i.per_capita_income, i.population,
               l.unemployment_rate, l.employment_level, h.median_home_price, q.rate_30yr_fixed
        FROM spine s
        LEFT JOIN income i ON i.geo_id = s.geo_id AND i.survey_year = s.year
        LEFT JOIN labor l ON l.geo_id = s.geo_id AND l.full_date = s.full_date
        LEFT JOIN home h ON h.geo_id = s.geo_id AND h.full_date = s.full_date
        LEFT JOIN rates q ON q.full_date = s.full_date""",
}

# A loan is the present value of its payments: principal = payment * (1 - v^n) / i, with i the rate a month and v = 1 / (1 + i).
PAY = "({price} * (1 - {down})) * ({rate} / 1200.0) / (1 - POWER(1 + {rate} / 1200.0, -{n}))"
VIEW_PAY = PAY.format(price="median_home_price", down="0.2", rate="rate_30yr_fixed", n="360")
# The measures share three terms: a positive income (pos), the payment (pay), and an income's affordable rent a month (can).
_POS = "NULLIF(GREATEST(median_household_income, 0), 0)"
_PAY = f"CASE WHEN LEAST(rate_30yr_fixed, median_home_price) > 0 THEN {VIEW_PAY} END"
_CAN = "(median_household_income * 0.30 / 12)"


def _over(share: str) -> str:
    """1 if the year's rent is more than this share of the income, compared as decimals; 0 also without an income."""
    return f"CAST(COALESCE(CAST(annual_rent AS DECIMAL(28,6)) > CAST({_POS} AS DECIMAL(28,6)) * {share}, FALSE) AS INT)"


MEASURES = {
    "down_payment_required": "ROUND(median_home_price * 0.20, 2)", "est_monthly_mortgage": f"ROUND({_PAY}, 2)",
    "mortgage_to_income_ratio": f"ROUND({_PAY} * 12 / {_POS}, 4)", "home_price_to_income_ratio": f"ROUND(median_home_price / {_POS}, 2)",
    "rent_to_income_ratio": f"ROUND(annual_rent / {_POS}, 4)", "affordable_monthly_rent": f"ROUND({_CAN}, 2)",
    "monthly_rent_gap": f"ROUND(monthly_rent - {_CAN}, 2)", "is_cost_burdened": _over("0.30"), "is_severely_burdened": _over("0.50"),
}
FORMULAS = ", ".join(f"{v} AS {k}" for k, v in MEASURES.items())
CTES["m"] = f"SELECT *, {FORMULAS} FROM joined"
CTES["mx"] = f"SELECT *, {FORMULAS} FROM exact"
CTES["mp"] = """
    SELECT *, ROUND(rent_to_income_ratio / 0.30 * 40 + mortgage_to_income_ratio / 0.28 * 40 + unemployment_rate / 5.0 * 20, 2) AS pressure_score
    FROM m"""
CTES["newest"] = """
    SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY geo_id ORDER BY full_date DESC) AS rn
                   FROM mp WHERE bedroom_type = 'All Homes') WHERE rn = 1"""
CTES["middle"] = """
    SELECT CAST(SUM(CAST(rent_to_income_ratio AS DECIMAL(18,4))) AS DOUBLE) / COUNT(rent_to_income_ratio) AS rti,
           CAST(SUM(CAST(unemployment_rate AS DECIMAL(18,2))) AS DOUBLE) / COUNT(unemployment_rate) AS unemp,
           MEDIAN(rent_to_income_ratio) AS rti50, MEDIAN(unemployment_rate) AS unemp50,
           CAST(SUM(CAST(median_household_income AS DECIMAL(18,2))) AS DOUBLE) / COUNT(median_household_income) AS income,
           CAST(SUM(CAST(monthly_rent AS DECIMAL(18,2))) AS DOUBLE) / COUNT(monthly_rent) AS rent
    FROM newest"""
# Two yes-or-no answers number the four classes; without one of them there is none.
CLASS = """
    COALESCE((['Opportunity City', 'Lifestyle Premium City', 'Budget Risk City', 'Pressure City'])
             [1 + CAST(rent_to_income_ratio > {r} AS INT) + 2 * CAST(unemployment_rate > {u} AS INT)], 'Unclassified') AS city_classification"""
CTES["classes"] = f"SELECT newest.*, {CLASS.format(r='c.rti', u='c.unemp')} FROM newest CROSS JOIN middle c"
CTES["rent_y"] = """
    SELECT geo_id, CAST(YEAR(full_date) AS INT) AS year, CAST(SUM(CAST(monthly_rent AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS rent
    FROM rent WHERE bedroom_type = 'All Homes' GROUP BY 1, 2"""
CTES["both_y"] = """
    SELECT r.geo_id, r.year, r.rent, i.median_household_income AS income
    FROM rent_y r JOIN income i ON i.geo_id = r.geo_id AND i.survey_year = r.year"""
CTES["base_y"] = "SELECT geo_id, MIN(year) AS base_year FROM both_y GROUP BY geo_id"
CTES["growth_y"] = """
    SELECT b.geo_id, b.year, y.base_year, ROUND((b.rent - z.rent) / z.rent, 4) AS rent_growth,
           ROUND((b.income - z.income) / z.income, 4) AS income_growth
    FROM both_y b JOIN base_y y ON y.geo_id = b.geo_id JOIN both_y z ON z.geo_id = b.geo_id AND z.year = y.base_year"""
CTES["divergence"] = "SELECT *, ROUND(rent_growth - income_growth, 4) AS divergence FROM growth_y"
CTES["dirty"] = """
    SELECT o_orderkey, o_orderpriority, o_orderstatus, CASE
        WHEN o_orderpriority = '1-URGENT' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '371'
        WHEN o_orderpriority = '2-HIGH' THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
        WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN 'NaN'
        WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN 'inf'
        WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN ''
        WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN 'n/a'
        WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN '0'
        ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS raw
    FROM orders"""
CTES["num"] = """
    SELECT *, CASE WHEN ISFINITE(TRY_CAST(raw AS DOUBLE)) THEN TRY_CAST(raw AS DOUBLE) END AS x FROM dirty"""

VIEW_COLS = (
    "geo_id, city_display, metro_name, state_abbr, region, full_date, year, quarter, month, month_name, monthly_rent, annual_rent,"
    " bedroom_type, median_household_income, per_capita_income, population, {income_year} unemployment_rate, employment_level,"
    " median_home_price, rate_30yr_fixed, rent_to_income_ratio, affordable_monthly_rent, monthly_rent_gap, is_cost_burdened,"
    " is_severely_burdened, home_price_to_income_ratio, est_monthly_mortgage, mortgage_to_income_ratio, down_payment_required"
)
TABLES = [("fact_rent", "rent"), ("fact_home_prices", "home"), ("fact_income", "income"), ("fact_labor", "labor"), ("fact_mortgage_rates", "rates")]


def _gate(passed: bool) -> str:
    """The steps of a publication whose tables are in order; without ``passed`` one more check fails."""
    checks = []
    for name, _ in TABLES:
        checks.append(f"unique {name}")
        checks += [f"geography of {name}"] * (name != "fact_mortgage_rates") + [f"calendar of {name}"] * (name != "fact_income")
    checks += [f"one row a month in {n}" for n in ("fact_home_prices", "fact_labor", "fact_mortgage_rates")]
    steps = [(f"'check: {c}'", "'PASSED'", "0") for c in checks]
    if not passed:
        steps.append(("'check: no labor months'", "'FAILED'", "(SELECT COUNT(*) FROM labor)"))
    outcome = "'PASSED'" if passed else "'SKIPPED'"
    steps += [(f"'write {n}'", outcome, f"(SELECT COUNT(*) FROM {t})" if passed else "0") for n, t in [*TABLES, ("affordability_final", "spine")]]
    steps.append(("'publish'", outcome, "6" if passed else "0"))
    return " UNION ALL ".join(f"SELECT {i} AS step_no, {a} AS step, {b} AS status, CAST({c} AS BIGINT) AS row_count" for i, (a, b, c) in enumerate(steps, 1))


DATE_ID = "CAST(strftime({d}, '%Y%m%d') AS INT)"
MEAN4 = "ROUND(CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) / COUNT({c}), 4)"
MEAN2 = "ROUND(CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({c}), 2)"


def _date_id(d: str) -> str:
    return DATE_ID.format(d=d)


def _cleaned(value: str) -> str:
    return f"SELECT o_orderkey, raw, {value} AS cleaned FROM num"


def _values(rows) -> str:
    def one(v):
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows)


def _geo_rows():
    return [
        (g, name, city, st, reg, cbsa, seeds.listing_name(city, st), fips + cbsa, float(lat), float(lon))
        for g, name, city, st, reg, lat, lon, fips, cbsa, _ in seeds.METROS
    ]


def _scenario_rows():
    return [
        (i, n, float(r), float(d), None if inc is None else float(inc), y)
        for i, (n, r, d, inc, y) in enumerate(seeds.SCENARIOS, start=1)
    ]


SCENARIO_TABLE = (
    f"(VALUES {_values(_scenario_rows())}) AS sc(scenario_id, scenario_name, mortgage_rate, down_payment_pct, income_assumption, loan_term_years)"
)
SCENARIO_PAY = PAY.format(price="median_home_price", down="down_payment_pct / 100", rate="mortgage_rate", n="(loan_term_years * 12)")
CTES["paid"] = f"""
    SELECT geo_id, city_display, full_date, bedroom_type, CAST(scenario_id AS INT) AS scenario_id, scenario_name,
           COALESCE(CAST(income_assumption AS DOUBLE), median_household_income) AS scenario_income,
           ROUND(median_home_price * (CAST(down_payment_pct AS DOUBLE) / 100), 2) AS down_payment,
           ROUND({SCENARIO_PAY}, 2) AS scenario_payment,
           ROUND({SCENARIO_PAY} * 12 / COALESCE(CAST(income_assumption AS DOUBLE), median_household_income), 4) AS scenario_mti
    FROM m CROSS JOIN (SELECT scenario_id, scenario_name, CAST(mortgage_rate AS DOUBLE) AS mortgage_rate,
                              CAST(down_payment_pct AS DOUBLE) AS down_payment_pct, income_assumption, loan_term_years FROM {SCENARIO_TABLE})"""

COMPARED = [
    "monthly_rent", "rent_to_income_ratio", "mortgage_to_income_ratio", "home_price_to_income_ratio", "unemployment_rate",
    "median_household_income",
]

CTES["thirds"] = """
    SELECT i, a + (b - a) * i // 3 AS lo, a + (b - a) * (i + 1) // 3 AS hi
    FROM (SELECT MIN(YEAR(full_date)) AS a, MAX(YEAR(full_date)) + 1 AS b FROM labor) CROSS JOIN (VALUES (0), (1), (2)) AS v(i)"""

BODIES = {
    "src_wide_rent": """
        SELECT g.listing AS metro_raw, full_date AS report_date, monthly_rent, bedroom_type, 'Zillow ZORI' AS data_source
        FROM rent r JOIN geo g ON g.geo_id = r.geo_id WHERE bedroom_type = 'All Homes' AND full_date >= DATE '1996-01-01'""",
    "src_wide_home": """
        SELECT g.listing AS metro_raw, full_date AS report_date, median_home_price, 'All Homes' AS home_type, 'Zillow ZHVI' AS data_source
        FROM home h JOIN geo g ON g.geo_id = h.geo_id WHERE full_date >= DATE '1996-01-01'""",
    "src_rate_csv": "SELECT report_date, rate_30yr_fixed FROM weekly WHERE report_date >= DATE '1996-01-01'",
    "src_rate_json": "SELECT full_date AS report_date, rate_30yr_fixed FROM rates",
    "src_rate_fallback": """
        SELECT CAST(date_trunc('month', report_date) AS DATE) AS report_date,
               NULLIF(ROUND(CAST(SUM(CAST(rate_30yr_fixed AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*), 4), 0) AS rate_30yr_fixed
        FROM weekly WHERE report_date >= DATE '1996-01-01' GROUP BY 1""",
    "src_income_matrix": """
        SELECT LPAD(CAST(i.geo_id AS VARCHAR), 5, '0') AS source_key, survey_year, metro_name AS metro_raw, median_household_income,
               CASE WHEN region <> 'AFRICA' THEN per_capita_income END AS per_capita_income, population, 'Census ACS 5-Year' AS data_source
        FROM income i JOIN geo g ON g.geo_id = i.geo_id""",
    "src_multi_year_union": """
        SELECT LPAD(CAST(i.geo_id AS VARCHAR), 5, '0') AS source_key, survey_year, metro_name AS metro_raw, median_household_income,
               CASE WHEN region <> 'AFRICA' THEN per_capita_income END AS per_capita_income, population, 'Census ACS 5-Year' AS data_source
        FROM income i JOIN geo g ON g.geo_id = i.geo_id""",
    "src_labor_json": """
        SELECT city_display AS metro_raw, full_date AS report_date, unemployment_rate, employment_level, labor_force, 'BLS LAUS' AS data_source
        FROM labor l JOIN geo g ON g.geo_id = l.geo_id WHERE full_date >= DATE '1996-01-01'""",
    "src_cpi_json": """
        SELECT c.series_id, report_date, CAST(YEAR(report_date) AS INT) AS year, CAST(MONTH(report_date) AS INT) AS month, cpi_index,
               'All Items' AS cpi_category, 'BLS CPI' AS data_source, COALESCE(city_display, 'Unknown') AS city_display,
               COALESCE(city_display = 'United States', FALSE) AS is_national
        FROM (SELECT * FROM cpi UNION ALL SELECT 'SERIES_X', report_date, cpi_index FROM cpi WHERE series_id = 'SERIES_US') c
        LEFT JOIN bridge b ON b.series_id = c.series_id""",
    "src_fmr_variant": """
        SELECT entity_id, fmr_year AS requested_year, city AS metro_name, fmr_year, fmr_0br, fmr_1br, fmr_2br, fmr_3br, fmr_4br,
               CAST(40 AS INT) AS fmr_percentile, CAST(1 AS INT) AS smallarea_flag FROM fmr_read""",
    "fmr_newest_year": """
        SELECT entity_id, city AS metro_name, fmr_year, fmr_0br, fmr_1br, fmr_2br, fmr_3br, fmr_4br,
               CAST(40 AS INT) AS fmr_percentile, CAST(1 AS INT) AS smallarea_flag, city
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY entity_id ORDER BY fmr_year DESC) AS rn FROM fmr_read) WHERE rn = 1""",
    "union_windows": """
        SELECT 'LAUMT' || LPAD(CAST(geo_id AS VARCHAR), 2, '0') || LPAD(CAST(geo_id AS VARCHAR), 5, '0') || '000000' || code AS series_id,
               full_date AS report_date, v AS value
        FROM (SELECT geo_id, full_date, '03' AS code, CAST(unemployment_rate AS DOUBLE) AS v FROM labor
              UNION ALL SELECT geo_id, full_date, '05', CAST(employment_level AS DOUBLE) FROM labor
              UNION ALL SELECT geo_id, full_date, '06', CAST(labor_force AS DOUBLE) FROM labor
              UNION ALL SELECT geo_id, full_date, '99', CAST(labor_force AS DOUBLE) FROM labor)""",
    "skipped_windows": """
        SELECT 'window_' || CAST(i AS VARCHAR) AS request_window, 'status: REQUEST_NOT_PROCESSED' AS reason, COUNT(DISTINCT geo_id) AS documents
        FROM thirds JOIN labor ON YEAR(full_date) >= lo AND YEAR(full_date) < hi GROUP BY i
        UNION ALL SELECT 'window_cut', 'unreadable', LEAST(3, 2 * COUNT(DISTINCT geo_id)) FROM labor""",
    "series_id_build": """
        SELECT 'LAUMT' || LPAD(CAST(geo_id AS VARCHAR), 2, '0') || LPAD(CAST(geo_id AS VARCHAR), 5, '0') || '000000' || code AS series_id,
               city_display, measure, n AS customers
        FROM geo CROSS JOIN (VALUES ('03', 'unemployment_rate'), ('05', 'employment_level'), ('06', 'labor_force')) AS x(code, measure)
        LEFT JOIN (SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY 1) ON c_nationkey = geo_id""",
    "dim_geography": f"""
        SELECT CAST(v.geo_id AS INT) AS geo_id, metro_name, city_display, state_abbr, region, census_cbsa, zillow_name, bls_area_code,
               CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, n AS customers
        FROM (VALUES {_values(_geo_rows())}) AS v(geo_id, metro_name, city_display, state_abbr, region, census_cbsa, zillow_name, bls_area_code, latitude, longitude)
        LEFT JOIN (SELECT c_nationkey + 1 AS k, COUNT(*) AS n FROM customer GROUP BY 1) ON k = v.geo_id""",
    "dim_date": f"""
        SELECT {_date_id('d')} AS date_id, d AS full_date, CAST(YEAR(d) AS INT) AS year, CAST(QUARTER(d) AS INT) AS quarter,
               CAST(MONTH(d) AS INT) AS month, monthname(d) AS month_name, CAST(DAY(d) AS INT) AS day_of_month,
               MONTH(d) = 12 AND DAY(d) = 31 AS is_year_end, COALESCE(n, 0) AS orders
        FROM (SELECT CAST(UNNEST(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM span)
        LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS k, COUNT(*) AS n FROM orders GROUP BY 1) ON k = d""",
    "dim_scenario": f"""
        SELECT CAST(s.scenario_id AS INT) AS scenario_id, s.scenario_name, CAST(mortgage_rate AS DOUBLE) AS mortgage_rate,
               CAST(down_payment_pct AS DOUBLE) AS down_payment_pct, CAST(income_assumption AS DOUBLE) AS income_assumption,
               CAST(loan_term_years AS INT) AS loan_term_years, metric_rows, mean_payment
        FROM (SELECT * FROM {SCENARIO_TABLE}) s LEFT JOIN (
            SELECT scenario_id, COUNT(*) AS metric_rows, {MEAN2.format(c='scenario_payment')} AS mean_payment FROM paid GROUP BY 1
        ) p ON p.scenario_id = s.scenario_id""",
    "crosswalk_values_join": """
        SELECT g.listing AS metro_raw, r.full_date, bedroom_type, monthly_rent, g.geo_id FROM rent r JOIN geo g ON g.geo_id = r.geo_id""",
    "fact_rent": f"""
        SELECT geo_id, {_date_id('full_date')} AS date_id, monthly_rent, ROUND(monthly_rent * 12, 2) AS annual_rent, bedroom_type,
               'Zillow ZORI' AS data_source FROM rent""",
    "fact_home": f"""
        SELECT geo_id, {_date_id('full_date')} AS date_id, median_home_price, 'All Homes' AS home_type, 'Zillow ZHVI' AS data_source FROM home""",
    "fact_income": "SELECT *, 'Census ACS 5-Year' AS data_source FROM income",
    "fact_labor": f"""
        SELECT geo_id, {_date_id('full_date')} AS date_id, unemployment_rate, employment_level, labor_force, 'BLS LAUS' AS data_source FROM labor""",
    "fact_rate": f"SELECT {_date_id('full_date')} AS date_id, rate_30yr_fixed, 'FRED MORTGAGE30US' AS data_source FROM rates",
    "fact_cpi": f"""
        SELECT g.geo_id, c.series_id, c.city_display,
               {_date_id('report_date')} AS date_id, report_date,
               CAST(YEAR(report_date) AS INT) AS year, CAST(MONTH(report_date) AS INT) AS month, cpi_index, 'All Items' AS cpi_category,
               CAST(CASE WHEN c.city_display = 'United States' THEN 1 ELSE 0 END AS INT) AS is_national, 'BLS CPI' AS data_source,
               DATE '2001-12-31' AS load_date
        FROM cpi_city c LEFT JOIN geo g ON g.city_display = c.city_display""",
    "cpi_fanout": """
        SELECT s.geo_id, s.full_date AS report_date, COALESCE(c.cpi_index, u.cpi_index) AS cpi_index
        FROM (SELECT DISTINCT geo_id, full_date FROM rent) s JOIN geo g ON g.geo_id = s.geo_id
        LEFT JOIN cpi_city c ON c.city_display = g.city_display AND c.report_date = s.full_date
        LEFT JOIN cpi u ON u.series_id = 'SERIES_US' AND u.report_date = s.full_date""",
    "fact_fmr": """
        SELECT entity_id, city, metro_name, fmr_year, fmr_0br, fmr_1br, fmr_2br, fmr_3br, fmr_4br, CAST(40 AS INT) AS fmr_percentile,
               CAST(1 AS INT) AS smallarea_flag, DATE '2001-12-31' AS load_date FROM fmr""",
    "star_join": f"""
        SELECT geo_id, {_date_id('full_date')} AS date_id, city_display, region, full_date, year, quarter, month_name, bedroom_type, monthly_rent
        FROM spine""",
    "like_join": """
        SELECT s.metro_name AS metro_raw, i.survey_year, i.median_household_income, g.geo_id
        FROM income i
        JOIN (SELECT s.geo_id, s.metro_name, ARG_MIN(n_name, n_nationkey) AS k FROM geo s JOIN nation ON contains(s.metro_name, n_name) GROUP BY 1, 2) s
             ON s.geo_id = i.geo_id
        JOIN geo g ON contains(g.metro_name, s.k)""",
    "staging_overwrite": """
        SELECT unemployment_rate, full_date AS report_date, employment_level, labor_force, city_display AS metro_raw, 'BLS LAUS' AS data_source
        FROM labor l JOIN geo g ON g.geo_id = l.geo_id WHERE full_date >= DATE '1996-01-01'""",
    "upsert_fmr": """
        SELECT entity_id, city, metro_name, fmr_year, fmr_0br, fmr_1br,
               CASE WHEN fmr_year >= 2000 THEN ROUND(fmr_2br + 1, 2) ELSE fmr_2br END AS fmr_2br, fmr_3br, fmr_4br,
               CAST(40 AS INT) AS fmr_percentile, CAST(1 AS INT) AS smallarea_flag, DATE '2001-12-31' AS load_date FROM fmr""",
    "quarantine_rows": """
        SELECT o_orderkey, o_orderpriority, raw, CASE WHEN x >= 0 THEN 'good' ELSE 'quarantined' END AS outcome FROM num""",
    "affordability_final": """
        SELECT a.geo_id, a.full_date, a.bedroom_type, a.monthly_rent, a.rent_to_income_ratio, a.mortgage_to_income_ratio,
               a.unemployment_rate, a.pressure_score, ROUND(a.down_payment_required / (a.median_household_income * 0.10), 2) AS years_to_save,
               ROUND((a.monthly_rent - b.monthly_rent) / NULLIF(b.monthly_rent, 0), 4) AS rent_growth_yoy,
               ROUND((i.median_household_income - j.median_household_income) / j.median_household_income, 4) AS income_growth_yoy,
               ROUND((a.rent_to_income_ratio - h.mu) / CASE WHEN h.sd > 1e-9 THEN h.sd END, 4) AS zscore,
               d.divergence, c.city_classification
        FROM mp a
        LEFT JOIN rent b ON b.geo_id = a.geo_id AND b.bedroom_type = a.bedroom_type AND b.full_date = a.full_date - INTERVAL 1 YEAR
        LEFT JOIN income i ON i.geo_id = a.geo_id AND i.survey_year = a.year
        LEFT JOIN income j ON j.geo_id = a.geo_id AND j.survey_year = a.year - 1
        LEFT JOIN (SELECT geo_id, bedroom_type, CAST(SUM(CAST(rent_to_income_ratio AS DECIMAL(18,4))) AS DOUBLE) / COUNT(rent_to_income_ratio) AS mu,
                          STDDEV_SAMP(rent_to_income_ratio) AS sd FROM m GROUP BY 1, 2) h ON h.geo_id = a.geo_id AND h.bedroom_type = a.bedroom_type
        LEFT JOIN divergence d ON d.geo_id = a.geo_id AND d.year = a.year
        LEFT JOIN classes c ON c.geo_id = a.geo_id""",
    "publish_gate": _gate(False),
    "publish_gate_passed": _gate(True),
    "clean_money": _cleaned("ROUND(x, 2)"),
    "clean_rate": _cleaned("ROUND(x, 4)"),
    "clean_income": _cleaned("CASE WHEN x >= 0 THEN ROUND(x, 2) END"),
    "clean_int": _cleaned("CAST(TRUNC(x) AS BIGINT)"),
    "clean_population": _cleaned("CASE WHEN x > 0 THEN CAST(TRUNC(x) AS BIGINT) END"),
    "rate_weekly_to_monthly": """
        SELECT CAST(date_trunc('month', report_date) AS DATE) AS report_date,
               NULLIF(ROUND(CAST(SUM(CAST(rate_30yr_fixed AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*), 4), 0) AS rate_30yr_fixed
        FROM weekly GROUP BY 1""",
    "filter_metro_semi": """
        SELECT c_custkey, n_name AS city_display, c_mktsegment, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_mktsegment <> 'BUILDING'""",
    "filter_since": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
    "filter_monthly_period": """
        SELECT CAST(YEAR(l_shipdate) AS INT) AS year, 'M' || LPAD(CAST(MONTH(l_shipdate) AS VARCHAR), 2, '0') AS period, COUNT(*) AS n,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS report_date FROM lineitem GROUP BY 1, 2, 4""",
    "unpivot_wide": """
        SELECT g.listing AS "RegionName", full_date AS report_date, monthly_rent FROM rent r JOIN geo g ON g.geo_id = r.geo_id
        WHERE bedroom_type = 'All Homes'""",
    "pivot_measures": """
        SELECT geo_id, full_date, unemployment_rate, CAST(employment_level AS DOUBLE) AS employment_level,
               CAST(labor_force AS DOUBLE) AS labor_force, CAST(NULL AS DOUBLE) AS absent_measure FROM labor""",
    "fmr_by_bedroom": """
        SELECT entity_id, city, fmr_year, 'fmr_0br' AS bedroom, fmr_0br AS fair_market_rent FROM fmr
        UNION ALL SELECT entity_id, city, fmr_year, 'fmr_1br', fmr_1br FROM fmr
        UNION ALL SELECT entity_id, city, fmr_year, 'fmr_2br', fmr_2br FROM fmr
        UNION ALL SELECT entity_id, city, fmr_year, 'fmr_3br', fmr_3br FROM fmr
        UNION ALL SELECT entity_id, city, fmr_year, 'fmr_4br', fmr_4br FROM fmr""",
    "dedupe_series": """
        SELECT series_id, report_date, cpi_index FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id, report_date ORDER BY seq) AS rn FROM (
                SELECT *, 0 AS seq FROM cpi WHERE YEAR(report_date) <= 1998
                UNION ALL SELECT series_id, report_date, ROUND(cpi_index + 1, 4), 1 FROM cpi WHERE YEAR(report_date) >= 1997)) WHERE rn = 1""",
    "date_parts": f"""
        SELECT n AS orders, {_date_id('d')} AS date_id, d AS full_date, CAST(YEAR(d) AS INT) AS year, CAST(QUARTER(d) AS INT) AS quarter,
               CAST(MONTH(d) AS INT) AS month, monthname(d) AS month_name, CAST(DAY(d) AS INT) AS day_of_month,
               CAST(CASE WHEN MONTH(d) = 12 AND DAY(d) = 31 THEN 1 ELSE 0 END AS INT) AS is_year_end,
               CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(d + INTERVAL 1 DAY AS DATE) AS next_day
        FROM (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1)""",
    "affordability_metrics": f"SELECT {VIEW_COLS.format(income_year='income_year,')} FROM m",
    "metrics_exact": f"SELECT {VIEW_COLS.format(income_year='')} FROM mx",
    "metrics_asof": """
        SELECT s.geo_id, s.full_date, s.bedroom_type, i.median_household_income, i.survey_year AS income_year, l.unemployment_rate,
               h.median_home_price, q.rate_30yr_fixed,
               CASE WHEN i.median_household_income > 0 THEN ROUND(s.annual_rent / i.median_household_income, 4) END AS rent_to_income_ratio
        FROM spine s
        ASOF LEFT JOIN income i ON i.geo_id = s.geo_id AND s.year >= i.survey_year
        ASOF LEFT JOIN labor l ON l.geo_id = s.geo_id AND s.full_date >= l.full_date
        ASOF LEFT JOIN home h ON h.geo_id = s.geo_id AND s.full_date >= h.full_date
        ASOF LEFT JOIN rates q ON s.full_date >= q.full_date""",
    "join_latest_fallback": """
        SELECT r.geo_id, r.full_date, r.bedroom_type, COALESCE(h.median_home_price, n.median_home_price) AS median_home_price
        FROM rent r LEFT JOIN home h ON h.geo_id = r.geo_id AND h.full_date = r.full_date LEFT JOIN newest_home n ON n.geo_id = r.geo_id""",
    "latest_income_join": """
        SELECT r.geo_id, r.full_date, r.bedroom_type, r.monthly_rent, i.median_household_income, i.per_capita_income, i.population,
               i.survey_year AS income_year FROM rent r LEFT JOIN newest_income i ON i.geo_id = r.geo_id""",
    "asof_income": """
        SELECT r.geo_id, r.full_date, r.bedroom_type, i.survey_year AS income_year, i.median_household_income
        FROM rent r ASOF LEFT JOIN income i ON i.geo_id = r.geo_id AND YEAR(r.full_date) >= i.survey_year""",
    "cross_scalar": """
        SELECT r.geo_id, r.full_date, r.bedroom_type, COALESCE(q.rate_30yr_fixed, (SELECT rate_30yr_fixed FROM newest_rate)) AS rate_30yr_fixed
        FROM rent r LEFT JOIN rates q ON q.full_date = r.full_date""",
    "latest_snapshot": f"""
        SELECT {VIEW_COLS.format(income_year='income_year,')} FROM (SELECT *, RANK() OVER (PARTITION BY geo_id, bedroom_type ORDER BY full_date DESC) AS r FROM m) WHERE r = 1""",
    "latest_snapshot_correlated": f"""
        SELECT {VIEW_COLS.format(income_year='income_year,')} FROM m a
        WHERE full_date = (SELECT MAX(full_date) FROM m b WHERE b.geo_id = a.geo_id AND b.bedroom_type = a.bedroom_type)""",
    "coverage_anti": """
        SELECT g.geo_id, d.full_date, k.bedroom_type
        FROM geo g CROSS JOIN (SELECT CAST(UNNEST(generate_series(CAST(MIN(full_date) AS TIMESTAMP), CAST(MAX(full_date) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS full_date FROM rent) d
        CROSS JOIN (VALUES ('All Homes'), ('1br')) AS k(bedroom_type)
        WHERE NOT EXISTS (SELECT 1 FROM rent r WHERE r.geo_id = g.geo_id AND r.full_date = d.full_date AND r.bedroom_type = k.bedroom_type)""",
    "city_compare": f"""
        SELECT a.geo_id, a.city_display, a.full_date, a.bedroom_type, 'NATION_0' AS base_city, {', '.join(f'a.{c}' for c in COMPARED)},
               {', '.join(f'b.{c} AS base_{c}' for c in COMPARED)}, {', '.join(f'ROUND(a.{c} - b.{c}, 4) AS diff_{c}' for c in COMPARED)}
        FROM m a JOIN m b ON b.full_date = a.full_date AND b.bedroom_type = a.bedroom_type AND b.city_display = 'NATION_0'
        WHERE a.city_display <> 'NATION_0'""",
    "profile_rent": f"""
        SELECT city_display, COUNT(*) AS row_count, MIN(full_date) AS earliest, MAX(full_date) AS latest, {MEAN2.format(c='monthly_rent')} AS avg_rent
        FROM spine WHERE bedroom_type = 'All Homes' GROUP BY 1""",
    "profile_home": f"""
        SELECT city_display, COUNT(*) AS row_count, MIN(full_date) AS earliest, MAX(full_date) AS latest,
               {MEAN2.format(c='median_home_price')} AS avg_home_price FROM home h JOIN geo g ON g.geo_id = h.geo_id GROUP BY 1""",
    "profile_income": """
        SELECT city_display, COUNT(*) AS year_count, MIN(survey_year) AS earliest_year, MAX(survey_year) AS latest_year,
               MAX(median_household_income) AS max_income, ARG_MAX(median_household_income, survey_year) AS latest_income
        FROM income i JOIN geo g ON g.geo_id = i.geo_id GROUP BY 1""",
    "profile_labor": f"""
        SELECT city_display, COUNT(*) AS row_count, MIN(full_date) AS earliest, MAX(full_date) AS latest, {MEAN4.format(c='unemployment_rate')} AS avg_unemp,
               MIN(unemployment_rate) AS min_unemp, MAX(unemployment_rate) AS max_unemp FROM labor l JOIN geo g ON g.geo_id = l.geo_id GROUP BY 1""",
    "profile_rate": f"""
        SELECT MIN(full_date) AS earliest, MAX(full_date) AS latest, COUNT(*) AS row_count, {MEAN4.format(c='rate_30yr_fixed')} AS avg_rate,
               MIN(rate_30yr_fixed) AS min_rate, MAX(rate_30yr_fixed) AS max_rate FROM rates""",
    "profile_cpi": """
        SELECT city_display, COUNT(*) AS months, MIN(report_date) AS earliest, MAX(report_date) AS latest, MIN(cpi_index) AS min_cpi,
               MAX(cpi_index) AS max_cpi FROM cpi_city GROUP BY 1 ORDER BY 1 LIMIT 10""",
    "dq_null_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, COUNT(*) AS row_count FROM exact"
        for c in ("monthly_rent", "median_household_income", "unemployment_rate", "median_home_price", "rate_30yr_fixed")
    ),
    "dq_unmatched_geo": """
        SELECT c.city_display, COUNT(*) AS row_count, SUM(CASE WHEN c.city_display = 'United States' THEN 1 ELSE 0 END)::BIGINT AS national_rows
        FROM cpi_city c LEFT JOIN geo g ON g.city_display = c.city_display WHERE g.geo_id IS NULL GROUP BY 1""",
    "profile_columns": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count FROM {table}"
        for table, names in (
            ("customer", "c_custkey c_name c_nationkey c_acctbal c_mktsegment"),
            ("orders", "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority"),
            ("lineitem", "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"),
        )
        for c in names.split()
    ),
    "dq_row_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in ("rent", "home", "income", "labor", "rates")
    ),
    "coverage_counts": """
        SELECT bedroom_type, COUNT(DISTINCT geo_id) AS metros, COUNT(DISTINCT full_date) AS months, COUNT(*) AS row_count FROM rent GROUP BY 1""",
    "dq_unique": "SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
    "dq_orphans": """
        SELECT geo_id, full_date, employment_level FROM labor l
        WHERE NOT EXISTS (SELECT 1 FROM home h WHERE h.geo_id = l.geo_id AND h.full_date = l.full_date)""",
    "snapshot_report": """
        SELECT city_display, full_date, monthly_rent, median_household_income, unemployment_rate, rent_to_income_ratio, est_monthly_mortgage,
               mortgage_to_income_ratio FROM newest""",
    "city_classification": """
        SELECT geo_id, city_display, state_abbr, region, rent_to_income_ratio, unemployment_rate, median_household_income, city_classification
        FROM classes""",
    "city_classification_median": f"""
        SELECT geo_id, city_display, state_abbr, region, rent_to_income_ratio, unemployment_rate, median_household_income,
               {CLASS.format(r='c.rti50', u='c.unemp50')} FROM newest CROSS JOIN middle c""",
    "affordability_zscore": """
        SELECT * EXCLUDE (z), CAST(CASE WHEN z > 2 THEN 1 ELSE 0 END AS INT) AS is_unusual FROM (
            SELECT geo_id, city_display, current_rti, ROUND(mu, 4) AS mean_rti, ROUND(sd, 4) AS sd_rti, months,
                   ROUND((current_rti - mu) / CASE WHEN sd > 1e-9 THEN sd END, 4) AS zscore, (current_rti - mu) / CASE WHEN sd > 1e-9 THEN sd END AS z
            FROM (SELECT geo_id, city_display, ARG_MAX(rent_to_income_ratio, full_date) AS current_rti,
                         CAST(SUM(CAST(rent_to_income_ratio AS DECIMAL(18,4))) AS DOUBLE) / COUNT(rent_to_income_ratio) AS mu,
                         STDDEV_SAMP(rent_to_income_ratio) AS sd, COUNT(rent_to_income_ratio) AS months
                  FROM m WHERE bedroom_type = 'All Homes' GROUP BY 1, 2))""",
    "rent_yoy": """
        SELECT a.geo_id, a.bedroom_type, CAST(YEAR(a.full_date) AS INT) AS year, CAST(MONTH(a.full_date) AS INT) AS month, a.monthly_rent,
               b.monthly_rent AS prior_rent, ROUND((a.monthly_rent - b.monthly_rent) / NULLIF(b.monthly_rent, 0), 4) AS rent_growth_yoy
        FROM rent a LEFT JOIN rent b ON b.geo_id = a.geo_id AND b.bedroom_type = a.bedroom_type
             AND YEAR(b.full_date) = YEAR(a.full_date) - 1 AND MONTH(b.full_date) = MONTH(a.full_date)""",
    "income_yoy": """
        SELECT a.geo_id, a.survey_year, a.median_household_income AS income, b.median_household_income AS prior_income,
               ROUND((a.median_household_income - b.median_household_income) / NULLIF(b.median_household_income, 0), 4) AS income_growth_yoy
        FROM income a LEFT JOIN income b ON b.geo_id = a.geo_id AND b.survey_year = a.survey_year - 1""",
    "rent_income_divergence": "SELECT * FROM divergence",
    "growth_gap_by_year": """
        SELECT r.year, r.g AS avg_rent_growth, i.g AS avg_income_growth, ROUND(r.g - i.g, 4) AS growth_gap FROM (
            SELECT year, ROUND(CAST(SUM(CAST(g AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(COUNT(g), 0), 4) AS g FROM (
                SELECT a.year, ROUND((a.rent - b.rent) / b.rent, 4) AS g FROM rent_y a LEFT JOIN rent_y b ON b.geo_id = a.geo_id AND b.year = a.year - 1
            ) GROUP BY 1) r
        LEFT JOIN (
            SELECT year, ROUND(CAST(SUM(CAST(g AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(COUNT(g), 0), 4) AS g FROM (
                SELECT a.survey_year AS year, ROUND((a.median_household_income - b.median_household_income) / b.median_household_income, 4) AS g
                FROM income a LEFT JOIN income b ON b.geo_id = a.geo_id AND b.survey_year = a.survey_year - 1
            ) GROUP BY 1) i ON i.year = r.year""",
    "pressure_score": "SELECT geo_id, full_date, bedroom_type, pressure_score FROM mp",
    "years_to_save": """
        SELECT geo_id, full_date, bedroom_type, down_payment_required,
               ROUND(down_payment_required / (CASE WHEN median_household_income > 0 THEN median_household_income END * 0.10), 2) AS years_to_save FROM m""",
    "pressure_ranking": """
        SELECT geo_id, city_display, full_date, rent_to_income_ratio, pressure_score,
               CAST(RANK() OVER (ORDER BY pressure_score DESC NULLS LAST) AS INT) AS pressure_rank,
               CAST(RANK() OVER (ORDER BY rent_to_income_ratio DESC NULLS LAST) AS INT) AS burden_rank FROM newest""",
    "top5_stressed_trend": """
        SELECT geo_id, city_display, full_date, rent_to_income_ratio, mortgage_to_income_ratio, unemployment_rate, pressure_score FROM mp
        WHERE bedroom_type = 'All Homes' AND geo_id IN (SELECT geo_id FROM newest ORDER BY pressure_score DESC NULLS LAST, geo_id LIMIT 5)""",
    "signals_join": """
        SELECT p.geo_id, p.city_display, p.year, p.pressure_score, z.zscore, d.divergence FROM (
            SELECT geo_id, city_display, year, ROUND(CAST(SUM(CAST(pressure_score AS DECIMAL(18,2))) AS DOUBLE) / COUNT(pressure_score), 2) AS pressure_score
            FROM mp WHERE bedroom_type = 'All Homes' GROUP BY 1, 2, 3) p
        JOIN (SELECT a.geo_id, a.year, ROUND((a.rti - h.mu) / h.sd, 4) AS zscore FROM (
                  SELECT geo_id, year, CAST(SUM(CAST(rent_to_income_ratio AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*) AS rti
                  FROM m WHERE bedroom_type = 'All Homes' GROUP BY 1, 2) a
              JOIN (SELECT geo_id, CAST(SUM(CAST(rent_to_income_ratio AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*) AS mu, STDDEV_SAMP(rent_to_income_ratio) AS sd
                    FROM m WHERE bedroom_type = 'All Homes' GROUP BY 1) h ON h.geo_id = a.geo_id) z ON z.geo_id = p.geo_id AND z.year = p.year
        JOIN divergence d ON d.geo_id = p.geo_id AND d.year = p.year""",
    "driver_split": """
        SELECT geo_id, city_display, median_household_income, monthly_rent, rent_to_income_ratio,
               CASE WHEN median_household_income IS NULL OR monthly_rent IS NULL THEN 'unknown'
                    WHEN median_household_income > c.income AND monthly_rent <= c.rent THEN 'high income and cheap housing'
                    WHEN median_household_income > c.income THEN 'high income' WHEN monthly_rent <= c.rent THEN 'cheap housing'
                    ELSE 'neither' END AS driver FROM newest CROSS JOIN middle c""",
    "stress_lead_time": """
        SELECT a.geo_id, city_display, first_divergence, first_burden, CAST(date_diff('day', first_divergence, first_burden) AS INT) AS lead_days
        FROM (SELECT geo_id, city_display, MIN(CASE WHEN is_cost_burdened = 1 THEN full_date END) AS first_burden
              FROM m WHERE bedroom_type = 'All Homes' GROUP BY 1, 2) a
        LEFT JOIN (SELECT geo_id, make_date(CAST(MIN(year) AS BIGINT), 1, 1) AS first_divergence FROM divergence WHERE divergence > 0 GROUP BY 1) d
             ON d.geo_id = a.geo_id""",
    "latest_rate": "SELECT full_date, rate_30yr_fixed FROM rates ORDER BY full_date DESC LIMIT 1",
    "top_fmr": "SELECT city, fmr_year, fmr_1br, fmr_2br, fmr_3br FROM fmr ORDER BY fmr_2br DESC NULLS LAST, city, fmr_year LIMIT 25",
    "scenario_payment": "SELECT * FROM paid",
    "scenario_rent_burden": """
        SELECT geo_id, city_display, full_date, bedroom_type, CAST(x AS DOUBLE) AS input_income, ROUND(annual_rent / x, 4) AS rent_burden,
               CAST(COALESCE(x > 0 AND CAST(annual_rent AS DECIMAL(28,6)) > CAST(x AS DECIMAL(28,6)) * 0.30, FALSE) AS INT) AS is_cost_burdened
        FROM m CROSS JOIN (VALUES (50000.0::DOUBLE), (75000.0::DOUBLE), (100000.0::DOUBLE)) AS v(x)""",
    "rate_sensitivity": f"""
        SELECT geo_id, city_display, full_date, bedroom_type, rate, ROUND(p, 2) AS payment, ROUND(p - p0, 2) AS extra_payment FROM (
            SELECT *, {PAY.format(price='median_home_price', down='0.2', rate='rate', n='360')} AS p,
                   {PAY.format(price='median_home_price', down='0.2', rate='3.0::DOUBLE', n='360')} AS p0
            FROM m CROSS JOIN (SELECT 3.0::DOUBLE + i * 0.5::DOUBLE AS rate FROM generate_series(0, 10) AS s(i)))""",
    "relocation_savings": """
        SELECT geo_id, city_display, n.monthly_rent, t.destination, ROUND(n.monthly_rent - t.rent, 2) AS monthly_saving,
               ROUND((n.monthly_rent - t.rent) * 12, 2) AS annual_saving, ROUND(n.monthly_rent * 12 / 75000.0, 4) AS burden_here,
               ROUND(t.rent * 12 / 75000.0, 4) AS burden_there
        FROM newest n CROSS JOIN (SELECT monthly_rent AS rent, city_display AS destination FROM classes
                                  WHERE city_classification = 'Opportunity City' ORDER BY monthly_rent, city_display LIMIT 1) t""",
}


def _used(sql: str) -> list[str]:
    """Shared sub-queries that a statement reads, in an order that defines each before its use."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in found and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def _decimal_rounding(sql: str) -> str:
    """ROUND of the decimal value: ties go away from zero and not by the last bit of a double."""
    out, i = "", 0
    while (j := sql.find("ROUND(", i)) >= 0:
        depth, k, comma = 1, j + 6, -1
        while depth:
            depth += (sql[k] == "(") - (sql[k] == ")")
            comma = k if depth == 1 and sql[k] == "," else comma
            k += 1
        value = _decimal_rounding(sql[j + 6 : comma])
        out += f"{sql[i:j]}CAST(ROUND(CAST({value} AS DECIMAL(28,8)),{sql[comma + 1 : k - 1]}) AS DOUBLE)"
        i = k
    return out + sql[i:]


def statements() -> dict[str, str]:
    out = {}
    for name, body in BODIES.items():
        used = _used(body)
        prefix = "WITH " + ", ".join(f"{n} AS ({CTES[n].strip()})" for n in used) + " " if used else ""
        out[name] = _decimal_rounding(prefix + body.strip())
    return out
