"""Readers on landed files with the defects that real files have."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from hearth import seeds
from hearth.operators.reshape import date_columns, pivot_measures
from hearth.plans import conform, dims
from hearth.sources import fmr, income, rates, series, wide
from hearth.sources.landing import first_available


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_wide_csv(spark, tmp_path, rows):
    path = write(tmp_path / "a.csv", "\n".join([
        "RegionID,SizeRank,RegionName,RegionType,StateName,State,2014-12-31,2015-01-31,2015-02-28",
        '1,0,"New York, NY",msa,NY,NY,1,2500.555,2600.1',
        '2,1,"St. Louis, MO",msa,MO,MO,1,NaN,abc',
        '3,2,"Washington, DC",msa,DC,DC,1,,1800',
        '4,3,"Nowhere, ZZ",msa,ZZ,ZZ,1,900,900',
    ]))
    raw = wide.read_wide(spark, [str(tmp_path / "absent.csv"), path])
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    got = wide.staged_rent(raw, seeds.listing_crosswalk(spark))
    assert rows(got, "metro_raw", "report_date", "monthly_rent") == [
        ("New York, NY", date(2015, 1, 31), 2500.56), ("New York, NY", date(2015, 2, 28), 2600.1),
        ("Washington, DC", date(2015, 2, 28), 1800.0),
    ]
    facts = conform.fact_rent(got, seeds.listing_crosswalk(spark), dims.geography(spark))
    assert rows(facts.select("geo_id", "date_id", F.col("annual_rent").cast("string"))) == [
        (1, 20150131, "30006.72"), (1, 20150228, "31201.20"), (6, 20150228, "21600.00"),
    ]


def test_no_file_and_no_dates(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        first_available(spark, [str(tmp_path / "x.csv")])
    with pytest.raises(ValueError):
        wide.long_series(spark.createDataFrame([("a", "b")], "RegionName string, State string"), seeds.listing_crosswalk(spark), "v")


def test_date_columns():
    names = ["RegionName", "State", "2014-12-31", "2015-01-31", "2015-13-01", "Metro"]
    assert list(date_columns(names)) == ["2014-12-31", "2015-01-31"]
    assert date_columns(names, date(2015, 1, 1)) == {"2015-01-31": date(2015, 1, 31)}


def test_rates_json_first_then_csv(spark, tmp_path, rows):
    csv = write(tmp_path / "r.csv", "\n".join([
        "observation_date,MORTGAGE30US", "2014-12-25,9.9", "2015-01-01,3.5", "2015-01-08,3.6", "2015-01-15,.",
        "2015-02-05,0", "bad,3.3", "2015-03-05,inf", "2015-03-12,4.1",
    ]))
    from_csv = [(date(2015, 1, 1), 3.55), (date(2015, 2, 1), None), (date(2015, 3, 1), 4.1)]
    assert rows(rates.read_rates(spark, [str(tmp_path / "none.json")], [csv])) == from_csv
    empty = write(tmp_path / "e.json", '{"observations": []}')
    assert rows(rates.read_rates(spark, [empty], [csv])) == from_csv
    full = write(tmp_path / "f.json", json.dumps({"observations": [
        {"date": "2015-01-01", "value": "3.67125"}, {"date": "2015-02-01", "value": "."}, {"date": "2015-03-01", "value": "x"},
    ]}))
    assert rows(rates.read_rates(spark, [full], [csv])) == [(date(2015, 1, 1), 3.6713)]


def matrix(code_title, *data):
    return json.dumps([["NAME", "B19013_001E", "B19301_001E", "B01003_001E", code_title], *data])


def test_income_matrix(spark, tmp_path, rows):
    a = write(tmp_path / "2015.json", matrix(
        "metropolitan statistical area/micropolitan statistical area",
        ["New York-Newark-Jersey City, NY-NJ-PA Metro Area", "70000", "36000.5", "20000000", "35620"],
        ["Elsewhere Micro Area", "1", "1", "1", "99999"],
    ))
    b = write(tmp_path / "2016.json", matrix(
        "New Statistical Area",
        ["Washington-Arlington-Alexandria, DC-VA-MD-WV Metro Area", "-666666666", "50000", "0", "47900"],
        ["Portland-Vancouver-Hillsboro, OR-WA Metro Area", "65000", None, "abc", "38900"],
    ))
    responses = income.read_years(spark, {2014: str(tmp_path / "2014.json"), 2015: a, 2016: b})
    got = income.staged_income(responses, seeds.cbsa_crosswalk(spark))
    assert rows(got, "source_key", "survey_year", "median_household_income", "per_capita_income", "population") == [
        ("35620", 2015, 70000.0, 36000.5, 20000000), ("38900", 2016, 65000.0, None, None), ("47900", 2016, None, 50000.0, None),
    ]
    facts = conform.fact_income(got, dims.geography(spark))
    assert rows(facts, "geo_id", "survey_year") == [(1, 2015), (20, 2016)]
    with pytest.raises(ValueError):
        income.read_years(spark, {2014: str(tmp_path / "2014.json")})


def response(*all_series, status="REQUEST_SUCCEEDED"):
    return json.dumps({"status": status, "message": [], "Results": {"series": [
        {"seriesID": sid, "data": [{"year": y, "period": p, "value": v} for y, p, v in data]} for sid, data in all_series
    ]}})


def test_labor(spark, tmp_path, rows):
    ny = "LAUMT3635620000000"
    write(tmp_path / "w1" / "a.json", response(
        (ny + "03", [("2015", "M01", "6.1"), ("2015", "M13", "5.0"), ("2015", "M02", "-"), ("2014", "M12", "7.0"), ("2015", "M01", "9.9")]),
        (ny + "05", [("2015", "M01", "9000000.7")]),
        ("LAUMT000000000000003", [("2015", "M01", "1.0")]),
    ))
    write(tmp_path / "w2" / "a.json", response((ny + "03", [("2020", "M03", "4.4")])))
    write(tmp_path / "w2" / "b.json", response((ny + "03", [("2020", "M04", "14.0")]), status="REQUEST_FAILED"))
    windows = [series.read_responses(spark, str(tmp_path / w)) for w in ("w1", "w2")]
    obs = series.union_windows(windows)
    ids = series.series_ids(seeds.labor_areas(spark), seeds.LABOR_MEASURES)
    assert ids.count() == 75
    got = series.staged_labor(obs, ids)
    assert rows(got, "metro_raw", "report_date", "unemployment_rate", "employment_level", "labor_force") == [
        ("New York", date(2015, 1, 1), 6.1, 9000000, None), ("New York", date(2020, 3, 1), 4.4, None, None),
    ]
    assert rows(series.missing_years(obs, 2018, 2021)) == [(2018,), (2019,), (2021,)]
    assert rows(conform.fact_labor(got, dims.geography(spark)), "geo_id", "date_id") == [(1, 20150101), (1, 20200301)]


def test_cpi_first_reading_wins_and_series_fan_out(spark, tmp_path, rows):
    write(tmp_path / "c" / "a.json", response(
        ("CUURS49DSA0", [("2015", "M02", "240.1"), ("2015", "M02", "999"), ("2015", "M13", "1"), ("2015", "M03", "x")]),
        ("CUUR0000SA0", [("2015", "M02", "233.7071")]), ("CUUR0000XXX", [("2015", "M02", "1.5")]),
    ))
    obs = series.union_windows([series.read_responses(spark, str(tmp_path / "c"))] * 2)
    cities = series.fan_out_cpi(series.staged_cpi(obs, date(2026, 1, 1)), seeds.cpi_bridge(spark))
    facts = conform.fact_cpi(cities, dims.geography(spark), dims.date_spine(spark))
    assert rows(facts.select("geo_id", "city_display", F.col("cpi_index").cast("double"), "is_national")) == [
        (None, "United States", 233.7071, True), (None, "Unknown", 1.5, False), (13, "Seattle", 240.1, False), (20, "Portland", 240.1, False),
    ]
    spine = spark.createDataFrame([(13, date(2015, 2, 1)), (1, date(2015, 2, 1))], "geo_id int, report_date date")
    filled = conform.cpi_or_national(spine, facts).select("geo_id", F.col("cpi_index").cast("double"))
    assert rows(filled) == [(1, 233.7071), (13, 240.1)]


B = {"Efficiency": 1000, "One-Bedroom": "1100.555", "Two-Bedroom": 1300, "Three-Bedroom": None, "Four-Bedroom": "n/a"}
SHAPES = [
    ("list with metro row", {"data": {"year": 2026, "metro_name": "M", "smallarea_status": 1, "FMR Percentile": 40,
                                      "basicdata": [{"zip_code": "10001", "Two-Bedroom": 1}, {"zip_code": " MSA Level", **B}]}}, 2026, 1),
    ("list without metro row", {"data": {"basicdata": [{"zip_code": "10001", **B}, {"zip_code": "2", "Two-Bedroom": 1}]}}, 2025, 0),
    ("object", {"data": {"year": "2024", "smallarea_status": "0", "basicdata": B}}, 2024, 0),
    ("root", {"data": {**B, "smallarea_status": "1"}}, 2025, 1),
    ("text", {"data": json.dumps({"basicdata": B})}, 2025, 0),
]
BAD = [
    ("not json", "{oops"), ("no data", "{}"), ("unreadable text", json.dumps({"data": "{oops"})),
    ("empty list", json.dumps({"data": {"basicdata": []}})), ("all zero", json.dumps({"data": {"basicdata": {"Two-Bedroom": 0, "Efficiency": ""}}})),
    ("bad year", json.dumps({"data": {"year": "soon", "basicdata": B}})),
]


def test_fmr_shapes(spark):
    data = [(name, 2025, json.dumps(doc)) for name, doc, _, _ in SHAPES] + [(name, 2025, text) for name, text in BAD]
    got = {r.entity_id: r for r in fmr.parse(spark.createDataFrame(data, "entity_id string, requested_year int, payload string")).collect()}
    assert set(got) == {name for name, *_ in SHAPES}
    for name, _, year, flag in SHAPES:
        r = got[name]
        assert (r.fmr_0br, r.fmr_1br, r.fmr_2br, r.fmr_3br, r.fmr_4br) == (1000.0, 1100.56, 1300.0, None, None), name
        assert (r.fmr_year, r.smallarea_flag) == (year, flag), name
    assert got["list with metro row"].fmr_percentile == 40 and got["root"].metro_name == ""


def test_fmr_newest_usable_year(spark, rows):
    doc = lambda v: json.dumps({"data": {"basicdata": {"Two-Bedroom": v}}})
    late = json.dumps({"data": {"year": 2019, "basicdata": {"Two-Bedroom": 1600}}})
    data = [("METRO19100M19100", 2026, late), ("METRO19100M19100", 2025, doc(1)), ("METRO16980M16980", 2026, doc(0)), ("METRO16980M16980", 2025, doc(1500)), ("METRO16980M16980", 2024, doc(1400)), ("other", 2026, doc(1))]
    responses = spark.createDataFrame(data, "entity_id string, requested_year int, payload string")
    got = fmr.staged_fmr(responses, seeds.fmr_crosswalk(spark), date(2026, 5, 1))
    # The newest request with amounts wins, whatever year its answer carries.
    assert rows(got, "city", "fmr_year", "fmr_2br") == [("Chicago", 2025, 1500.0), ("Dallas", 2019, 1600.0)]
    assert rows(fmr.by_bedroom(got.filter("city = 'Chicago'"))) == [("METRO16980M16980", "Chicago", 2025, "fmr_2br", 1500.0)]


def test_pivot_drops_keys_without_any_value(spark, rows):
    long = spark.createDataFrame([(1, "a", None, 1), (1, "a", 2.0, 3), (1, "a", 3.0, 2), (2, "a", None, 1)], "k int, measure string, value double, o int")
    assert rows(pivot_measures(long, ["k"], ["a", "b"], "o")) == [(1, 3.0, None)]
