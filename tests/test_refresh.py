"""The whole refresh on landed files for all 25 metros."""

import json
from datetime import date

import pytest

from hearth import seeds
from hearth.operators import versions
from hearth.plans import refresh
from landing_files import land, series_doc, write

@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("refresh")
    land(root / "landing")
    return root, refresh.build_all(spark, str(root / "landing"), str(root / "wh"), date(2026, 5, 1))


def test_row_counts(built):
    _, t = built
    n = {k: v.count() for k, v in t.items()}
    listed = {r.table_name: r.row_count for r in t["row_counts"].collect()}
    assert listed["staging.rent"] == 900 and listed["staging.labor"] == 900 and listed["fact_cpi"] == n["fact_cpi"]
    assert n["fact_rent"] == n["fact_home_prices"] == n["fact_labor"] == n["metrics"] == 25 * 36
    assert n["fact_income"] == 75 and n["fact_mortgage_rates"] == 36 and n["fact_hud_fmr"] == 25
    assert n["fact_cpi"] == 26 * 36 and n["dim_date"] == 4383 and n["dim_geography"] == 25 and n["dim_scenario"] == 7


def test_published(spark, built):
    root, t = built
    assert {r.status for r in t["status"].collect()} == {"PASSED"}
    final = versions.read(spark, str(root / "wh"), "affordability_final")
    assert final.count() == 900
    r = final.filter("geo_id = 10 and full_date = DATE'2020-01-01'").first()
    assert float(r.monthly_rent) == 1024.0 and r.income_year == 2020 and float(r.median_household_income) == 51000.0
    assert r.rent_to_income_ratio == round(1024 * 12 / 51000, 4) and r.rent_growth_yoy == round(12 / 1012, 4)
    assert float(r.unemployment_rate) == 4.0 and r.city_classification is not None and r.pressure_score > 0


def test_views_answer_sql(spark, built):
    assert spark.sql("SELECT COUNT(*) FROM vw_latest_snapshot").first()[0] == 25
    got = spark.sql("SELECT city_classification, COUNT(*) AS n FROM vw_city_classification GROUP BY 1").collect()
    assert sum(r.n for r in got) == 25
    joined = spark.sql("SELECT COUNT(*) FROM fact_rent r JOIN dim_geography g ON g.geo_id = r.geo_id JOIN dim_date d ON d.date_id = r.date_id")
    assert joined.first()[0] == 900


def test_second_refresh_changes_nothing_and_keeps_old_rents(spark, built):
    root, _ = built
    docs = [json.dumps({"entity_id": m[9], "requested_year": 2027, "payload": json.dumps({"data": {"basicdata": {"Two-Bedroom": 1}}})}) for m in seeds.METROS]
    write(root / "landing" / "fmr" / "a.json", "\n".join(docs))
    before = versions.read(spark, str(root / "wh"), "affordability_final").toPandas()
    again = refresh.build_all(spark, str(root / "landing"), str(root / "wh"), date(2026, 6, 1))
    assert again["fact_hud_fmr"].count() == 50
    after = versions.read(spark, str(root / "wh"), "affordability_final").toPandas()
    key = ["geo_id", "full_date", "bedroom_type"]
    assert before.sort_values(key).reset_index(drop=True).equals(after.sort_values(key).reset_index(drop=True))


def test_missing_source_stops_the_refresh(spark, tmp_path):
    land(tmp_path / "landing")
    (tmp_path / "landing" / "rent" / "Metro_zori.csv").rename(tmp_path / "landing" / "rent" / "other.txt")
    with pytest.raises(FileNotFoundError):
        refresh.build_all(spark, str(tmp_path / "landing"), str(tmp_path / "wh"), date(2026, 5, 1))
    assert versions.current(spark, str(tmp_path / "wh")) == (0, {})


def test_landed_years_and_windows_all_count(spark, tmp_path):
    land(tmp_path / "landing")
    rows = [[f"{m[1]} Metro Area", "70000", "30000", "1000000", m[8]] for m in seeds.METROS[1:]]
    write(tmp_path / "landing" / "income" / "2031.json", json.dumps([["NAME", "B19013_001E", "B19301_001E", "B01003_001E", "statistical area"], *rows]))
    late = {"seriesID": f"LAUMT{seeds.METROS[0][7]}{seeds.METROS[0][8]}00000003", "data": [{"year": "2026", "period": "M01", "value": "4.5"}]}
    write(tmp_path / "landing" / "labor" / "2026-2030" / "a.json", json.dumps({"status": "REQUEST_SUCCEEDED", "message": [], "Results": {"series": [late]}}))
    staged = refresh.stage(spark, str(tmp_path / "landing"), date(2026, 5, 1))
    assert staged["income"].agg({"survey_year": "max"}).first()[0] == 2031
    assert staged["labor"].where("report_date = DATE'2026-01-01'").count() == 1


def test_empty_source_leaves_staging_as_it_was(spark, built, tmp_path):
    root, _ = built
    before = versions.read(spark, str(root / "wh"), "staging/rent").count()
    land(tmp_path / "landing")
    write(tmp_path / "landing" / "rent" / "Metro_zori.csv", "RegionID,SizeRank,RegionName,RegionType,StateName,2020-01-01\n0,0,Nowhere,msa,XX,1")
    with pytest.raises(ValueError, match="no rows"):
        refresh.build_all(spark, str(tmp_path / "landing"), str(root / "wh"), date(2026, 5, 1))
    assert versions.read(spark, str(root / "wh"), "staging/rent").count() == before == 900


def test_a_repeated_month_fails_the_gate(spark, built):
    from hearth.plans import publish

    root, t = built
    t = {k: versions.read(spark, str(root / "wh"), k) for k in t if k.startswith(("fact_", "dim_"))}  # as the last refresh left them
    twice = t["fact_mortgage_rates"].union(t["fact_mortgage_rates"].selectExpr("date_id + 7", "rate_30yr_fixed", "data_source"))
    checks = publish.standard_checks({**t, "fact_mortgage_rates": twice}, t["dim_geography"], t["dim_date"])
    assert checks["one row a month in fact_mortgage_rates"].count() == 36 and checks["one row a month in fact_labor"].isEmpty()


def test_unreadable_files_are_skipped_and_named(spark, tmp_path):
    root = tmp_path / "landing"
    land(root)
    write(root / "labor" / "2026-2030" / "cut.json", series_doc([("x", lambda d: 1)])[:200])  # a window broken off
    write(root / "rates" / "observations.json", '{"observations": [{"date": "2018-')
    write(root / "rent" / "Metro_zori.csv", "no,months\n1,2")  # the first candidate cannot be read, the next one is
    write(root / "rent" / "Metro_zori_2.csv", (root / "home" / "Metro_zhvi_x.csv").read_text())
    write(root / "income" / "2021.json", "[[")
    out = refresh.build_all(spark, str(root), str(tmp_path / "wh"), date(2026, 5, 1))
    passed = {(r.source, r.file.rsplit("/", 1)[-1], r.reason.split(":")[0]) for r in out["skipped"].collect()}
    assert passed == {
        ("home_prices", "Metro_zhvi.csv", "absent"), ("income", "2021", "unreadable"), ("labor", "cut.json", "unreadable"),
        ("mortgage_rates", "observations.json", "unreadable"), ("rent", "Metro_zori.csv", "unreadable"),
    }
    assert versions.read(spark, str(tmp_path / "wh"), "fact_labor").count() == 900 and {r.status for r in out["status"].collect()} == {"PASSED"}


def test_wide_files_are_united_by_their_headers(spark, tmp_path, rows):
    from hearth.sources import wide

    name = seeds.listing_name(seeds.METROS[0][2], seeds.METROS[0][3])
    head = "RegionID,SizeRank,RegionName,RegionType,StateName,"
    write(tmp_path / "Metro_zori_1.csv", f'{head}2020-01-01,2020-02-01\n1,1,"{name}",msa,X,100,200')
    write(tmp_path / "Metro_zori_2.csv", f'{head}2020-03-01,2020-02-01\n1,1,"{name}",msa,X,300,250')
    write(tmp_path / "Metro_zori_3.csv", f'{head}2020-02-01\n1,1,"{name}",msa,X,')
    write(tmp_path / "Metro_zori_4.csv", "nothing,here\n1,2")
    skipped = []
    raw = wide.read_wide(spark, [f"{tmp_path}/Metro_zori.csv", f"{tmp_path}/Metro_zori_*.csv"], skipped)
    got = wide.staged_rent(raw, seeds.listing_crosswalk(spark))
    assert rows(got, "report_date", "monthly_rent") == [(date(2020, 1, 1), 100.0), (date(2020, 2, 1), 250.0), (date(2020, 3, 1), 300.0)]
    assert [(f.rsplit("/", 1)[1], r.split(":")[0]) for f, r in skipped] == [("Metro_zori_4.csv", "unreadable"), ("Metro_zori.csv", "absent")]


def test_every_metro_without_rows_is_named(spark, built):
    _, t = built
    assert t["missing_metros"].count() == 0
    gaps = refresh.missing_metros({**t, "fact_labor": t["fact_labor"].where("geo_id > 2")})
    assert sorted((r.table_name, r.geo_id) for r in gaps.collect()) == [("fact_labor", 1), ("fact_labor", 2)]
