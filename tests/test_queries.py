"""Registered queries against their SQL, on the smallest data set.

A run covers one query of every kind; HEARTH_ALL_QUERIES=1 covers all of them.
"""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"
CORE = [
    "src_wide_rent", "src_rate_json", "src_multi_year_union", "src_labor_json", "fmr_newest_year", "dim_date", "dim_scenario",
    "fact_rent", "fact_income", "fact_cpi", "like_join", "upsert_fmr", "quarantine_rows", "affordability_final", "publish_gate",
    "clean_int", "affordability_metrics", "metrics_exact", "metrics_asof", "latest_snapshot", "city_compare", "dq_unique",
    "city_classification", "affordability_zscore", "rent_yoy", "growth_gap_by_year", "pressure_ranking", "scenario_payment",
    "relocation_savings",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("HEARTH_ALL_QUERIES") else CORE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF) is None


def test_every_query_has_its_sql():
    from hearth.twin.queries import REGISTRY

    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())
