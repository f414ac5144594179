"""What the optimizer makes of the operators."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hearth.operators import lookup
from hearth.sources import fmr, wide
from hearth.twin import queries as q
from hearth.twin import tables as t

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_python_workers_and_no_pairwise_joins(spark):
    for name in ["affordability_metrics", "city_compare", "like_join", "scenario_payment", "rate_sensitivity", "relocation_savings", "coverage_anti"]:
        text = plan(q.REGISTRY[name](spark, SF))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
            assert bad not in text, (name, bad)


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(q.filter_since(spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    scan = [x for x in plan(t.home(spark, SF)).splitlines() if "l_shipdate" in x and "FileScan" in x]
    assert len(scan) == 1 and "l_discount" not in scan[0] and "l_tax" not in scan[0]
    assert "PushedFilters: [IsNotNull(l_suppkey)" in plan(t.labor(spark, SF)) or "IsNotNull(l_orderkey)" in plan(t.labor(spark, SF))


def test_metro_filter_below_the_unpivot(spark):
    table = spark.createDataFrame([("a", "1", "2")], "RegionName string, `2020-01-01` string, `2014-01-01` string")
    cross = spark.createDataFrame([("a", "A")], "source_key string, city_display string")
    text = optimized(wide.long_series(table, cross, "v"))
    assert text.index("Expand") < text.index("LeftSemi")
    assert "2014-01-01" not in text.split("LeftSemi")[0]  # months before the cutoff are not expanded


def test_documents_are_parsed_once(spark):
    docs = spark.createDataFrame([("a", 2020, "{}")], "entity_id string, requested_year int, payload string")
    assert optimized(fmr.parse(docs)).lower().count("parsejson") == 2  # the document, and `data` when it is text


def test_latest_rows_are_cut_before_the_shuffle(spark):
    df = t.read(spark, SF, "orders").select("o_custkey", "o_orderdate")
    text = plan(lookup.latest_rows(df, ["o_custkey"], "o_orderdate"))
    assert text.count("WindowGroupLimit") == 2


def test_prior_year_takes_one_scan_and_one_shuffle(spark):
    df = t.read(spark, SF, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_totalprice")
    text = plan(lookup.with_prior(df, ["o_custkey"], "y", 1, "o_totalprice", "p"))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_fallback_join_shares_the_source(spark):
    src = t.home(spark, SF).select("geo_id", "full_date", "median_home_price")
    spine = t.rent(spark, SF).select("geo_id", "full_date")
    df = lookup.exact_or_latest(spine, src, ["geo_id"], "full_date", ["median_home_price"])
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("l_extendedprice") > 0
    assert final.count("FileScan parquet [l_suppkey") <= 1


def test_entry_points(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "city_display"
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_hot_key_is_split(spark):
    """A third of the rows share one key; the join on it is divided over tasks and stays complete."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        spine = spark.range(0, 300000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50000).cast("int").alias("k"), (F.col("id") % 5).alias("t"), "id"
        )
        src = spark.range(50000).select(F.col("id").cast("int").alias("k"), (F.col("id") % 5).alias("t"), (F.col("id") * 2).alias("v"))
        df = lookup.exact_or_latest(spine, src, ["k"], "t", ["v"])
        out = df.agg(F.count("*").alias("n"), F.sum((F.col("v") == F.col("k") * 2).cast("int")).alias("ok"), F.count_distinct("id").alias("ids"))
        assert tuple(out.first()) == (300000, 300000, 300000)
        df = df.groupBy("t").agg(F.sum("v").alias("v"), F.max("id").alias("id"))
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        joins = [line for line in final.splitlines() if "SortMergeJoin" in line]
        assert len(joins) == 2 and all("skew=true" in line for line in joins), final
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sources_that_nobody_asks_for_are_not_read(spark):
    for name, absent in {"scenario_rent_burden": ["l_shipdate", "o_totalprice#0"], "rate_sensitivity": ["l_returnflag"], "scenario_payment": ["unemployment_rate"]}.items():
        text = optimized(q.REGISTRY[name](spark, SF))
        assert not any(a in text for a in absent), name
    from hearth.plans.metrics import sources_of

    assert sources_of(["annual_rent"]) == set() and sources_of(["est_monthly_mortgage"]) == {"home", "rates"} and len(sources_of(None)) == 4
    some, all_ = q.metrics(spark, SF, ["median_home_price"]), q.metrics(spark, SF)
    assert some.columns and set(some.columns) == set(all_.columns)
    pick = lambda df: sorted(tuple(r) for r in df.select("geo_id", "full_date", "bedroom_type", "median_home_price").collect())
    assert pick(some) == pick(all_)


def test_calendar_filters_prune_the_years_of_a_stored_fact(spark, tmp_path):
    from hearth.operators import versions
    from hearth.plans import conform, dims

    geo = t.geography(spark, SF)
    facts = conform.fact_rent(q.staged_rent(spark, SF), t.listing(geo), geo)
    draft = versions.begin(spark, str(tmp_path))
    assert draft.write("fact_rent", conform.by_year(facts), part=[conform.YEAR]).columns == facts.columns
    draft.commit()
    stored = versions.read(spark, str(tmp_path), "fact_rent", stored=True)
    calendar = dims.date_spine(spark, *t.span(spark, SF))
    joined = conform.star_join(stored, geo, calendar.where("year = 1996 AND quarter = 2"))
    assert "dynamicpruning" in plan(joined).lower() or "PartitionFilters: [isnotnull(year_part" in plan(joined)
    same = conform.star_join(facts, geo, calendar).where("year = 1996 AND quarter = 2")
    assert sorted(joined.columns) == sorted(same.columns)
    key = lambda df: sorted((r.geo_id, r.date_id, r.bedroom_type, r.monthly_rent) for r in df.collect())
    assert key(joined) == key(same) and joined.count() > 0


def test_entry_survives_a_missing_package_of_an_optional_module(monkeypatch):
    import sys
    import warnings

    for name in [n for n in sys.modules if n.startswith("hearth.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)  # as if it were not installed
    with warnings.catch_warnings(record=True):
        warnings.simplefilter("always")
        left = entry.queries()
    assert set(left) == set(q.REGISTRY) and set(entry.oracle_sql()) <= set(left)
