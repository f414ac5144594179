"""Joins by time and ranking, against brute force on random small data."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from hearth.operators import lookup
from hearth.operators.ranking import rank_desc


def random_case(seed, hot=False):
    """Spine and source rows; with ``hot`` most of them belong to one key."""
    rnd = random.Random(seed)
    key = lambda: 0 if hot and rnd.random() < 0.7 else rnd.randrange(4)
    spine = [(i, key(), rnd.randrange(12)) for i in range(80)]
    src = {(key(), rnd.randrange(10)): rnd.choice([None, rnd.randrange(100)]) for _ in range(20)}
    return spine, [(k, t, v, None if v is None else v + 0.5) for (k, t), v in src.items()]


def frames(spark, spine, src):
    return (
        spark.createDataFrame(spine, "i int, k int, t int"),
        spark.createDataFrame(src, "k int, t int, v int, w double"),
    )


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True), (3, True)])
def test_exact_or_latest(spark, seed, hot):
    spine, src = random_case(seed, hot)
    got = lookup.exact_or_latest(*frames(spark, spine, src), ["k"], "t", ["v", "w"])
    at = {(k, t): (v, w) for k, t, v, w in src}
    last = {}
    for k in {s[0] for s in src}:
        last[k] = max([(t, (v, w)) for kk, t, v, w in src if kk == k], key=lambda x: x[0])[1]
    want = []
    for i, k, t in spine:
        e, l = at.get((k, t), (None, None)), last.get(k, (None, None))
        want.append((i, k, t, *[a if a is not None else b for a, b in zip(e, l)]))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want


def test_exact_match_is_never_changed_by_the_fallback(spark):
    spine, src = random_case(5)
    s, x = frames(spark, spine, src)
    out = lookup.exact_or_latest(s, x, ["k"], "t", ["v"])
    both = out.withColumnRenamed("v", "got").join(x, ["k", "t"]).filter(F.col("v").isNotNull())
    assert both.count() > 0 and both.filter("got <> v").count() == 0


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True), (4, True)])
def test_asof_left(spark, seed, hot):
    spine, src = random_case(seed, hot)
    s, x = frames(spark, spine, src)
    got = lookup.asof_left(s, x.withColumnRenamed("t", "since"), ["k"], "t", "since", ["v", "w"])
    want = []
    for i, k, t in spine:
        past = [r for r in src if r[0] == k and r[1] <= t]
        want.append((i, k, t, *(max(past, key=lambda r: r[1])[2:] if past else (None, None))))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want


def test_scalar_fallback_keeps_rows_without_any_source(spark):
    s = spark.createDataFrame([(1, 5), (2, 6)], "i int, t int")
    src = spark.createDataFrame([(5, 1.0), (4, 9.0)], "t int, r double")
    got = lookup.exact_or_latest_scalar(s, src, "t", "r").orderBy("i").collect()
    assert [(r.i, r.r) for r in got] == [(1, 1.0), (2, 1.0)]
    none = lookup.exact_or_latest_scalar(s, src.filter("t > 100"), "t", "r").orderBy("i").collect()
    assert [(r.i, r.r) for r in none] == [(1, None), (2, None)]


def test_latest_rows_keeps_ties_and_drops_null_keys(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", date(2020, 1, 1), 1), (1, "a", date(2020, 2, 1), 2), (1, "a", date(2020, 2, 1), 3), (1, None, date(2021, 1, 1), 4), (2, "a", None, 5)],
        "k int, b string, d date, v int",
    )
    assert rows(lookup.latest_rows(df, ["k", "b"], "d"), "v") == [(2,), (3,), (5,)]


def test_prior_by_period_not_by_row(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 13, 12.0), (1, 14, 13.0), (1, 26, 20.0), (2, 13, 7.0)], "k int, m int, v double")
    got = {(r.k, r.m): (r.v, r.p) for r in lookup.with_prior(df, ["k"], "m", 12, "v", "p").collect()}
    assert got == {(1, 1): (10.0, None), (1, 13): (12.0, 10.0), (1, 14): (13.0, None), (1, 26): (20.0, 13.0), (2, 13): (7.0, None)}


@pytest.mark.parametrize("seed", [1, 2])
def test_rank_with_ties_and_nulls(spark, seed):
    rnd = random.Random(seed)
    data = [(i, rnd.choice([None, 1.0, 2.5, 2.5, 7.25, -3.0])) for i in range(60)]
    got = {r.i: r.r for r in rank_desc(spark.createDataFrame(data, "i int, s double"), "s", "r").collect()}
    real = [s for _, s in data if s is not None]
    want = {i: (1 + len(real) if s is None else 1 + sum(x > s for x in real)) for i, s in data}
    assert got == want


def test_first_and_latest_per_key(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 9, "z")], "k int, o int, v string")
    assert rows(lookup.latest_per_key(df, ["k"], "o", ["v", "o"])) == [(1, "c", 3), (2, "z", 9)]
    assert rows(lookup.first_per_key(df, ["k"], "o", ["v"])) == [(1, "a"), (2, "z")]


def test_ranks_and_row_numbers_without_a_global_window(spark):
    from pyspark.sql import functions as F

    from hearth.operators.ranking import number_rows, rank_desc

    values = [(i, None if i % 11 == 0 else 7.5 if i % 3 == 0 else i % 40 / 4) for i in range(500)]
    df = spark.createDataFrame(values, "id bigint, score double").repartition(6)
    got = {r.id: r.place for r in rank_desc(df, "score", "place").collect()}
    worse = lambda a, b: a is not None and (b is None or a > b)
    assert got == {i: 1 + sum(worse(w, v) for _, w in values) for i, v in values}
    numbered = number_rows(df, [F.desc_nulls_last("score"), F.asc("id")], "n")
    order = sorted(values, key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
    assert {r.id: r.n for r in numbered.collect()} == {i: n for n, (i, _) in enumerate(order, 1)}
    plan = rank_desc(df, "score", "place")._jdf.queryExecution().optimizedPlan().toString() + numbered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 2 and plan.count("windowspecdefinition(__part") == 2
    assert number_rows(df.limit(0), [F.asc("id")], "n").count() == 0


def test_discarded_tables_are_deleted(spark, tmp_path):
    from pathlib import Path

    from hearth.session import discard, materialize

    kept, gone = materialize(spark.range(3), "kept"), materialize(spark.range(4), "gone")
    folder = Path(gone._scratch)
    assert folder.exists()
    discard(gone, gone, spark.range(2))  # a second time and another frame: nothing happens
    assert not folder.exists() and kept.count() == 3


def test_all_sources_as_of_at_once(spark, rows):
    import random
    from datetime import date

    from pyspark.sql import functions as F

    rng = random.Random(4)
    month = lambda: date(2000 + rng.randrange(4), rng.randrange(1, 13), 1)
    spine = [(1 if i % 3 == 0 else rng.choice([1, 2, 3, None]), month(), i) for i in range(300)]
    first = list({(k, m): (k, m, rng.choice([None, 1.5, 2.5])) for k, m in ((rng.choice([1, 2, 9]), month()) for _ in range(30))}.values())
    second = list({(k, m): (k, m, f"s{j}", j) for j, (k, m) in enumerate((rng.choice([1, 3, None]), month()) for _ in range(30))}.values())
    df = spark.createDataFrame(spine, "k int, at date, id int")
    a = spark.createDataFrame(first, "k int, since date, x double")
    b = spark.createDataFrame(second, "k int, since date, y string, z int")
    got = lookup.asof_all(df, ["k"], "at", [(a, "since", ["x"]), (b, "since", ["y", "z"])], "id")
    one = lookup.asof_left(lookup.asof_left(df, a, ["k"], "at", "since", ["x"]), b, ["k"], "at", "since", ["y", "z"])
    assert got.columns == one.columns == ["k", "at", "id", "x", "y", "z"] and rows(got) == rows(one)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == 1 and "Join" not in plan
    shares = df.select("k", F.pmod(F.xxhash64("id"), F.lit(8)).alias("s")).where("k = 1").groupBy("s").count().collect()
    assert len(shares) == 8  # a hot key is dealt over several groups
