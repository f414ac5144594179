"""A warehouse goes from one whole set of tables to the next, wherever a run is cut off."""

import json
import os
from datetime import date
from pathlib import Path

import pytest

from hearth.operators import versions
from hearth.plans import refresh
from landing_files import land


def content(spark, warehouse):
    return {n: sorted(tuple(r) for r in versions.read(spark, warehouse, n).collect()) for n in versions.current(spark, warehouse)[1]}


def files_of(spark, warehouse, name):
    return {f: (p.stat().st_mtime_ns, p.stat().st_size) for d in versions.current(spark, warehouse)[1][name] for p in Path(warehouse, d).glob("*.parquet") for f in [str(p)]}


class Cut(Exception):
    pass


def test_a_cut_at_every_step_leaves_the_old_or_the_new_set(spark, tmp_path):
    wh = str(tmp_path / "wh")
    table = lambda n: spark.range(n).selectExpr("id", "id % 3 AS part")
    first = versions.begin(spark, wh)
    first.write("a", table(5))
    first.merge("b", table(6), ["id", "part"], "part")
    first.commit()
    old = content(spark, wh)

    def attempt(steps):
        draft = versions.begin(spark, wh)
        actions = [
            lambda: draft.write("a", versions.read(spark, wh, "a").where("id > 1")),  # reads what it replaces
            lambda: draft.merge("b", table(9).where("part = 1"), ["id", "part"], "part"),
            lambda: draft.write("c", table(2)),
            draft.commit,
        ]
        for act in actions[:steps]:
            act()

    for steps in range(4):
        attempt(steps)  # the run ends here
        assert content(spark, wh) == old and versions.current(spark, wh)[0] == 1
    attempt(4)
    new = content(spark, wh)
    assert versions.current(spark, wh)[0] == 2 and len(new["a"]) == 3 and len(new["b"]) == 7 and len(new["c"]) == 2
    gone = versions.prune(spark, wh, keep=1)
    assert content(spark, wh) == new and len(gone) >= 4 and versions.prune(spark, wh, keep=1) == []


def test_a_half_written_manifest_does_not_count(spark, tmp_path):
    wh = str(tmp_path / "wh")
    versions.replace(spark, wh, {"a": spark.range(3)})
    (tmp_path / "wh" / "versions" / "_temporary").mkdir()
    (tmp_path / "wh" / "versions" / "_temporary" / "part-0.json").write_text(json.dumps({"version": 9, "tables": {}}))
    assert versions.current(spark, wh)[0] == 1
    with pytest.raises(FileNotFoundError):
        versions.read(spark, wh, "other")


def test_merge_leaves_untouched_partitions_as_they_are(spark, tmp_path):
    wh = str(tmp_path / "wh")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, y int, v int")
    for part in (rows(("a", 2001, 1), ("b", 2002, 2), ("c", None, 3)), rows(("b", 2002, 20), ("d", 2002, 4), ("e", 2003, 5))):
        before = files_of(spark, wh, "t") if versions.current(spark, wh)[0] else {}
        draft = versions.begin(spark, wh)
        draft.merge("t", part, ["k", "y"], "y")
        draft.commit()
    after = files_of(spark, wh, "t")
    kept = {f: x for f, x in before.items() if "y_part=2002" not in f}
    assert len(kept) == 2 and kept.items() <= after.items() and not any("y_part=2002" in f for f in before.keys() & after.keys())
    got = sorted((r.k, r.y, r.v) for r in versions.read(spark, wh, "t").collect())
    assert got == [("a", 2001, 1), ("b", 2002, 20), ("c", None, 3), ("d", 2002, 4), ("e", 2003, 5)]
    assert draft.rows["t"] == 3  # of the touched partitions


@pytest.mark.parametrize("step", ["load labor", "table fact_rent", "table fact_hud_fmr", "table affordability_final", "publish"])
def test_a_refresh_that_fails_anywhere_changes_nothing(spark, tmp_path, step, monkeypatch):
    land(tmp_path / "landing")
    wh = str(tmp_path / "wh")
    kept = versions.replace(spark, wh, {"fact_rent": spark.range(2), "own": spark.range(1)})
    assert len(kept) == 2
    run = refresh.Steps.run

    def cut(self, name, act):
        if name != step:
            return run(self, name, act)

        def fails():
            raise Cut(name)

        return run(self, name, fails)

    monkeypatch.setattr(refresh.Steps, "run", cut)
    steps, out = refresh.run(spark, str(tmp_path / "landing"), wh, date(2026, 5, 1))
    status = out["status"].orderBy("step_no").collect()
    at = [r.step for r in status].index(step)
    assert {r.status for r in status[:at]} <= {"PASSED"} and status[at].status == "FAILED" and {r.status for r in status[at + 1 :]} <= {"SKIPPED"}
    assert status[-1].step == "publish" and isinstance(steps.error, Cut)
    assert versions.current(spark, wh)[0] == 1 and versions.read(spark, wh, "fact_rent").count() == 2
    assert os.path.isdir(wh)
