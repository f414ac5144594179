"""Run registered queries against their SQL on the same files and compare all values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def normal(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", None) if isinstance(v, float) and math.isnan(v) else ("n", float(v) + 0.0)
    if isinstance(v, dt.datetime):
        return ("t", v.isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return ("z",) if v is None else ("s", str(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def kind(type_name: str) -> str:
    t = type_name.lower()
    for k in ("bigint", "smallint", "int", "double", "decimal", "date", "string", "varchar", "bool"):
        if t.startswith(k) or (k == "int" and t == "integer"):
            return {"varchar": "string"}.get(k, k)
    return {"long": "bigint"}.get(t, t)


def compare(spark, con, name, query, sql, sf):
    """None when equal, else a description of the difference."""
    df = query(spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    types = {d[0]: kind(str(d[1])) for d in res.description}
    want = rows_of(names, res.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    mine = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    off = {c: (mine[c], types[c]) for c in mine if mine[c] != types[c]}
    note = f"types differ: {off}" if off else None
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} / {len(want)} rows, {len(a)} / {len(b)} unmatched; {sorted(a)[:2]} / {sorted(b)[:2]} {note or ''}"
    if not got:
        return "no rows"
    return note


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from hearth.session import build

    sf = sys.argv[1] if "/" in sys.argv[1] else f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    extra = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    spark = build("local[8]", **extra)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sqls = entry.oracle_sql()
    bad = 0
    for name, q in entry.queries().items():
        if wanted and name not in wanted:
            continue
        t0 = time.time()
        try:
            diff = compare(spark, con, name, q, sqls[name], sf) if name in sqls else f"no SQL, {q(spark, sf).count()} rows"
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{name:28s} {time.time() - t0:6.1f}s  {diff or 'ok'}", flush=True)
    print("differences:", bad)
