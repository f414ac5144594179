"""Landed files for all 25 metros."""

import json
from datetime import date

from hearth import seeds

YEARS = (2018, 2019, 2020)


def months():
    return [date(y, m, 1) for y in YEARS for m in range(1, 13)]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def wide_csv(base, step):
    head = "RegionID,SizeRank,RegionName,RegionType,StateName," + ",".join(str(d) for d in months())
    lines = [
        f'{i},{i},"{seeds.listing_name(m[2], m[3])}",msa,{m[3]},' + ",".join(str(base * i + step * k) for k, _ in enumerate(months()))
        for i, m in enumerate(seeds.METROS, start=1)
    ]
    return "\n".join([head, *lines, '0,0,United States,country,,' + ",".join("1" for _ in months())])


def series_doc(pairs):
    data = lambda f: [{"year": str(d.year), "period": f"M{d.month:02d}", "value": str(f(d))} for d in months()]
    return json.dumps({"status": "REQUEST_SUCCEEDED", "message": [], "Results": {"series": [{"seriesID": s, "data": data(f)} for s, f in pairs]}})


def land(root):
    write(root / "rent" / "Metro_zori.csv", wide_csv(100, 1))
    write(root / "home" / "Metro_zhvi_x.csv", wide_csv(20000, 100))
    write(root / "rates" / "rates.csv", "d,r\n" + "\n".join(f"{d},6.5" for d in months()))
    for y in YEARS:
        rows = [[f"{m[1]} Metro Area", str(40000 + 1000 * m[0] + 500 * (y - 2018)), "30000", "1000000", m[8]] for m in seeds.METROS]
        write(root / "income" / f"{y}.json", json.dumps([["NAME", "B19013_001E", "B19301_001E", "B01003_001E", "statistical area"], *rows]))
    code = lambda m, measure: f"LAUMT{m[7]}{m[8]}000000{measure}"
    pairs = [(code(m, "03"), lambda d, i=m[0]: 3 + i / 10) for m in seeds.METROS] + [(code(m, "05"), lambda d: 1000) for m in seeds.METROS]
    write(root / "labor" / "2015-2019" / "a.json", series_doc(pairs[:25]))
    write(root / "labor" / "2020-2025" / "a.json", series_doc(pairs[25:]))
    write(root / "cpi" / "2015-2019" / "a.json", series_doc([(s, lambda d: 250.5) for s in dict(seeds.CPI_SERIES)]))
    docs = [
        json.dumps({"entity_id": m[9], "requested_year": y, "payload": json.dumps({"data": {"basicdata": {"Two-Bedroom": 1000 + m[0]}}})})
        for m in seeds.METROS for y in (2025, 2026)
    ]
    write(root / "fmr" / "a.json", "\n".join(docs))
