"""Every operator on odd rows (nulls, empty and long texts, ties, repeated rows, clashing columns, no rows) and against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from hearth.llm import bpe, html, licenses, lines, neighbours, packing, quality, queries, sharding, simhash, suffixes
from hearth.llm.common import components

PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i % 997}x{i}" for i in range(20000))
CLEAN = "The quick brown fox jumps over a lazy dog while seven other animals watch from a hill. " * 3
ODD = [
    (None, None), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, LONG), (6, LONG), (7, CLEAN), (7, CLEAN), (7, "other text of that id"),
    (None, CLEAN), (8, "é" * 50), (9, "A line of text that repeats.\nA line of text that repeats.\nAnd one that does not."),
]
SCHEMA = "doc_id bigint, text string, ids int, spans string, h double, row int, n_words int, dups int, kept int, r string, `a b` int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 1, "s", 0.5, 2, 3, 4, 5, "r", 6) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_quality_measures_and_verdict(odd, none):
    got = quality.assess(odd.select("doc_id", "text")).collect()
    assert len(got) == len(ODD)
    for r in got:
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        at = collections.defaultdict(list)
        for i in range(len(w) - 2):
            at[tuple(w[i : i + 3])].append(i)
        again = {j for v in at.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
        ls = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(ls) - len(set(ls)), len(again))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert not (r.base_failed and r.kept)
    kept = quality.keep(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [5, 6]
    assert quality.keep(none).count() == 0


def test_quality_order_is_by_rejection_per_cost(spark):
    docs = spark.createDataFrame([(f"w{i} " * 60,) for i in range(40)], "text string")
    rules = quality.base_rules()
    order = quality.plan(docs, "text", rules)
    assert sorted(order) == sorted(rules) and order[0] == "repeated_words"  # the other rejects nothing here


def test_packing_round_trip(odd, none, library):
    docs = odd.repartition(5)
    rows = packing.pack(docs, packing.tokens(PATH, 2), window=64, open_windows=3, fan_in=2).collect()
    seq = collections.defaultdict(list)
    for r in rows:
        assert r.length * 4 == len(r.ids) and r.length > 0
        seq[r.sequence_id].append(r)
    for v in seq.values():
        v.sort(key=lambda r: r.offset)
        assert [r.offset for r in v] == np.cumsum([0, *(r.length for r in v[:-1])]).tolist()
        n = sum(r.length for r in v)
        assert n == 64 or (n < 64 and n & (n - 1) == 0)
    count = lambda it: collections.Counter(it)
    want = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in ODD]
    assert count((r.doc_id, x) for r in rows for x in np.frombuffer(r.ids, "<u4").tolist()) == count((i, x) for i, ids in want for x in ids)
    for i, ids in want:
        if i not in (7, None):
            pieces = sorted((r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows if r.doc_id == i)
            assert [x for _, p in pieces for x in p] == ids
    assert packing.pack(none, packing.tokens(PATH, 2)).count() == 0


def test_encode_and_decode(odd, none, library):
    both = bpe.decode(bpe.encode(odd, PATH), PATH)
    for r in both.select("text", "ids", "decoded").collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(none, PATH), PATH).count() == 0


def test_shards(spark):
    rng = random.Random(1)
    rows = [(None if i % 17 == 0 else 5 if i % 3 == 0 else i, rng.choice([1, 10, 50, 900]), "x") for i in range(2000)]  # a third has one key
    got = sharding.shard(spark.createDataFrame(rows, "k bigint, size bigint, shard_ string"), 8, "k", "size").collect()
    assert collections.Counter((r.k, r["size"]) for r in got) == collections.Counter((k, s) for k, s, _ in rows)
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert set(size) == set(range(8)) and max(size.values()) - min(size.values()) <= 1800
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard(spark.createDataFrame([], "k bigint, size bigint"), 8, "k", "size").count() == 0
    one = sharding.shard(spark.createDataFrame([(3, 7)], "k bigint, size bigint"), 8, "k", "size").collect()
    assert [(r.k, r.slot) for r in one] == [(3, 0)]


@pytest.mark.parametrize("limit", [64, 2])
def test_simhash_links(spark, limit):
    rng = random.Random(7)
    fps = {0, -1}
    for _ in range(60):
        f = rng.getrandbits(64)
        for _ in range(5):
            g = f
            for _ in range(rng.randint(0, 3)):
                g ^= 1 << rng.randrange(64)
            fps.add(g - (1 << 64) if g >> 63 else g)
    nodes = sorted(fps)
    parent = {f: f for f in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    found = simhash.links(spark.createDataFrame([(f,) for f in nodes], "fp bigint"), 2, limit)
    got = {r.node: r.root for r in components(found).collect()}
    assert {f: got.get(f, f) for f in nodes} == {f: root(f) for f in nodes}


def test_simhash_signatures_are_not_broadcast(spark, monkeypatch):
    """Spark sizes them as the fingerprints from which they were expanded; 256,410 documents gave a broadcast of 839 MB."""
    plans, write = {}, simhash.materialize

    def planned(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(simhash, "materialize", planned)
    nodes = spark.createDataFrame([(1 << i % 60 | 3,) for i in range(200)], "fp bigint").distinct()
    assert simhash.links(write(nodes, "test-nodes"), 2).count() > 0
    for name in ("simhash-filed", "simhash-pairs"):
        assert "SortMergeJoin" in plans[name] and "BroadcastExchange" not in plans[name], plans[name]


def test_simhash_on_odd_rows(odd, none):
    got = simhash.classes(odd).collect()
    assert len(got) == len(ODD)
    by = collections.defaultdict(set)
    for r in got:
        by[r.fp].add(r.component_id)
    assert all(len(v) == 1 for v in by.values()) and by[0] == {1}
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in kept.collect()) == [(1, ""), (4, "one"), (5, "w0x0 "), (7, "The q"), (7, "other"), (8, "é" * 5), (9, "A lin")]
    assert simhash.keep_first(none).count() == 0


def test_near_copies_go_in_the_pipeline(spark):
    """One document of every group that fingerprints of three-word shingles link at up to two bits, by comparing all pairs."""
    rng = random.Random(6)
    rows, base = [(900, None), (901, ""), (902, "one two"), (903, "ONE  two"), (None, "one two")], []
    for g in range(8):
        w = [f"w{rng.randrange(400)}" for _ in range(rng.choice([30, 200, 3000]))]
        for i in range(6):
            rows.append((10 * g + i, " ".join(w) if i < 2 else "\n".join(w).upper() if i == 2 else " ".join(w)))
            w = list(w)
            w[rng.randrange(len(w))] = f"x{rng.randrange(400)}"
    prints = {(i, t): simhash.fingerprint(t, 3) for i, t in rows}
    root = {k: k for k in prints}
    order = sorted(prints, key=lambda k: (k[0] is None, k[0] or 0))
    for x in order:
        for y in order:
            if root[x] != root[y] and ((prints[x] ^ prints[y]) & (1 << 64) - 1).bit_count() <= 2:
                keep, gone = sorted((root[x], root[y]), key=order.index)
                root = {k: keep if v == gone else v for k, v in root.items()}
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "").collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(set(root.values())) and 8 < len(got) < len(rows) - 10


def test_licenses(spark, none):
    mit = licenses.TEMPLATES["mit"].replace("merge, ", "fuse ")
    rows = [
        (1, "abc. All Rights   reserved!"), (2, "x y z " * 50 + "\nReleased under the MIT License.\n" + "foo bar " * 30), (3, None), (4, ""), (5, "all rights"),
        (6, "q " * 333 + mit + " z" * 77), (8, "this work was licensed under the gnu general public license version 3"), (1, "Released under the MIT License"), (None, "All rights reserved"),
    ]
    got = {(r.id, r.license, r.word) for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {x[:2] for x in got} == {(1, "all-rights-reserved"), (1, "mit-notice"), (2, "mit-notice"), (6, "mit"), (None, "all-rights-reserved")}
    assert licenses.scan(none).count() == 0


def test_license_matches_by_comparing_all_windows(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    cut = lambda t: re.findall(r"[^\W_]+", t.lower())
    docs = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 80)))]
        for name in rng.sample(sorted(licenses.TEMPLATES), 2):
            w = cut(licenses.TEMPLATES[name])
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = word()
            parts += [" ".join(w), " ".join(word() for _ in range(rng.randrange(0, 40)))]
        docs.append((i, "\n".join(parts)))
    docs += [(100, " ".join(word() for _ in range(30000)) + " " + licenses.TEMPLATES["isc"]), (101, None), (102, "")]
    want = set()
    for i, t in docs:
        w = cut(t or "")
        for name, text in licenses.TEMPLATES.items():
            own = cut(text)
            k = min(5, len(own))
            shingles = {tuple(own[j : j + k]) for j in range(len(own) - k + 1)}
            width, stride = licenses.size_class(len(shingles))
            grams = [tuple(w[j : j + k]) for j in range(len(w) - k + 1)]
            if any(len(shingles & set(grams[p : p + width])) >= 0.8 * len(shingles) for p in range(0, max(1, len(grams) - width + stride), stride)):
                want.add((i, name))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {(r.id, r.license) for r in licenses.scan(df).collect()} == want and len(want) > 60
    scans = licenses.scan(df)._jdf.queryExecution().optimizedPlan().toString()
    assert scans.count("LogicalRDD [doc_id") == 2  # one for the templates of a shingle or more, one for the shorter one


@pytest.mark.parametrize("threshold,limit", [(1, 2), (2, 512)])
def test_line_links(spark, threshold, limit):
    rng = random.Random(5)
    texts = {"".join(rng.choice("abc") for _ in range(12)) for _ in range(5)}
    for _ in range(90):
        x, i = list(rng.choice(sorted(texts))), rng.randrange(10)
        if rng.random() < 0.5:
            x[i] = rng.choice("abcdefg")
        elif rng.random() < 0.5:
            del x[i]
        else:
            x.insert(i, rng.choice("xyz"))
        texts.add("".join(x))
    texts = sorted(texts)
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if lines.within(texts[i], texts[j], threshold):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    found = lines.links(spark.createDataFrame(list(enumerate(texts)), "lid bigint, line string"), threshold, limit)
    got = {r.node: r.root for r in components(found).collect()}
    assert [got.get(i, i) for i in range(len(texts))] == [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("limit", [2, 512])
def test_every_line_link_is_within_the_threshold(spark, limit):
    texts = [f"Product {n}: add this line" for n in (12, 23, 24, 25, 42, 312, 7, 7012)]  # 12 and 23 share "Product 2", which is no line here
    found = lines.links(spark.createDataFrame(list(enumerate(texts)), "lid bigint, line string"), 1, limit).collect()
    assert all(lines.within(texts[r.a], texts[r.b], 1) for r in found)
    want = {frozenset((i, j)) for i in range(len(texts)) for j in range(i) if lines.within(texts[i], texts[j], 1)}
    got = {r.node: r.root for r in components(spark.createDataFrame([(r.a, r.b) for r in found], "a bigint, b bigint")).collect()}
    assert all(got[i] == got[j] for i, j in want)


def test_a_line_is_filed_and_looked_up_by_the_same_row(spark, monkeypatch):
    seen, plain = {}, lines.materialize

    def watched(df, name):
        out = plain(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(lines, "materialize", watched)
    rows = [(i, f"line number {i:03d} of some that differ") for i in range(50)]
    found = lines.links(spark.createDataFrame(rows, "lid bigint, line string"), 1)
    assert found.count() and seen["line-every"] == 4 * len(rows)  # two segments, and two of a line that is shorter by one


def test_equal_short_lines_are_repeats(spark):
    rows = [(1, "Les.\n\nA first line of that document."), (2, "Les.\n\nLet.\nThe other one has more text."), (3, " \n\n ")]
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.remove(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("\nLet.\nThe other one has more text.", 1), 3: (rows[2][1], 0)}


def test_lines_on_odd_rows(odd, none):
    got = lines.clean(odd)
    assert got.columns == odd.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert (9, "A line of text that repeats.\nAnd one that does not.") in kept
    assert (5, LONG) in kept and (6, LONG) not in kept and (None, None) in kept
    assert kept.count((7, CLEAN)) == 2  # repeated rows are one document
    assert lines.clean(none).count() == 0


def test_html_on_odd_pages(spark):
    pages = [(i, f"http://h{i % 2}.x/{i}", f"<div>Welcome to our site please enjoy your stay here today</div><p>number {i} of them</p>", "x", 1) for i in range(8)]
    pages += [(9, None, None, "x", 1), (10, "x", "", "x", 1), (None, "u", "<article>a  b</article>", "x", 1)]
    schema = "page_id bigint, url string, html string, text string, open int"
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, schema)).collect()}
    assert got[9] == got[10] == "" and got[None] == "a b" and got[3].endswith("3 of them") and "Welcome" not in got[3]
    assert html.extract(spark.createDataFrame([], schema)).count() == 0


def test_a_run_of_two_pages_of_a_large_host_is_found(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    shared = "two pages of this large host share these words"
    pages = [(i, f"http://h.x/{i}", f"<div>{own(i)}</div>" + f"<p>{shared}</p>" * (i in (5, 2900))) for i in range(3000)]
    pages += [(3000 + i, "http://h.x/copy", f"<div>{own(5000)}</div>") for i in range(4)] + [(4000, "http://other.x/", f"<p>{shared}</p>")]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert len(got) == 3005 and all(got[i] == own(i) for i in range(3000))
    assert all(got[3000 + i] == own(5000) for i in range(4)) and got[4000] == shared  # copies are one page, hosts are apart


@pytest.mark.parametrize("host_tokens", [10**6, 0])
def test_an_open_page_is_compared_with_what_marked_pages_have_around_their_text(spark, host_tokens):
    notice, news = "this unmarked notice stands on all pages of the host", "a report that is printed on a page of its own too"
    pages = [(i, "http://h.x/a", f"<div>{notice}</div><article><p>{news} {i}</p></article>") for i in (1, 2)]
    pages += [(3, "http://h.x/b", f"<div>{notice}</div><main>{news} 3</main>"), (4, "http://h.x/c", f"<div>{notice}</div><p>{news} 1</p>"), (5, "http://o.x/", f"<p>{notice}</p>")]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string"), host_tokens=host_tokens).collect()}
    assert got == {1: f"{news} 1", 2: f"{news} 2", 3: f"{news} 3", 4: f"{news} 1", 5: notice}


@pytest.mark.parametrize("host_tokens", [10**6, 100, 0])
def test_boilerplate_by_comparing_all_runs(spark, host_tokens):
    """Hosts sorted in one task, hosts too large for that, and both: the same text."""
    rng = random.Random(12)
    common = [" ".join(rng.choices("abcdefgh", k=rng.randrange(5, 14))) for _ in range(5)]
    pages = []
    for i in range(60):
        parts = [rng.choice(common) if rng.random() < 0.5 else " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(0, 6))]
        pages.append((i, f"http://h{i % 3 if i % 2 else 0}.x/{i}", "".join(f"<p>{x}</p>" for x in parts)))
    pages.append((60, "http://h0.x/copy", pages[4][2]))  # a copy is no other page
    want, streams = {}, {i: (u.split("/")[2], re.findall("<p>(.*?)</p>", h)) for i, u, h in pages}
    runs = collections.defaultdict(set)
    for host, parts in streams.values():
        w = " ".join(parts).split()
        for k in range(len(w) - 7):
            runs[host, tuple(w[k : k + 8])].add(tuple(parts))
    for i, (host, parts) in streams.items():
        w = " ".join(parts).split()
        gone = {j for k in range(len(w) - 7) if len(runs[host, tuple(w[k : k + 8])]) > 1 for j in range(k, k + 8)}
        at, lines = 0, []
        for x in parts:
            n = len(x.split())
            lines.append(" ".join(w[j] for j in range(at, at + n) if j not in gone))
            at += n
        want[i] = "\n".join(x for x in lines if x)
    got = html.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string"), host_tokens=host_tokens).collect()
    assert {r.page_id: r.text for r in got} == want and sum(len(streams[i][1]) > 0 and not t for i, t in want.items()) >= 1


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_sorted_suffixes_compared_by_ranges(size):
    """Batches and ranges cut anywhere: the suffixes whose run another page has, or what says so for a run that ranges cut."""
    rng = random.Random(size)
    data = sorted({(rng.choice("hk"), rng.choice("abcdefgh"), rng.randrange(6), rng.randrange(3)) for _ in range(60)})
    pages = collections.defaultdict(set)
    for host, run, page, _ in data:
        pages[host, run].add(page)
    cuts = sorted(rng.sample(range(1, len(data)), 5))
    got, edges = [], []
    for a, z in zip([0, *cuts], [*cuts, len(data)], strict=True):
        columns = [pa.array(c, t) for c, t in zip(zip(*data[a:z], strict=True), (pa.string(), pa.string(), pa.int64(), pa.int32()), strict=True)]
        part = pa.RecordBatch.from_arrays(columns, names=["host", "run", "page", "at"])
        for b in html._compared(part.slice(i, size) for i in range(0, z - a, size)):
            got += [(r["page"], r["at"]) for r in b.to_pylist() if r["run"] is None]
            edges += [r for r in b.to_pylist() if r["run"] is not None]
    named = collections.defaultdict(set)
    for r in edges:
        named[r["host"], r["run"]].add(r["page"])
    got += [(r["page"], r["at"]) for r in edges if r["at"] is not None and len(named[r["host"], r["run"]]) > 1]
    assert sorted(got) == sorted((p, at) for h, r, p, at in data if len(pages[h, r]) > 1) and list(html._compared(iter([]))) == []


def test_a_large_host_has_a_suffix_array_too(spark, monkeypatch):
    """Its suffixes are sorted over all tasks; a run that all pages share goes to several of them."""
    seen, write = {}, html.materialize

    def planned(df, name):
        seen[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(html, "materialize", planned)
    shared = "all the pages of this large host share these"
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(9))
    pages = [(i, "http://h.x/", f"<p>{own(i)}</p><p>{shared}</p>") for i in range(400)] + [(900, "http://o.x/", f"<p>{shared}</p>")]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string"), host_tokens=0).collect()}
    assert got == {i: own(i) for i in range(400)} | {900: shared}
    assert re.search(r"rangepartitioning\(host#\d+ ASC NULLS FIRST, run#\d+ ASC NULLS FIRST, page#", seen["html-runs"]) and "Sort [host" in seen["html-runs"]


@pytest.mark.parametrize("keep_first", [False, True])
def test_suffixes_by_brute_force(spark, monkeypatch, keep_first):
    monkeypatch.setattr(suffixes, "RUN", 7)
    monkeypatch.setattr(suffixes, "RANGE", 20)
    rng, size = random.Random(5), 16
    base = ["".join(rng.choice("abé") for _ in range(40)) for _ in range(4)]
    docs = [(998, None), (999, "")]
    for i in range(45):
        b = list(rng.choice(base))
        b[rng.randrange(40)] = rng.choice("QRé")
        cut = rng.randrange(30)
        docs.append((i, rng.choice(["".join(b), rng.choice(base), "x" * rng.randint(0, 3) + "".join(b[cut : cut + 28]) + "yz", "ab" * rng.randint(0, 30)])))
    data = [((x or "").encode(), j) for j, (_, x) in enumerate(docs)]
    name = lambda b, j: hashlib.sha256(b).digest()[:16] if keep_first else j
    places = collections.defaultdict(list)
    for b, j in data:
        for p in range(len(b) - size + 1):
            places[b[p : p + size]].append((name(b, j), p))
    got = {r.doc_id: r for r in suffixes.remove(spark.createDataFrame(docs, "doc_id bigint, text string"), length=size, keep_first=keep_first).collect()}
    for (i, x), (b, j) in zip(docs, data, strict=True):
        gone = set()
        for p in range(len(b) - size + 1):
            v = places[b[p : p + size]]
            if (name(b, j), p) != min(v) if keep_first else len(v) > 1:
                gone.update(range(p, p + size))
        assert bytes(got[i].kept) == bytes(c for q, c in enumerate(b) if q not in gone) and got[i].text == x
        assert sum(s.end - s.start for s in got[i].spans) == len(gone)


def test_suffix_merge_gets_no_owners(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "RUN", 50)
    monkeypatch.setattr(suffixes, "RANGE", 100)
    rows = [(f"{i:016d}".encode(), i, i % 2 == 0, b"the same string!" if i % 3 else f"string {i:09d}".encode()) for i in range(900)]
    df = spark.createDataFrame(rows, "id binary, p int, need boolean, s binary")
    watched, grouped = [], type(df.groupBy())
    plain = grouped.applyInArrow

    def merge(self, func, schema):
        watched.append(sum(len(v) for r in self._df.collect() for v in r if isinstance(v, list)))
        return plain(self, func, schema)

    monkeypatch.setattr(grouped, "applyInArrow", merge)
    got = {(bytes(r.id), r.p) for r in suffixes.repeated(df, 16, False).collect()}
    assert got == {(i, p) for i, p, need, s in rows if need and s == b"the same string!"}
    assert 0 < watched[0] <= 6 * (300 + 900 // 50 + 8)  # six values of each string of a run, however many places have it


def test_texts_without_repeats_need_no_shuffle(spark, monkeypatch):
    """Only those that may have spans are packed for the join that brings them; the others pass as they are."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(60))
    shared = word()
    docs = [(i, word() + (f"{chr(65 + i // 50)}{shared}{chr(65 + i // 50)}" if i % 50 == 0 else "") + "\u00e9") for i in range(400)] + [(400, None), (401, "")]
    packed, plain = [], suffixes._squeezed
    monkeypatch.setattr(suffixes, "_squeezed", lambda df, c: packed.append(df) or plain(df, c))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r for r in suffixes.remove(df, length=40).collect()}
    assert packed[-1].count() < 40
    for i, x in docs:
        gone = 60 if i < 400 and i % 50 == 0 else 0
        assert got[i].text == x and sum(s.end - s.start for s in got[i].spans) == gone
        assert bytes(got[i].kept) == (x or "").replace(shared, "").encode()
    assert suffixes.remove(df, length=40, with_text=False).columns == ["doc_id", "spans", "kept"]
    (one, *_) = [r for r in suffixes.clean(df, length=40).collect() if r.doc_id == 0]
    assert one.text in (docs[0][1], docs[0][1].replace(shared, ""))


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("size", [9, 13, 22])
def test_suffixes_of_other_lengths_by_brute_force(spark, size, keep_first):
    rng = random.Random(size)
    base = ["".join(rng.choice("abcd") for _ in range(70)) for _ in range(3)]
    docs = []
    for i in range(60):
        b, cut = list(rng.choice(base)), rng.randrange(50)
        b[rng.randrange(70)] = "Q"
        docs.append((i, rng.choice(["".join(b), "".join(b[cut : cut + size + rng.randrange(3)]) + str(i)])))
    name = lambda x: hashlib.sha256(x.encode()).digest()[:16]
    places = collections.defaultdict(list)
    for i, x in docs:
        for p in range(len(x) - size + 1):
            places[x[p : p + size]].append((name(x) if keep_first else i, p))
    got = {r.doc_id: r for r in suffixes.remove(spark.createDataFrame(docs, "doc_id bigint, text string"), length=size, keep_first=keep_first).collect()}
    for i, x in docs:
        gone = set()
        for p in range(len(x) - size + 1):
            v = places[x[p : p + size]]
            if (name(x), p) != min(v) if keep_first else len(v) > 1:
                gone.update(range(p, p + size))
        assert bytes(got[i].kept).decode() == "".join(c for q, c in enumerate(x) if q not in gone)


def test_suffixes_on_odd_rows(odd, none):
    got = suffixes.clean(odd, length=100)
    assert got.columns == odd.columns and (None, None) in {(r.doc_id, r.text) for r in got.collect()}
    assert suffixes.clean(none, length=100).count() == 0


def test_nearest_by_brute_force(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((700, 24)).astype(np.float32)
    v[100:140] = v[99]  # ties
    rows = [(i, [float(c) for c in x]) for i, x in enumerate(v)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 24), (1003, [1.0] * 23 + [None]), (1004, [float("nan")] * 24), (1005, [float("inf")] + [1.0] * 23), (None, [1.0] * 24), (1050, [1.0, 2.0])]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = collections.defaultdict(list)
    for r in neighbours.search(df, F.col("vec_id") % 50 == 0, 5, "vec_id", "embedding").orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    hits = 0
    for q in range(0, 700, 50):
        score = np.round(unit @ unit[q], 12)
        want = [i for i in np.lexsort((np.arange(700), -score)) if i != q][:5]
        hits += len({i for i, _ in got[q]} & set(want))
        assert np.allclose([s for _, s in got[q]], [score[i] for i, _ in got[q]])
    assert hits >= 0.9 * 5 * 14 and [i for i, _ in got[100]] == [99, 101, 102, 103, 104] and 1050 not in got
    assert neighbours.search(df.limit(0), F.col("vec_id") % 50 == 0, 5, "vec_id", "embedding").count() == 0


@pytest.mark.parametrize("scale", [1.0, 0.1])  # numbers that 32 bits hold exactly, and others
def test_nearest_over_many_blocks(spark, monkeypatch, scale):
    monkeypatch.setattr(neighbours, "BLOCK", 30)
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    v = np.random.default_rng(4).standard_normal((6000, 8)).astype(np.float32).astype(float) * scale
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    found = neighbours.search(df, F.col("vec_id") % 500 == 0, 3, "vec_id", "embedding", neighbours.DEVIATIONS)
    # the query blocks are many more once they are sent to every group than Spark takes them for; 615,000 vectors gave a broadcast of 1,074 MB
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"\w+Join", plan[plan.index("MapInArrow") :])[0] == "SortMergeJoin", plan
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in found.collect()}
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    for q in range(0, 6000, 500):
        score = unit @ unit[q]
        want = [i for i in np.argsort(-score) if i != q][:3]
        assert [got[q, k][0] for k in (1, 2, 3)] == want and np.allclose([got[q, k][1] for k in (1, 2, 3)], score[want])
    assert len(got) == 36


def test_repeated_rows_do_not_displace_neighbours(spark):
    from pyspark.sql import functions as F

    rows = [(0, [1.0, 0.0, 0.0])] + [(1, [1.0, 0.01, 0.0])] * 9 + [(i, [1.0, 0.1 * i, 0.0]) for i in range(2, 8)]
    found = neighbours.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").coalesce(1), F.col("vec_id") == 0, 5, "vec_id", "embedding")
    assert [r.vec_id for r in found.orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def test_pipeline_broadcasts_no_signatures(spark, monkeypatch):
    """Near dedup sent all of them through the driver, 738 MB for 256,410 documents."""
    plans, write = {}, simhash.materialize

    def planned(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(simhash, "materialize", planned)
    rows = [(i, " ".join(f"w{k * (i // 2)}" for k in range(80))) for i in range(40)]
    assert corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "").count() == 20
    expanded = [p for p in plans.values() if "Generate inline" in p]
    assert expanded and not any("BroadcastExchange" in p for p in expanded), expanded


def test_pipeline_leaves_clean_documents(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    clean = {i: "\n".join(" ".join(word() for _ in range(30)) for _ in range(4)) for i in range(10)}
    passage = " ".join(word() for _ in range(60))
    rows = [(i, t) for i, t in clean.items()] + [(20, clean[0]), (21, "too short"), (22, "bad** " * 80), (23, None)]
    rows += [(30 + i, " ".join(word() for _ in range(60)) + " " + passage + " " + " ".join(word() for _ in range(60))) for i in range(3)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    total = collections.Counter()
    for r in got:
        total[r.doc_id] += r.length
    assert set(total) == {*range(10), 30, 31, 32}
    library = Tokenizer.from_file(PATH)
    for i, t in clean.items():
        assert total[i] == len(library.encode(t, add_special_tokens=False).ids) + 1
    n = len(library.encode(passage, add_special_tokens=False).ids)
    whole = [len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows if i and i >= 30]
    assert sorted(w - total[30 + i] > 0.9 * n for i, w in enumerate(whole)) == [False, True, True]


def test_clashing_columns_are_replaced(spark):
    rows = [(i, f"line {i % 3} of a text that repeats\nand another", "x", "x", "x", "x", "x", "x") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string, slot string, spans string, kept string, dups string, n_lines string")
    for got, added in (
        (sharding.shard(docs.withColumn("size", F.lit(1)), 2, "doc_id", "size"), ["shard", "slot"]),
        (suffixes.remove(docs, length=10), ["spans", "kept"]),
        (lines.remove(docs), ["dups", "n_lines", "n_removed", "removed_chars"]),
    ):
        assert len(set(got.columns)) == len(got.columns) and got.count() == 9
        assert all(got.schema[c].dataType.simpleString() != "string" for c in added)
        assert got.select("doc_id").distinct().count() == 9


@pytest.mark.parametrize("name", ["op1_packing", "op3_sharding", "op4_simhash", "op6_line_dedup", "op9_suffix_dedup", "op2_bpe"])
def test_registered_queries_on_a_small_folder(spark, tmp_path, name, library):
    """The queries' own columns: hashes, counts and types."""
    rng = random.Random(2)
    texts = ["\n".join(" ".join(rng.choices("alpha beta gamma delta epsilon zeta".split(), k=9)) for _ in range(rng.randrange(0, 6))) for _ in range(30)]
    rows = [(i, texts[i % 30] if i % 3 else texts[0]) for i in range(60)] + [(60, None), (61, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.REGISTRY[name](spark, str(tmp_path))
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    got, text = df.collect(), {i: t or "" for i, t in rows}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in text.items()}
    if name == "op1_packing":
        assert types == {"doc_id": "bigint", "start": "bigint", "length": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint", "ids_crc32": "bigint"}
        for r in got:
            own = [*ids[r.doc_id], 2]
            assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(np.array(own[r.start : r.start + r.length], "<u4").tobytes())
        assert sum(r.length for r in got) == sum(len(x) + 1 for x in ids.values())
    elif name == "op2_bpe":
        assert types == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
        for r in got:
            own = ids[r.doc_id]
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(own), sha(" ".join(map(str, own)).encode()), sha(library.decode(own, skip_special_tokens=False).encode()))
        assert len(got) == 62
    elif name == "op3_sharding":
        assert types == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
        assert {r.doc_id: (r["size"], r.text_crc32, r.law, r.grown_shard) for r in got} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode()) if i != 60 else r60(got), "bytes", None) for i, t in text.items()}
    elif name == "op4_simhash":
        assert types == {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}
        assert {r.doc_id: r.fingerprint for r in got} == {i: f"{simhash.fingerprint(t) & (1 << 64) - 1:016x}" for i, t in text.items()}
    elif name == "op6_line_dedup":
        seen, want = {}, {}
        for i, t in sorted(text.items()):  # all lines are equal or far apart, or within one edit of none
            keep, gone = [], []
            for k, x in enumerate(t.split("\n")):
                (gone if x.strip() and x in seen else keep).append(k)
                seen.setdefault(x, (i, k))
            want[i] = (t.count("\n") + 1, gone, sha("\n".join(t.split("\n")[k] for k in keep).encode()) if gone else sha(t.encode()))
        assert {r.doc_id: (r.n_lines, list(r.removed_lines), r.kept_sha256) for r in got} == want and types["n_removed"] == types["n_lines"] == "bigint"
    else:
        assert types == {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}
        data, starts = {i: t.encode() for i, t in text.items()}, collections.Counter()
        for t in data.values():
            starts.update(t[k : k + 400] for k in range(len(t) - 399))
        for r in got:
            t = data[r.doc_id]
            gone = {j for k in range(len(t) - 399) if starts[t[k : k + 400]] > 1 for j in range(k, k + 400)}
            left = bytes(c for j, c in enumerate(t) if j not in gone)
            spans = sum(j in gone and j - 1 not in gone for j in range(len(t)))
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), len(gone), spans, sha(left))


def r60(rows):
    return next(r.text_crc32 for r in rows if r.doc_id == 60)  # a null text has no bytes to hash
