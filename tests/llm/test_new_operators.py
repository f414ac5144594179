"""Fill-in-middle, importance resampling and the n-gram Jaccard join: odd rows, and the registered queries against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from hearth.llm import common, fim, jaccard, queries, resample

LONG = " ".join(f"w{i % 997}x{i}" for i in range(20000))
TEXT = "The quick brown fox jumps over 7 lazy dogs while seven OTHER animals watch — from a hill.\nAnother line, with more words in it.\n" * 3
ODD = [
    (None, None), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, LONG), (6, LONG), (7, TEXT), (7, TEXT), (7, "other text of that id"),
    (None, TEXT), (8, "é" * 50), (9, "with a <P> marker " * 9), (10, "a<S" * 30), (11, "P>S>M> <\r\n< P> Straße ñandú 日本 " * 8),
]
SCHEMA = "doc_id bigint, text string, id int, n int, form string, output string, row int, line string, weight int, score int, `rank` int, node int, `a b` int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 1, 2, "f", "o", 3, "l", 4, 5, 6, 7, 8) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, odd, tmp_path_factory):
    """Tables of odd rows and of random prose with copies, for the registered queries."""
    rng = random.Random(5)
    rows = list(ODD)
    vocabulary = ["Alpha", "beta", "gamma", "delta9", "42", "ümlaut", "it's", "e-mail", "X", "日本"]
    lines = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 12))) + rng.choice([".", "!", ""]) for _ in range(60)]
    for i in range(100, 400):
        rows.append((i, "\n".join(rng.choices(lines, k=rng.randrange(0, 9)))))
    rows += [(i, rows[120][1]) for i in range(400, 550)]  # a third are copies of one
    at = tmp_path_factory.mktemp("new")
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate([*lines[:9], None, "", "beta beta 42"])], "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), rows


def test_slices_hold_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 10)
    monkeypatch.setattr(common, "SLICE_ROWS", 3)
    texts = ["a", None, "b" * 30, "", "c" * 9, "d", "e", "f", "g", None]
    got = [b.column(0).to_pylist() for b in common.slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["t"]), 0)]
    assert sum(got, []) == texts and [len(g) for g in got] == [2, 1, 3, 3, 1]
    assert list(common.slices(pa.RecordBatch.from_arrays([pa.array([], pa.string())], names=["t"]), 0)) == []


def cut(i, t):
    """The contract, unit by unit."""
    t = t or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", t)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, n, "plain", None, None, sha(t), sha(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return i, n, form, len(p), len(m), sha(out), sha(t)


def test_fill_in_middle_query(spark, folder):
    at, rows = folder
    got = queries.op12_fill_in_middle(spark, at)
    assert [f.simpleString() for f in got.schema] == ["doc_id:bigint", "n:bigint", "form:string", "prefix_chars:bigint", "middle_chars:bigint", "output_sha256:string", "restored_sha256:string"]
    found = collections.Counter(tuple(r) for r in got.collect())
    assert found == collections.Counter(cut(i, t) for i, t in rows)
    assert {k[2] for k in found} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_odd_rows(odd, none):
    got = fim.fill_in_middle(odd)
    assert got.columns == ["id", "n", "form", "prefix_chars", "middle_chars", "output"] and got.count() == len(ODD)
    back = got.select("id", fim.restored().alias("t")).collect()
    assert collections.Counter((r.id, r.t) for r in back) == collections.Counter((i, t or "") for i, t in ODD)
    assert fim.fill_in_middle(none).count() == 0


def draw(rows, target, grams=1, buckets=10000, least=20, share=(10, 100)):
    """The contract, document by document: (doc_id, n_features, weight, score) of all, and the drawn ones in order."""
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def found(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, grams + 1) for i in range(len(w) - n + 1)]

    s, t = (collections.Counter(b for x in texts for b in found(x)) for texts in ([x for _, x in rows], target))
    ss, tt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets))))
    out, fit = [], []
    for i, x in rows:
        f = found(x)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(f), weight, score))
        if len(words(x)) >= least:
            fit.append((-score, i is None, i or 0, weight, len(f)))
    return out, [(None if none else i, -neg) for neg, none, i, _, _ in sorted(fit)[: share[0] * len(fit) // share[1]]]


def test_resampling_query(spark, folder):
    at, rows = folder
    got = queries.op13_resample(spark, at)
    assert [f.simpleString() for f in got.schema] == [f"{c}:bigint" for c in ("doc_id", "n_features", "weight", "score", "rank")]
    got = got.collect()
    want, drawn = draw(rows, [r.text for r in spark.read.parquet(f"{at}/benchmark.parquet").collect()])
    assert collections.Counter(tuple(r)[:4] for r in got) == collections.Counter(want)
    placed = sorted((r["rank"], r.doc_id, r.score) for r in got if r["rank"])
    assert len(drawn) > 10 and placed == [(k, *d) for k, d in enumerate(drawn, 1)]


@pytest.mark.parametrize("grams", [1, 3])
def test_resampling_of_odd_rows(spark, odd, none, grams):
    aim = ["one line of the target\nand a second one", None, "fox jumps"]
    target = spark.createDataFrame([(t,) for t in aim], "text string")
    got = resample.resample(odd, target, grams=grams, buckets=500, drawn=(60, 100)).collect()
    want, drawn = draw(ODD, aim, grams, 500, share=(60, 100))
    assert collections.Counter(tuple(r)[:4] for r in got) == collections.Counter(want)
    assert sorted((r["rank"], r["id"], r["score"]) for r in got if r["rank"]) == [(k, *d) for k, d in enumerate(drawn, 1)]
    assert resample.resample(none, target, grams=grams).count() == 0
    assert {(r.weight, r["rank"]) for r in resample.resample(odd.where("doc_id < 4"), none, grams=grams).collect()} == {(0, None)}


def test_lines_are_counted_once(spark):
    docs = spark.createDataFrame([(i, "the same line here\n" + ("own words %d" % i)) for i in range(50)], "id bigint, text string")
    lines = {r.n_words: r.times for r in resample._distinct_lines(docs, 1, 100).groupBy("n_words").agg({"times": "max"}).toDF("n_words", "times").collect()}
    assert lines == {4: 50, 3: 1}


def sets_of(rows, size=3):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out.append((i, frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()))
    return out


def components_by_pairs(rows, a=9, b=10):
    """(id, size of the set, smallest id reachable) by comparing all pairs of different sets."""
    sets = sets_of(rows)
    kinds = list({s for _, s in sets})
    up = {s: s for s in kinds}

    def top(s):
        while up[s] is not s:
            s = up[s]
        return s

    for k, s in enumerate(kinds):
        for t in kinds[:k]:
            if s and t and b * min(len(s), len(t)) >= a * max(len(s), len(t)) and b * len(s & t) >= a * len(s | t):
                up[top(s)] = top(t)
    low = {}
    for i, s in sets:
        if i is not None and s:
            low[top(s)] = min(i, low.get(top(s), i))
    return [(i, len(s), low.get(top(s)) if s else i) for i, s in sets]


@pytest.fixture(scope="module")
def families():
    """Near copies in chains, a large group of them, documents that share most of their text, copies, and short texts."""
    rng = random.Random(3)
    word = lambda k=500: f"w{rng.randrange(k)}"
    rows = [*ODD, (20, "one two"), (21, "ONE  two"), (22, "one two three"), (23, "One two\nthree"), (24, "one")]
    at = 100

    def put(w):
        nonlocal at
        rows.append((at, " ".join(w)))
        at += 1

    for n in (8, 11, 12, 13, 20, 35, 60, 110, 300, 900):
        for _ in range(4):
            w = [word() for _ in range(n)]
            put(w)
            for _ in range(5):  # a chain: each differs a little from the one before, some too much
                w = list(w)
                for _ in range(rng.randrange(0, max(2, n // 50))):
                    w[rng.randrange(len(w))] = word()
                put(w + [word()] * rng.randrange(0, 1 + n // 30))
    base = [word() for _ in range(150)]
    for _ in range(120):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(150)] = word(10**6)
        put(w)
    shared = [word() for _ in range(160)]
    for _ in range(60):  # four fifths in common: alike in many parts, similar in none
        put(shared + [word(10**6) for _ in range(40)])
    rows += [(i, rows[60][1]) for i in range(5000, 5100)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [16, 3])
def test_ngram_join_by_all_pairs(spark, families, limit, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    docs = spark.createDataFrame(families, "doc_id bigint, text string").repartition(5)
    got = jaccard.classes(docs, pair_limit=limit).collect()
    assert collections.Counter(tuple(r) for r in got) == collections.Counter(components_by_pairs(families))


def test_ngram_join_query(spark, folder):
    at, rows = folder
    got = queries.op11_ngram_join(spark, at)
    assert [f.simpleString() for f in got.schema] == ["doc_id:bigint", "n_shingles:bigint", "component_id:bigint"]
    assert collections.Counter(tuple(r) for r in got.collect()) == collections.Counter(components_by_pairs(rows))


def test_ngram_join_of_odd_rows(odd, none):
    assert collections.Counter(tuple(r) for r in jaccard.classes(odd).collect()) == collections.Counter(components_by_pairs(ODD))
    assert jaccard.classes(none).count() == 0


def test_large_parts_lose_no_pair(spark, families):
    """What is still apart after the common partners: filed by rare n-grams and compared in blocks."""
    rng = random.Random(8)
    words_ = [f"x{i}" for i in range(300)]
    rows = []
    for i in range(90):
        w = list(words_)
        for _ in range(rng.randrange(1, 6)):
            w[rng.randrange(300)] = f"y{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    table = common.materialize(jaccard.prints(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text", 3, (9, 10)), "t")
    texts = common.materialize(spark.createDataFrame([(jaccard.set_hash(jaccard.ngrams(t)), t) for _, t in rows], "node bigint, text string"), "x")
    none = spark.createDataFrame([], "node bigint, root bigint")
    rare = jaccard._by_rare(texts.select("node"), texts, 3, (9, 10))
    groups = jaccard._apart_still(rare, none, "gram", 2)
    found = {tuple(r) for r in jaccard._pairs(groups, "gram", (9, 10), 4).collect()}
    blocks = {tuple(r) for r in jaccard._blocks(groups.where("c > 4"), "gram", table.select("node", "sketch"), (9, 10)).collect()}
    node = {i: jaccard.set_hash(jaccard.ngrams(t)) for i, t in rows}
    sets = dict(sets_of(rows))
    true = {tuple(sorted((node[i], node[j]))) for i in sets for j in range(i) if 10 * len(sets[i] & sets[j]) >= 9 * len(sets[i] | sets[j])}
    assert len(true) > 20 and true <= found | blocks and blocks & true and len(blocks) < 90 * 89 / 2


@pytest.mark.parametrize("seed", range(4))
def test_sketches_bound_the_distance_and_share_a_part(seed):
    rng = random.Random(seed)
    for _ in range(120):
        n = rng.choice([9, 10, 13, 19, 40, 99, 400, 1500])
        s = {rng.getrandbits(64) for _ in range(n)}
        for out in range(n // 10 + 2):
            t = set(rng.sample(sorted(s), n - out)) | {rng.getrandbits(64) for _ in range(rng.randrange(0, n // 9 + 2))}
            u, v = (np.array(sorted(x), np.uint64) for x in (s, t))
            assert jaccard.apart(jaccard.sketch(u), jaccard.sketch(v)) <= len(s ^ t)
            if 10 * len(s & t) >= 9 * len(s | t):
                assert jaccard.similar(u, v) and len(s ^ t) <= jaccard.most_apart(len(s), len(t))
                assert s == t or set(jaccard.signatures(u).tolist()) & set(jaccard.signatures(v).tolist())
            else:
                assert not jaccard.similar(u, v)


def test_near_pairs_of_blocks_are_those_found_one_by_one():
    rng = random.Random(4)
    sets = []
    for _ in range(6):
        base = [rng.getrandbits(64) for _ in range(rng.choice([9, 60, 63, 66, 130, 700]))]
        for _ in range(12):
            sets.append(np.array(sorted({x if rng.random() < 0.95 else rng.getrandbits(64) for x in base}), np.uint64))
    n, root = np.array([len(s) for s in sets]), np.array([rng.randrange(30) for _ in sets])
    sketches = [jaccard.sketch(s) for s in sets]
    us, vs = np.arange(0, len(sets), 2), np.arange(1, len(sets), 3)
    want = {(u, v) for u in us for v in vs if root[u] != root[v] and 10 * min(n[u], n[v]) >= 9 * max(n[u], n[v]) and jaccard.apart(sketches[u], sketches[v]) <= jaccard.most_apart(int(n[u]), int(n[v]))}
    got = jaccard.near_pairs(us, vs, n, root, sketches, (9, 10))
    assert len(got) == len(set(got)) and set(got) == want and len(want) >= 20


def test_texts_of_others_stay_out_of_the_join(spark, monkeypatch):
    rows = spark.range(-20000, 20000).selectExpr("xxhash64(id) r", "id text")
    wanted = spark.range(50, 1050).selectExpr("xxhash64(id) r")
    asked = {r.r for r in wanted.collect()}
    got = jaccard.passing(rows, wanted, "r").collect()
    assert asked <= {r.r for r in got} and 1000 <= len(got) < 1000 + 39000 // 8
    assert jaccard.passing(rows, wanted.limit(0), "r").count() == 0
    monkeypatch.setattr(jaccard, "MOST_BITS", 64)  # a bitmap that is too full still loses none
    assert asked <= {r.r for r in jaccard.passing(rows, wanted, "r").collect()}


def test_ngram_join_sends_few_texts_through_the_shuffle(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices("abcdefghijklmnopqrst", k=40))) for i in range(900)]
    rows += [(900 + i, f"{rows[i][1]} z") for i in range(40)]
    joined, plain = [], jaccard.passing
    monkeypatch.setattr(jaccard, "passing", lambda *a: joined.append(plain(*a).count()) or plain(*a))
    got = {r.id: r.component_id for r in jaccard.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: c for i, _, c in components_by_pairs(rows)}
    assert len(joined) == 1 and 80 <= joined[0] < 300
