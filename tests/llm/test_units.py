"""The operators' small parts against plain versions of themselves; no Spark."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hearth.llm import bpe, html, licenses, lines, neighbours, packing, simhash, suffixes

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


ODD = "aAbeE.,!?;'s tT|<>éÉüÜßΣσς́İŉſ\n\t \x1c!#1９漢ªº²"


def test_ids_equal_the_library(library, encoder):
    rng = random.Random(4)
    packed = packing.tokens(PATH, 2)()
    for i in range(3000):
        x = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 40)))
        if i % 9 == 0:
            x = x[:20] + rng.choice(["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>"]) + x[20:]
        want = library.encode(x, add_special_tokens=False).ids
        assert encoder.encode(x) == want, repr(x)
        assert np.frombuffer(packed(x), "<u4").tolist() == [*want, 2], repr(x)
        assert encoder.decode(want) == library.decode(want, skip_special_tokens=False)
    assert encoder.encode(None) == encoder.encode("") == []


def test_chunks_that_come_again_outlive_a_full_cache():
    asked = []
    cache = bpe.Cache(lambda w: asked.append(w) or w.encode(), 3)
    for i in range(40):
        assert cache["Often,***"] == b"often,***" and cache[f"rare{chr(97 + i % 26)}"]
    assert asked.count("often") == asked.count(",***") == 1 and len(cache) + len(cache.older) <= 6


def test_every_character_of_the_first_planes(library, encoder):
    for c in range(0, 0x20000, 7):
        if not 0xD800 <= c < 0xE000:
            x = f"a!{chr(c)}!b{chr(c)}5"
            assert encoder.encode(x) == library.encode(x, add_special_tokens=False).ids, hex(c)


def test_a_very_long_word(library, encoder):
    x = "ab" * 30000
    assert encoder.encode(x) == library.encode(x, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=40), st.integers(1, 4))
def test_windows_hold_every_id_once(sizes, count):
    w = packing.Windows(0, 16, count)
    for d, n in enumerate(sizes):
        w.add(d, 0, n, np.arange(n, dtype="<u4").tobytes())
    assert len(w.open) <= count
    w.close()
    got, filled = {}, {}
    for doc, start, n, total, ids, seq, offset, _ in w.done:
        assert total == sizes[doc] and offset == filled.get(seq, 0) and len(ids) == 4 * n
        filled[seq] = offset + n
        got.setdefault(doc, []).append((start, np.frombuffer(ids, "<u4").tolist()))
    for d, n in enumerate(sizes):
        assert [x for _, ids in sorted(got[d]) for x in ids] == list(range(n))
    assert all(n & (n - 1) == 0 and n <= 16 for n in filled.values())


def test_fingerprint_by_counting():
    rng = random.Random(2)
    for text in ["", None, "   ", "one", "one two", "A b\tC\x0bd E", " ".join(rng.choice("abcdef") for _ in range(300)), "é ä ü ö x"]:
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
        assert simhash.fingerprint(text) & (1 << 64) - 1 == want


def _edits(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a):
        q = [i + 1]
        for j, y in enumerate(b):
            q.append(min(p[j] + (x != y), p[j + 1] + 1, q[-1] + 1))
        p = q
    return p[-1]


@settings(max_examples=800, deadline=None)
@given(st.text("ab", max_size=8), st.text("ab", max_size=8), st.integers(0, 3))
def test_edit_distance_and_shared_segments(a, b, t):
    near = _edits(a, b) <= t
    assert lines.within(a, b, t) == near
    if near and a != b:
        long, short = (a, b) if len(a) >= len(b) else (b, a)
        assert {k for k, _ in lines.keys(long, t)[1]} & set(lines.keys(short, t)[0])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=5, max_size=5), max_size=6, unique=True), min_size=1, max_size=6))
def test_loser_tree_merges_and_knows_prefixes(runs):
    runs = [sorted(r) for r in runs]
    got = list(suffixes.LoserTree([suffixes.front_code(r) for r in runs]))
    want = sorted(x for r in runs for x in r)
    assert [s for _, s, _, _ in got] == want
    assert all(got[i][0] == suffixes.common(want[i - 1], want[i], 0) for i in range(1, len(want)))


def test_anchors_of_equal_strings_lie_alike(monkeypatch):
    monkeypatch.setattr(suffixes, "STRETCH", 37)
    rng = random.Random(3)
    text = bytes(rng.choice(b"ab") for _ in range(300))
    places = [int(p) for a in suffixes.anchors(text, 16) for p in a[0]]
    assert places == sorted(set(places))
    for p in range(len(text) - 15):
        assert any(p <= x <= p + 12 for x in places)
    assert list(suffixes.anchors(b"x" * 15, 16)) == []


def test_html_blocks():
    page = (
        '<html><head><title>T</title></head><body class="nav"><div class="top-nav">menu</div><header>Site</header><p>One &nbsp; two<br>three<p>four '
        '<span class=ad>buy</span> five<div id="comments"><article>c</article></div><form>x</form><script>if(a<b){"</p>"}</script>tail <b'
    )
    assert html.blocks(page) == ("open", ["One two three", "four five", "tail"])
    article = "<nav>n</nav><article><h1>Head &amp; &copy;</h1><p><b>a<br><p>b &am<aside>x</aside></article><footer>f</footer>"
    assert html.blocks(article) == ("article", ["Head & ©", "a", "b &am"])
    assert html.blocks("<main><p>m</main><p>o") == ("main", ["m"])
    assert html.blocks("") == ("open", []) and html.blocks("<article>") == ("open", [])
    assert html.blocks("plain < text") == ("open", ["plain < text"])


def test_the_article_among_others():
    own = "<article><h1>T</h1><p>The article itself.</p></article>"
    comment = '<article class="comment">reader says a lot more than the article did</article>'
    teaser = '<section><article><h2>Other</h2>a teaser of some other story that is longer than the article</article></section>'
    assert html.blocks(own + comment) == ("article", ["T", "The article itself."]) == html.blocks(teaser + own + teaser)
    assert html.blocks(own.replace("</article>", comment + "</article>")) == ("article", ["T", "The article itself."])
    assert html.blocks("<article>short</article><article>the longer one</article>") == ("article", ["the longer one"])
    for name in ('class="social-science"', 'id="share-prices"', 'class="notice-board x"', "class=commentary"):
        assert html.blocks(f"<article><h1>T</h1><div {name}>real text</div></article>")[1] == ["T", "real text"], name
    for name in ('class="x top-nav"', 'id="comment-list"', "class=ad", 'class="ad-slot-2"', 'role="navigation"', 'class="cookie-bar"'):
        assert html.blocks(f"<article><h1>T</h1><div {name}>other text</div></article>")[1] == ["T"], name
    long = "<article>" + "<p>word word</p>" * 30000 + "</article>"
    assert len(html.blocks(long)[1]) == 30000


def test_repeated_tokens_by_comparison():
    rng = random.Random(1)
    for _ in range(150):
        pages = [[rng.choice("abc") for _ in range(rng.randint(0, 15))] for _ in range(4)]
        for i, (page, got) in enumerate(zip(pages, html.repeated_tokens(pages, 3), strict=True)):
            want = [False] * len(page)
            for s in range(len(page) - 2):
                if any(page[s : s + 3] == q[z : z + 3] for j, q in enumerate(pages) if j != i for z in range(len(q) - 2)):
                    want[s : s + 3] = [True] * 3
            assert want == list(got)


def test_size_classes_hold_their_templates():
    for n in range(1, 400):
        width, stride = licenses.size_class(n)
        assert width >= n + stride - 1
        assert 0.8 * n / (width + 0.2 * n) > 0.38


def test_estimates_keep_to_their_bounds():
    rng = np.random.default_rng(1)
    v, q = (x / np.linalg.norm(x, axis=1)[:, None] for x in (rng.standard_normal((2000, 64)), rng.standard_normal((20, 64))))
    turn = neighbours.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    est, err = neighbours.estimates(*neighbours.codes(v, turn), q, turn)
    assert np.mean(np.abs(est - q @ v.T) <= err) > 0.9995
    assert abs(np.mean(est - q @ v.T)) < 0.005


def test_texts_scanned_together_have_the_anchors_of_each(monkeypatch):
    rng = random.Random(3)
    texts = [bytes(rng.choices(b"ab", k=rng.randrange(0, 90))) for _ in range(60)] + [b"", b"a" * 200, bytes(rng.choices(b"abc", k=3000)), b"b" * 16]
    scans, plain = [], suffixes.Hashes
    monkeypatch.setattr(suffixes, "Hashes", lambda data: scans.append(len(data)) or plain(data))
    for length in (1, 4, 16):
        want = sorted((i, *map(int, r)) for i, t in enumerate(texts) for a in suffixes.anchors(t, length) for r in zip(*a, strict=True))
        for size in (1, 300, 1 << 16):
            monkeypatch.setattr(suffixes, "TOGETHER", size)
            scans.clear()
            assert sorted(tuple(map(int, r)) for a in suffixes.anchors_of(texts, length) for r in zip(*a, strict=True)) == want
        assert len(scans) == 1  # of all these texts


def test_each_string_belongs_to_one_anchor(monkeypatch):
    rng = random.Random(1)
    for length in (1, 4, 16):
        texts = [bytes(rng.choice(b"abc") for _ in range(rng.choice((0, 3, length, length + 1, 40, 300)))) for _ in range(40)]
        found = sorted((i, *map(int, r)) for a in suffixes.anchors_of(texts, length) for i, *r in zip(*a, strict=True))
        starts = [(i, p - d) for i, p, left, right, *_ in found for d in range(length - right, left + 1)]
        assert sorted(starts) == [(i, p) for i, t in enumerate(texts) for p in range(len(t) - length + 1)]
        for size in (1, 7, 37):
            monkeypatch.setattr(suffixes, "STRETCH", size)
            assert sorted((i, *map(int, r)) for i, t in enumerate(texts) for a in suffixes.anchors(t, length) for r in zip(*a, strict=True)) == found


def test_overlapping_blocks_give_each_start_once():
    class Plain:
        mapInArrow = staticmethod(lambda run, schema: run)

    around, length = bytes(range(40)), 16
    types = {"cid": pa.int64(), "at": pa.int64(), "need": pa.bool_(), "left": pa.int32(), "right": pa.int32(), "around": pa.binary(), "blocks": pa.list_(pa.int32())}
    row = {"cid": 1, "at": 2, "need": True, "left": 12, "right": 16, "around": around, "blocks": [6, 7]}
    batch = pa.RecordBatch.from_arrays([pa.array([row[c]], t) for c, t in types.items()], names=list(types))
    (tested,) = suffixes._tests(Plain, length, 2, 1)(iter([batch]))
    assert sorted(zip(tested["block"].to_pylist(), tested["kind"].to_pylist(), strict=True)) == [(d, kind) for d in (6, 7, 8) for kind in (0, 1)]
    last = [b"i" * 16, 50, 12, 16, around, [6, 7], [7]]
    names = ["id", "pos", "left", "right", "around", "blocks", "open"]
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    (strings,) = suffixes._suffixes(length, 2)(pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(last, kinds, strict=True)], names=names))
    assert sorted(zip(strings["p"].to_pylist(), strings["need"].to_pylist(), strict=True)) == [(42, True), (43, True), (44, False)]
