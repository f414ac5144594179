"""Removal of byte strings that occur more than once, by distributed merge sort of suffixes.

A byte is removed if a string of ``length`` bytes that covers it also starts anywhere
else, in the same document or another; matches never cross documents. With
``keep_first`` the first of the places where such a string starts, by text hash and
position, keeps it (exact copies of a text count as one there).

Sorting the suffix of every byte would move each text hundreds of times, so suffixes
that cannot decide anything are left out first, without loss:

1. Anchors. Every string of ``length`` bytes has the smallest hash among its k-grams,
   k = length / 4, at the same place wherever it occurs. Only places that are smallest
   for some string are anchors, and only anchors whose k-gram occurs twice go on. A string
   is told by this anchor alone, not by others that it covers.
2. Contexts. Anchors with the same bytes around them, as far as their strings reach, are
   one class; a class of two or more is repeated as a whole. Of each class one member goes on.
3. Blocks. The starts of an anchor's strings are cut into ranges. If the bytes that a
   range covers in all recur around another anchor, the whole range is repeated; if those
   that all its strings share do not recur, none of it is. Only the rest is cut finer.
4. Suffixes. What remains, a few starts at the ends of each repeat, is decided by sorting.
   Tasks sort runs of suffixes and front-code them (shared prefix length and remainder);
   the runs are cut at sampled splitters and exchanged, and each range is merged by a loser
   tree whose contenders carry the length of the prefix that they share with the last
   winner. Two contenders with different lengths need no comparison, with equal ones it
   starts behind the known prefix. Neighbours that share ``length`` bytes are repeats.

In steps 1 to 3 bytes are compared by 128-bit fingerprints (k-grams, which only select, by 64).
Classes and blocks are counted by grouping with partial sums, so a passage in a third of all
documents is one row in each task. No pairs are formed. Equal suffixes of a run are one entry
of a count, the first place and a hash; their owners stay out of the merge and meet the repeated
strings by that hash in a join. Null texts are empty; nothing is removed there.

``remove`` keeps other columns, but for ones named spans or kept, which are replaced; ``clean`` keeps all. Repeated
rows are kept, each with its text's result. An empty table gives an empty one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from hearth.llm.common import SLICE_BYTES, discard, fields, map_batches, materialize, parted, slices

LENGTH = 400
#: Bytes of a text whose k-grams are hashed at once; parts by which a range of starts is cut, in turn.
STRETCH = 1 << 18
#: Bytes of short texts that are scanned as one.
TOGETHER = 1 << 16
PARTS = (2, 4, 4, 2)
#: Suffixes in a sorted run, suffixes in a merge range, and sampled suffixes for each range.
RUN = 20_000
RANGE = 50_000
SAMPLES = 16

_PLACE = np.uint64((1 << 22) - 1)
_RANDOM = np.random.default_rng(5).integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]  # odd, so each has an inverse modulo 2 ** 64
_INVERSES = [pow(b, -1, 1 << 64) for b in _BASES]


class Powers:
    """Powers of the bases and of their inverses, as far as needed."""

    def __init__(self):
        self.size = 0

    def upto(self, n: int):
        if n > self.size:
            self.size = max(n, 1 << 14)
            of = lambda b: np.concatenate(([np.uint64(1)], np.cumprod(np.full(self.size, b, np.uint64), dtype=np.uint64)))
            self.up, self.down = [of(b) for b in _BASES], [of(b) for b in _INVERSES]
        return self


_powers = Powers()


class Hashes:
    """Hashes of any substrings of one byte string, after one pass over it."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.p = _powers.upto(n + 1)
        self.sums, at = [], data.astype(np.intp)
        for i in (0, 1):
            s = np.empty(n + 1, np.uint64)
            s[0], rest = 0, s[1:]
            np.take(_RANDOM[i], at, out=rest, mode="clip")
            rest *= self.p.up[i][:n]
            np.cumsum(rest, out=rest)
            self.sums.append(s)

    def of(self, start, end, which: int) -> np.ndarray:
        """Hashes of the substrings from ``start`` to ``end``, both arrays or slices."""
        s = self.sums[which]
        h = s[end] - s[start]
        h *= self.p.down[which][start]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def reach_of(length: int) -> tuple[int, int]:
    """(k, reach): size of a k-gram, and how far before its anchor a string can start."""
    k = max(1, length // 4)
    return k, length - k


def _lowest(grams: np.ndarray, w: int) -> np.ndarray:
    """The lowest value of each window of ``w`` hashes, the leftmost of equal ones, with its place in the low bits."""
    value = grams & ~_PLACE
    value |= np.arange(len(grams), dtype=np.uint64)
    padded = np.concatenate((value, np.full(-len(value) % w, np.iinfo(np.uint64).max))).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(grams) - w + 1
    return np.minimum(behind[:starts], ahead[w - 1 : w - 1 + starts])


def _described(hashes: Hashes, place: np.ndarray, left: np.ndarray, right: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(left, right, gram, c1, c2) of anchors at those places of the hashed bytes."""
    size = (left * 65536 + right).astype(np.uint64)
    start, end = place - left, place + right
    return left, right, hashes.of(place, place + k, 0), hashes.of(start, end, 0), hashes.of(start, end, 1) ^ size


def anchors(text: bytes, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(pos, left, right, gram, c1, c2) arrays: anchors of a text, the bytes on each side that their strings cover, and hashes."""
    k, reach = reach_of(length)
    n, strings = len(text), len(text) - length + 1
    held: list[int] = []  # place of the last stretch's last anchor, and the first of its strings
    for at in range(0, max(0, strings), STRETCH):
        low, high = max(0, at - reach - 1), min(n, at + STRETCH + length)
        hashes = Hashes(np.frombuffer(text, np.uint8, high - low, low))
        first, stop = at - low, min(at + STRETCH, strings) - low  # starts of strings
        lowest = _lowest(hashes.of(slice(first, stop + reach), slice(first + k, stop + reach + k), 0), reach + 1)
        begin = np.concatenate(([0], np.flatnonzero(lowest[1:] != lowest[:-1]) + 1))
        place, begin = (lowest[begin] & _PLACE).astype(np.int64) + first, begin + first
        if held and place[0] + low == held[0]:
            begin[0] = held[1] - low
        elif held:
            place, begin = np.concatenate(([held[0] - low], place)), np.concatenate(([held[1] - low], begin))
        last = np.concatenate((begin[1:], [stop])) - 1
        if stop + low < strings:  # the next stretch tells how far the strings of the last one go
            held = [int(place[-1]) + low, int(begin[-1]) + low]
            place, begin, last = place[:-1], begin[:-1], last[:-1]
        yield place + low, *_described(hashes, place, place - begin, length - (place - last), k)


def anchors_of(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """What ``anchors`` finds in each text, after the text's number; short texts are scanned together."""
    some: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if len(t) < TOGETHER:
            some.append(i)
            size += len(t)
        else:
            for a in anchors(t, length):
                yield np.full(len(a[0]), i), *a
        if some and (size >= TOGETHER or i == len(texts) - 1):
            yield from _together(np.array(some), [texts[j] for j in some], length)
            some, size = [], 0


def _together(number: np.ndarray, texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    k, reach = reach_of(length)
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    n = len(data)
    if not (sizes >= length).any():
        return
    hashes = Hashes(data)
    grams = hashes.of(slice(0, n - k + 1), slice(k, n + 1), 0)
    lowest = _lowest(grams, reach + 1)
    # strings that begin a text, or whose lowest is another than that of the string before
    begin = np.union1d(np.flatnonzero(lowest[1:] != lowest[:-1]) + 1, (ends - sizes)[sizes >= length])
    of = np.searchsorted(ends, begin, "right")
    inside = begin + length <= ends[of]  # the string lies in one text
    begin, of = begin[inside], of[inside]
    place = (lowest[begin] & _PLACE).astype(np.int64)
    last = np.minimum(np.concatenate((begin[1:] - 1, [n])), ends[of] - length)
    yield number[of], place - (ends - sizes)[of], *_described(hashes, place, place - begin, length - (place - last), k)


def common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, of which ``start`` bytes are known."""
    end = min(len(a), len(b))
    step = 16
    while start < end:
        if a[start : start + step] == b[start : start + step]:
            start = min(end, start + step)
            step *= 2
        elif step == 1:
            return start
        else:
            step = max(1, step // 4)
    return end


def front_code(strings: list[bytes]) -> list[tuple[int, bytes]]:
    """A sorted run as (prefix shared with the one before, remainder)."""
    out, before = [], b""
    for s in strings:
        p = common(before, s, 0)
        out.append((p, s[p:]))
        before = s
    return out


class LoserTree:
    """Merges front-coded sorted runs; yields (prefix shared with the last one, string, run, index in it)."""

    def __init__(self, runs: list[list[tuple[int, bytes]]]):
        self.runs, self.n = runs, max(1, len(runs))
        self.at = [0] * self.n
        self.string: list[bytes | None] = [None] * self.n  # None: the run is over
        self.shared = [0] * self.n  # with the last winner
        for i, r in enumerate(runs):
            if r:
                self.string[i] = r[0][1]
        self.losers = [-1] * self.n
        self.winner = self._build(1) if runs else 0

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs' heads."""
        s, t = self.string[a], self.string[b]
        if s is None or t is None:
            return (b, a) if s is None else (a, b)
        p, q = self.shared[a], self.shared[b]
        if p != q:
            return (a, b) if p > q else (b, a)  # both are above the last winner: the longer shared prefix is the smaller string
        m = common(s, t, p)
        if m == len(s) or (m < len(t) and s[m] < t[m]):
            self.shared[b] = m
            return a, b
        self.shared[a] = m
        return b, a

    def _build(self, node: int) -> int:
        if node >= self.n:
            return node - self.n
        a, b = self._build(2 * node), self._build(2 * node + 1)
        won, self.losers[node] = self._play(a, b)
        return won

    def __iter__(self):
        while self.runs and self.string[self.winner] is not None:
            i = self.winner
            s = self.string[i]
            yield self.shared[i], s, i, self.at[i]
            self.at[i] += 1
            if self.at[i] < len(self.runs[i]):
                self.shared[i], rest = self.runs[i][self.at[i]]
                self.string[i] = s[: self.shared[i]] + rest
            else:
                self.string[i] = None
            node = (i + self.n) // 2
            while node:
                i, self.losers[node] = self._play(i, self.losers[node])
                node //= 2
            self.winner = i


def repeated(suffixes: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """The rows (id, p) of suffixes (id binary, p int, need boolean, s binary) that need it and recur; s has ``length`` bytes."""
    count = suffixes.count()
    if not count:
        return suffixes.select("id", "p")
    ranges = -(-count // RANGE)
    drawn = suffixes.select("s").sample(fraction=min(1.0, ranges * SAMPLES / count), seed=3) if ranges > 1 else suffixes.select("s").limit(0)
    drawn = sorted(bytes(r[0]) for r in drawn.collect())  # bounded by the number of ranges
    splitters = sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []

    def sort_runs(batches):
        from bisect import bisect_right

        run: list[tuple[bytes, int, int, int]] = []

        def emit():
            run.sort()
            parts: dict[int, list[list]] = {}
            for s, at, x, y in run:
                strings, counts, ones, xs, ys = parts.setdefault(bisect_right(splitters, s), [[], [], [], [], []])
                if strings and strings[-1] == s:
                    counts[-1] += 1
                else:  # the first has the smallest place
                    for column, v in zip((strings, counts, ones, xs, ys), (s, 1, at, x, y), strict=True):
                        column.append(v)
            run.clear()
            for r, (strings, *others) in sorted(parts.items()):
                coded = front_code(strings)
                cols = [pa.array([r], pa.int32()), pa.array([[x[0] for x in coded]], pa.list_(pa.int32())), pa.array([[x[1] for x in coded]], pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(cols + [pa.array([c], pa.list_(pa.int64())) for c in others], names=["range", "shared", "rest", "counts", "ones", "xs", "ys"])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("s", "at", "x", "y")), strict=True):
                run.append(row)
                if len(run) == RUN:
                    yield from emit()
        if run:
            yield from emit()

    def merge(runs: pa.Table) -> pa.Table:
        rows = runs.to_pylist()
        out: list[tuple[int, int, int]] = []
        n, one, key = 0, 0, (0, 0)  # of the strings equal to the last winner

        tree = LoserTree([list(zip(r["shared"], r["rest"], strict=True)) for r in rows])
        for shared, _, i, j in tree:
            r = rows[i]
            if shared < length:
                if n > 1:
                    out.append((*key, one))
                n, one, key = 0, r["ones"][j], (r["xs"][j], r["ys"][j])
            n, one = n + r["counts"][j], min(one, r["ones"][j])
        if n > 1:
            out.append((*key, one))
        return pa.table({c: pa.array([x[k] for x in out], pa.int64()) for k, c in enumerate(("x", "y", "one"))})

    schema = "range int, shared array<int>, rest array<binary>, counts array<bigint>, ones array<bigint>, xs array<bigint>, ys array<bigint>"
    keyed = suffixes.select("id", "p", "need", "s", _place("id", "p").alias("at"), F.xxhash64("s").alias("x"), F.xxhash64(F.lit(7), "s").alias("y"))
    runs = keyed.select("s", "at", "x", "y").mapInArrow(sort_runs, schema)
    again = runs.groupBy("range").applyInArrow(merge, "x bigint, y bigint, one bigint")
    owners = keyed.where("need").select("id", "p", "at", "x", "y").join(again, ["x", "y"])
    return owners.where((F.col("at") != F.col("one")) | F.lit(not keep_first)).select("id", "p")


def _place(id_: str | Column, pos: str | Column) -> Column:
    """A number that orders places by the text's hash and the position; a tie, at odds of 1 in 2 ** 32, keeps both."""
    high = F.conv(F.substring(F.hex(id_), 1, 15), 16, 10).cast("bigint")
    return F.shiftleft(F.shiftright(high, 28), 31).bitwiseOR(F.col(pos).cast("bigint") if isinstance(pos, str) else pos.cast("bigint"))


def _squeezed(df: DataFrame, text_col: str) -> DataFrame:
    """The text column as compressed bytes, for the way through a shuffle; null stays null."""
    at, names = df.columns.index(text_col), df.columns

    def make():
        pack = zstandard.ZstdCompressor(level=1, write_content_size=True).compress

        def step(batch: pa.RecordBatch):
            for b in slices(batch, at):
                z = [None if x is None else pack(x) for x in b.column(at).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(z, pa.binary()), *b.columns[at + 1 :]], names=names)

        return step

    return map_batches(df, make, fields(*[(x.name, BinaryType()) if x.name == text_col else x for x in df.schema]))


def _hashed(docs: DataFrame, text_col: str) -> DataFrame:
    t = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.unhex(F.substring(F.sha2(t, 256), 1, 32)).alias("id"), t.alias("text"))


def _wide(part: int, width: int) -> int:
    return -(-width // part)


def repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, keep_first: bool = False) -> DataFrame:
    """(id, s): stretches of repeated strings of every text that has any, sorted, each as start * 2 ** 32 + end; id is the text's hash."""
    k, reach = reach_of(length)
    texts = _hashed(docs, text_col).where(F.octet_length("text") >= length)

    def scan():
        def step(batch: pa.RecordBatch):
            for b in slices(batch, 1):
                cols = list(anchors_of(b.column(1).cast(pa.binary()).to_pylist(), length))
                if cols:
                    i, p, le, ri, g, c, d = (np.concatenate(x) for x in zip(*cols, strict=True))
                    arrays = [b.column(0).take(pa.array(i)), *(pa.array(x.astype(np.int32)) for x in (p, le, ri)), *(pa.array(x.view(np.int64)) for x in (g, c, d))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["id", "pos", "left", "right", "g", "c", "d"])

        return step

    found = materialize(map_batches(texts, scan, "id binary, pos int, left int, right int, g bigint, c bigint, d bigint"), "suffix-anchors")
    # most k-grams occur once, and their anchors go no further; the others are written, so that the join reads
    # both sides from plain shuffles, of which a k-gram in very many texts can be split
    often = materialize(found.groupBy("g").agg(F.count("*").alias("all")).where("all > 1").select("g"), "suffix-often")
    every, found = found, materialize(found.join(often, "g").withColumn("at", _place("id", "pos")), "suffix-frequent")
    discard(every, often)
    key = ["g", "c", "d"]
    class_of = materialize(found.groupBy(*key).agg(F.count("*").alias("n"), F.min("at").alias("one")), "suffix-class-of")
    single = (F.col("n") == 1) | F.lit(keep_first)
    several = class_of.groupBy("g").agg(F.count("*").alias("classes"), F.max(single).alias("open")).where("classes > 1 and open")
    several = materialize(several.select("g", F.lit(True).alias("several")), "suffix-grams")
    shared = materialize(found.join(class_of.join(several, "g", "left").where("several or n > 1"), key), "suffix-classes")
    discard(found, class_of, several)
    whole = shared.where((F.col("n") > 1) & ((F.col("at") != F.col("one")) | F.lit(not keep_first)))
    whole = materialize(whole.select("id", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("end")), "suffix-whole")

    members = shared.where((F.col("at") == F.col("one")) & F.col("several")).select("id", F.struct("pos", "left", "right", single.alias("need")).alias("m"))
    listed = members.groupBy("id").agg(F.collect_set("m").alias("m"))  # bounded by the text's own length; copies of a text list the same
    held = _squeezed(texts, "text").join(listed, "id").groupBy("id").agg(F.first("text").alias("text"), F.first("m").alias("m"))

    def cut():
        unpack = zstandard.ZstdDecompressor().decompress

        def step(b: pa.RecordBatch):
            m = b.column("m").flatten()
            pos, left, right = (m.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "left", "right"))
            start, end = (pos - left).tolist(), (pos + right).tolist()
            n = b.column("m").value_lengths().to_numpy(zero_copy_only=False)
            row, first, around, size = pa.array(np.repeat(np.arange(b.num_rows), n)), 0, [], 0
            for i, (t, stop) in enumerate(zip(b.column("text").to_pylist(), np.cumsum(n).tolist(), strict=True)):
                data, at = unpack(t), first + len(around)
                around += [data[x:y] for x, y in zip(start[at:stop], end[at:stop], strict=True)]
                size += sum(end[at:stop]) - sum(start[at:stop])
                if size >= SLICE_BYTES or i == b.num_rows - 1:
                    part = slice(first, stop)
                    arrays = [b.column("id").take(row[part]), *(m.field(c)[part] for c in ("pos", "left", "right", "need")), pa.array(around, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["id", "pos", "left", "right", "need", "around"])
                    first, around, size = stop, [], 0

        return step

    contexts = map_batches(held, cut, "id binary, pos int, left int, right int, need boolean, around binary")
    contexts = materialize(contexts.select("*", _place("id", "pos").alias("at"), F.monotonically_increasing_id().alias("cid")), "suffix-contexts")
    discard(shared)
    todo, width, states, settled = contexts.withColumn("blocks", F.array(F.lit(0))), reach + 1, [], []
    for level, parts in enumerate(PARTS):
        finer = _wide(parts, width)
        tested = materialize(_tests(todo, length, width, finer), f"suffix-tests-{level}")
        alike = tested.groupBy("x", "y").agg(F.count("*").alias("n"), F.min("at").alias("one")).where("n > 1").drop("n")
        hit = tested.join(alike, ["x", "y"])
        kind, other = F.col("kind"), F.col("at") != F.col("one")
        state = hit.groupBy("cid", "block").agg(
            F.max("need").alias("need"), F.max((kind == 1) & F.col("need") & (other | F.lit(not keep_first))).alias("whole"),
            F.max(kind == 0).alias("core"), F.max((kind == 1) & other).alias("stood_for"),
        )
        state = materialize(state, f"suffix-state-{level}")
        discard(tested)
        states.append(state)
        settled.append(state.where("whole").select("cid", "block", F.lit(finer).alias("width")))
        # of members alike in the whole block one goes on and stands for the others
        left = state.where("core and not stood_for").groupBy("cid").agg(F.collect_list("block").alias("blocks"), F.collect_list(F.when(F.col("need") & ~F.col("whole"), F.col("block"))).alias("open"))
        todo, width = contexts.join(left, "cid"), finer
    last = map_batches(todo.select("id", "pos", "left", "right", "around", "blocks", "open"), lambda: _suffixes(length, width), "id binary, p int, need boolean, s binary")
    last = materialize(last, "suffix-strings")  # each start once, as only one anchor has its string
    blocks = functools.reduce(DataFrame.union, settled).join(contexts.select("cid", "id", "pos"), "cid")
    blocks = materialize(blocks.select("id", (F.col("pos") - F.col("block") - (F.col("width") - 1)).alias("start"), (F.col("pos") - F.col("block") + length).alias("end")), "suffix-settled")
    discard(contexts, *states)
    spans = whole.union(blocks).union(repeated(last, length, keep_first).select("id", F.col("p").alias("start"), (F.col("p") + length).alias("end")))
    span = F.shiftleft(F.col("start").cast("bigint"), 32).bitwiseOR(F.col("end").cast("bigint"))
    out = materialize(spans.groupBy("id").agg(F.sort_array(F.collect_set(span)).alias("s")), "suffix-repeats")  # copies of a text give the same
    discard(last, whole, blocks)
    return out


def _tests(todo: DataFrame, length: int, width: int, finer: int) -> DataFrame:
    """(cid, at, need, block, kind, x, y): fingerprints of what a block of starts covers (kind 1) and of what all its strings share (0)."""

    def make():
        def step(b: pa.RecordBatch):
            for first in range(0, b.num_rows, 256):
                yield some(b.slice(first, 256))

        def some(b: pa.RecordBatch) -> pa.RecordBatch:
            around = b.column("around").to_pylist()
            base = np.cumsum([0, *map(len, around)])[:-1]
            h = Hashes(np.frombuffer(b"".join(around), np.uint8))
            cid, at, need, left, right = (b.column(c).to_numpy(zero_copy_only=False) for c in ("cid", "at", "need", "left", "right"))
            blocks = b.column("blocks")
            row = np.repeat(np.arange(b.num_rows), blocks.value_lengths().to_numpy(zero_copy_only=False))
            block = blocks.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            # distances d before the anchor, in steps of the finer width, that lie in the wider blocks
            steps = np.arange(0, width, finer)
            row, d = np.repeat(row, len(steps)), (block[:, None] + steps[None, :]).ravel()
            row, d = np.divmod(np.unique(row * (4 * length) + d), 4 * length)  # wider blocks may overlap; a test that comes twice would find itself
            top = d + finer - 1
            inside = (d < length) & (d <= left[row]) & (length - top <= right[row])
            row, d, top = row[inside], d[inside], top[inside]
            whole = (top <= left[row]) & (length - d <= right[row])
            zero = base[row] + left[row]  # the anchors
            start = np.concatenate((zero - d, (zero - top)[whole]))
            end = np.concatenate((zero + length - top, (zero + length - d)[whole]))
            row, d = np.concatenate((row, row[whole])), np.concatenate((d, d[whole]))
            kind = (np.arange(len(row)) >= len(zero)).astype(np.int32)
            x, y = h.of(start, end, 0), h.of(start, end, 1) ^ (2 * d + kind).astype(np.uint64)
            cols = (cid[row], at[row], need[row].astype(bool), d.astype(np.int32), kind, x.view(np.int64), y.view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["cid", "at", "need", "block", "kind", "x", "y"])

        return step

    return map_batches(todo, make, "cid bigint, at bigint, need boolean, block int, kind int, x bigint, y bigint")


def _suffixes(length: int, width: int):
    def step(b: pa.RecordBatch):
        rows = []
        for i, pos, left, right, around, blocks, open_ in zip(*(b.column(c).to_pylist() for c in ("id", "pos", "left", "right", "around", "blocks", "open")), strict=True):
            open_, needs = set(open_), {}
            for block in blocks:  # the last one of a wider block may reach into the next
                for d in range(max(block, length - right), min(block + width - 1, left) + 1):
                    needs[d] = needs.get(d, False) or block in open_
            rows += [(i, pos - d, need, around[left - d : left - d + length]) for d, need in needs.items()]
        types = (pa.binary(), pa.int32(), pa.bool_(), pa.binary())
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["id", "p", "need", "s"])

    return step


def remove(docs: DataFrame, text_col: str = "text", length: int = LENGTH, keep_first: bool = False, with_text: bool = True) -> DataFrame:
    """``docs`` with spans (array of start, end: the maximal removed runs, in bytes) and kept (binary, the remaining bytes); the text may be left out."""
    done, others = _removed(docs, text_col, length, keep_first, (*["text"] * with_text, "spans", "kept"))
    return done.select(*others, "spans", "kept")


_SPANS = "array<struct<start:int,end:int>>"
_KINDS = {"text": "string", "spans": _SPANS, "kept": "binary", "left": "string"}


def _removed(docs: DataFrame, text_col: str, length: int, keep_first: bool, wanted: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """(r, and those ``wanted`` of text, spans, kept, left) of every row, ``left`` being kept as text without characters that were cut; and the columns of ``docs``, text if wanted."""
    listed = repeats(docs, text_col, length, keep_first)
    names = [c for c in docs.columns if c not in ("spans", "kept")]
    at = names.index(text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != text_col]).alias("r") if len(names) > 1 else F.lit(0).alias("r"), F.col(f"`{text_col}`").cast("string").alias("text"), _id(text_col))
    some, others = parted(rows, listed, "id")  # a text without spans needs no shuffle
    joined = _squeezed(some, "text").join(listed, "id", "left").select("r", "text", "s")

    def make():
        unpack = zstandard.ZstdDecompressor().decompress

        def step(b: pa.RecordBatch):
            made: dict[str, list] = {c: [] for c in wanted}
            for z, found in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                data, runs = b"" if z is None else unpack(z), []
                if found.is_valid:
                    x = found.values.to_numpy()
                    start, end = x >> 32, np.maximum.accumulate(x & 0xFFFFFFFF)
                    new = np.flatnonzero(start[1:] > end[:-1]) + 1
                    runs = list(zip(start[[0, *new]].tolist(), end[[*(new - 1), -1]].tolist(), strict=True))
                edges = [0, *(e for r in runs for e in r), len(data)]
                kept = b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)) if runs else data
                for c, out in made.items():
                    if c == "spans":
                        out.append([{"start": a, "end": z} for a, z in runs])
                    elif c == "kept":
                        out.append(kept)
                    elif c == "left" and runs:
                        out.append(kept.decode("utf-8", "ignore").encode())
                    else:
                        out.append(None if z is None else data)
            kinds = {"spans": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))}
            arrays = [pa.array(x, kinds.get(c, pa.binary())) for c, x in made.items()]
            arrays = [x.cast(pa.string()) if _KINDS[c] == "string" else x for c, x in zip(made, arrays, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names=["r", *made])

        return step

    done = map_batches(joined, make, fields(joined.schema["r"], ", ".join(f"{c} {_KINDS[c]}" for c in wanted)))
    plain = {"text": F.col("text"), "spans": F.array().cast(_SPANS), "kept": F.coalesce(F.col("text").cast("binary"), F.lit(b"")), "left": F.col("text")}
    done = done.union(others.select("r", *(plain[c].alias(c) for c in wanted)))
    return done, [F.col("text").alias(c) if i == at else F.col("r")[c].alias(c) for i, c in enumerate(names) if i != at or "text" in wanted]


def _id(text_col: str):
    t = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return F.unhex(F.substring(F.sha2(t, 256), 1, 32)).alias("id")


def clean(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` without strings that occurred before, cut at whole characters, and without documents of which nothing is left."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # names cannot clash
    done, _ = _removed(docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text")), "text", length, True, ("spans", "kept", "left"))
    some = (F.size("spans") == 0) | (F.octet_length("kept") > 0)
    # written here, where Python workers get small batches: passing whole texts and what is left of them takes memory
    left = materialize(done.where(some).select(F.col("r.row").alias("row"), F.col("left").alias("text")), "suffix-clean")
    return left.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
