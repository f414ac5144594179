"""N-gram Jaccard join: documents whose sets of word n-grams have a similarity of ``similarity`` or more, by parity sketches.

A sketch has a bit for each hash position; every n-gram flips its bit. Two sketches differ in no more
bits than the sets have n-grams that only one of them holds, and sets of given sizes may be
similar only if those are few (a nineteenth of both sizes for a similarity of 0.9).

1. Bands. A pair meets in the band of the smaller set's size; a set is also filed in the band below if a
   partner may lie there. A band's largest possible distance d and the slack s give
   d + 1 + 2s parts of ``PART_BITS`` bits. Of them each set leaves out the s parts with the fewest set
   bits, which others share by chance; at least one part of a similar pair is equal and filed by both.
2. Equal parts meet in an equality join. First every set is compared with the smallest set of
   its part only. Parts whose sets have not become one component by that go on: all pairs
   of different components in parts of up to ``PAIR_LIMIT`` sets, another common partner in larger ones.
3. Sets of large parts that are still apart (documents that share most of their text, but not enough) are filed
   by their rarest n-grams, of which similar sets share one (prefix filter). N-grams with more than
   ``PAIR_LIMIT`` of them are compared in blocks, which return only the pairs whose sketches are near.
4. A pair is verified by the distance of two denser sketches, a bit an n-gram or more, folded to one width;
   those near enough by their whole sets.

Equal sets are one node, however many documents have them. Links that would join what is connected
already are not looked for; every pair that is similar enough is connected. N-grams are told apart by
64-bit hashes, sets by 64-bit hashes of all of these.

A null text counts as empty. A text without words has an empty set and is linked with nothing; a text
with fewer words than an n-gram has one, all its words. A component is named by its smallest id
that is not null. Repeated rows and ids are kept, each with its set's component. Only the two named
columns are read, so other columns cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import components, discard, map_batches, materialize, slices

SHINGLE = 3
#: The similarity as a fraction, so that bounds are whole numbers.
SIMILARITY = (9, 10)
#: Bits of a part, sizes of a band's first set against the last band's, and how many parts there are to one that is left out.
PART_BITS = 1024
BAND = (4, 3)
SLACK = 10
PAIR_LIMIT = 16
#: Sets (expected number) whose n-grams are known to be common in step 3, and how many. They set the order only.
SAMPLE_ROWS = 5000
COMMON = 100000
#: Sets of a block in step 3.
BLOCK = 512
#: Bits of the bitmap that keeps other texts out of a shuffle: for each text asked for, and at most (8 MB).
BITS_EACH, MOST_BITS = 16, 1 << 26

_M = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ngrams(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; A-Z count as a-z, words end at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known: dict[bytes, int] = {}
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = _mix((out + h[j : j + n]) * _M)
    return np.unique(out)


def set_hash(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def most_apart(x: int, y: int, similarity: tuple[int, int] = SIMILARITY) -> int:
    """How many n-grams at most only one of two similar sets of these sizes holds."""
    a, b = similarity
    return (x + y) * (b - a) // (a + b)


@lru_cache(4)
def bands(similarity: tuple[int, int], longest: int = 1 << 40) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The first size of each band; its number of parts (0 if only equal sets are similar) and how many are left out."""
    firsts, shape = [1], []
    while firsts[-1] < longest:
        low = firsts[-1]
        high = max(low + 1, low * BAND[0] // BAND[1])
        d = most_apart(high - 1, (high - 1) * similarity[1] // similarity[0], similarity)
        left = (d + 1) // SLACK
        shape.append((d + 1 + 2 * left if d else 0, left))
        firsts.append(high)
    return np.array(firsts), shape


def signatures(s: np.ndarray, similarity: tuple[int, int] = SIMILARITY) -> np.ndarray:
    """Hashes of the filed parts of a set's sketches, in all bands where it may meet a partner."""
    firsts, shape = bands(similarity)
    n = len(s)
    lowest = -(-similarity[0] * n // similarity[1])  # size of the smallest partner
    out = []
    for k in range(int(np.searchsorted(firsts, lowest, "right")) - 1, int(np.searchsorted(firsts, n, "right"))):
        parts, left = shape[k]
        if not parts:
            continue
        at = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        bits, times = np.unique(at * np.uint64(PART_BITS) + (s & np.uint64(PART_BITS - 1)), return_counts=True)
        bits = bits[times & 1 == 1]  # what is flipped twice is off again
        of = (bits // np.uint64(PART_BITS)).astype(np.int64)
        upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(bits + _M))))  # sums wrap around
        ends = np.searchsorted(of, np.arange(parts + 1))
        value = upto[ends[1:]] - upto[ends[:-1]]
        part = np.arange(parts, dtype=np.uint64) + np.uint64(k << 40)
        keep = np.argsort(ends[1:] - ends[:-1], kind="stable")[left:]
        out.append(_mix(value + _mix(part + _M))[keep])
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


def sketch(s: np.ndarray) -> bytes:
    """A sketch of a power of two of bits, at least one an n-gram and 64."""
    width = 1 << max(6, (len(s) - 1).bit_length())
    bits = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def apart(x: bytes, y: bytes) -> int:
    """In how many bits two sketches differ, folded to the width of the narrower: a lower bound of what only one of the sets holds."""
    u, v = (np.frombuffer(z, np.uint64) for z in (x, y))
    w = min(len(u), len(v))
    u, v = (np.bitwise_xor.reduce(z.reshape(-1, w), axis=0) if len(z) > w else z for z in (u, v))
    return int(np.bitwise_count(u ^ v).sum())


def similar(s: np.ndarray, t: np.ndarray, similarity: tuple[int, int] = SIMILARITY) -> bool:
    a, b = similarity
    both = len(np.intersect1d(s, t, assume_unique=True))
    return b * both >= a * (len(s) + len(t) - both)


def _fits(x: str, y: str, similarity: tuple[int, int]) -> Column:
    """Whether the sizes allow the similarity."""
    a, b = similarity
    return (F.least(x, y) * b) >= (F.greatest(x, y) * a)


def prints(docs: DataFrame, id_col: str, text_col: str, size: int, similarity: tuple[int, int]) -> DataFrame:
    """(id, r, node, n, sketch, sigs) of every document; r hashes its id and text, node its set."""
    i, t = F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string")
    source = docs.select(i.alias("id"), F.xxhash64(i, t).alias("r"), t.alias("text"))

    def make():
        def step(batch: pa.RecordBatch):
            for b in slices(batch, 2):
                sets = [ngrams(t, size) for t in b.column(2).to_pylist()]
                cols = [
                    pa.array([set_hash(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary()),
                    pa.array([signatures(s, similarity) if len(s) else np.empty(0, np.int64) for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["id", "r", "node", "n", "sketch", "sigs"])

        return step

    return map_batches(source, make, "id bigint, r bigint, node bigint, n bigint, sketch binary, sigs array<bigint>")


def passing(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The ``rows`` whose ``key``, a hash, may be one of ``wanted``: all that are and a few others, for a join to drop.

    Instead of every row only these need a shuffle. A bitmap of bounded size tells them, so it may go to all tasks; one that is too full lets more pass.
    """
    bits = min(MOST_BITS, max(1 << 15, 1 << (BITS_EACH * wanted.count()).bit_length()))
    spot = F.pmod(F.col(key), F.lit(bits)) + 1  # these functions count from 1
    bucket, at = F.bitmap_bucket_number(spot), F.bitmap_bit_position(spot)
    marks = wanted.select(bucket.alias("bucket"), at.alias("at")).distinct().groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("marks"))
    byte = F.conv(F.hex(F.substring("marks", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    met = rows.withColumn("bucket", bucket).join(F.broadcast(marks), "bucket")
    return met.where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*rows.columns)


def _near(pairs: DataFrame, nodes: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sketches are near enough."""
    for x in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")), x)

    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = zip(*(b.column(c).to_pylist() for c in ("na", "nb", "sa", "sb")), strict=True)
            return b.filter(pa.array([apart(x, y) <= most_apart(n, m, similarity) for n, m, x, y in rows], pa.bool_())).select(["a", "b"])

        return step

    return map_batches(pairs.select("a", "b", "na", "nb", "sa", "sb"), make, "a bigint, b bigint")


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, similarity: tuple[int, int]) -> DataFrame:
    """The ``pairs`` (a, b) of nodes whose whole sets are similar enough."""
    asked = materialize(pairs.distinct(), "ngram-pairs")
    near = materialize(_near(asked, nodes, similarity), "ngram-near")
    both = near.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")

    def make():
        last: list = [None, None]  # pairs with a common partner often follow each other

        def step(batch: pa.RecordBatch):
            for b in slices(batch, 3):
                keep = []
                for a, ta, tb in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                    if last[0] != a:
                        last[:] = a, ngrams(ta, size)
                    keep.append(similar(last[1], ngrams(tb, size), similarity))
                yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

        return step

    out = materialize(map_batches(both, make, "a bigint, b bigint"), "ngram-verified")
    discard(asked, near)
    return out


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _apart_still(filed: DataFrame, roots: DataFrame, key: str, least: int = 3) -> DataFrame:
    """(key, node, n, root, c) of the groups of ``filed`` (key, node, n) that hold several components and at least ``least`` sets; c counts the sets."""
    rooted = filed.select(key, "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy(key).agg(F.count("*").alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi")).where(f"lo < hi and c >= {least}")
    return materialize(rooted.join(several.select(key, "c"), key), "ngram-apart")


def _pairs(groups: DataFrame, key: str, similarity: tuple[int, int], pair_limit: int) -> DataFrame:
    """Pairs of sets of different components in groups of up to ``pair_limit`` sets."""
    small = groups.where(F.col("c") <= pair_limit)
    a, b = (small.select(key, F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("root").alias(f"r{x}")) for x in "ab")
    return a.join(b, key).where((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & _fits("na", "nb", similarity)).select("a", "b")


def _rarest(sample: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Common n-grams of a sample of texts and how many texts have each."""

    def make():
        def step(b: pa.RecordBatch):
            for t in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(ngrams(t, size).view(np.int64))], names=["h"])

        return step

    often = map_batches(sample, make, "h bigint").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "h").limit(COMMON).collect()
    often.sort()
    return np.array([r.h for r in often], np.int64), np.array([r.n for r in often], np.int64)


def rare_first(s: np.ndarray, common: np.ndarray, counts: np.ndarray, similarity: tuple[int, int] = SIMILARITY) -> np.ndarray:
    """The n-grams of a set, in one order of all n-grams, one of which any similar set has among its own."""
    h = s.view(np.int64)
    rank = np.zeros(len(h), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        rank = np.where(common[at] == h, counts[at], 0)
    return h[np.lexsort((h, rank))][: len(h) - -(-similarity[0] * len(h) // similarity[1]) + 1]


def _by_rare(left: DataFrame, texts: DataFrame, size: int, similarity: tuple[int, int]) -> DataFrame:
    """(gram, node, n): the sets of ``left`` (node) filed by their rarest n-grams."""
    own = texts.join(left, "node", "left_semi")
    total = own.count()
    common, counts = _rarest(own.select("text").sample(fraction=min(1.0, SAMPLE_ROWS / max(1, total)), seed=7), size)

    def make():
        def step(batch: pa.RecordBatch):
            for b in slices(batch, 1):
                sets = [ngrams(t, size) for t in b.column(1).to_pylist()]
                rare = pa.array([rare_first(s, common, counts, similarity) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), rare], names=["node", "n", "grams"])

        return step

    rows = map_batches(own.select("node", "text"), make, "node bigint, n bigint, grams array<bigint>")
    return rows.select(F.explode("grams").alias("gram"), "node", "n")


def near_pairs(us: np.ndarray, vs: np.ndarray, n: np.ndarray, root: np.ndarray, sketches: list[bytes], similarity: tuple[int, int]) -> list[tuple[int, int]]:
    """The pairs (of ``us``, of ``vs``: row numbers) of different components whose sizes fit and whose sketches are near enough."""
    a, b = similarity
    width = np.array([len(z) // 8 for z in sketches])
    out: list[tuple[int, int]] = []
    for wu in np.unique(width[us]):
        for wv in np.unique(width[vs]):
            w = int(min(wu, wv))
            rows, cols = us[width[us] == wu], vs[width[vs] == wv]
            folded = [np.bitwise_xor.reduce(np.frombuffer(b"".join(sketches[i] for i in part), np.uint64).reshape(len(part), -1, w), axis=1) for part in (rows, cols)]
            step = max(1, (1 << 20) // (len(cols) * w))  # bounds the table of differences
            for at in range(0, len(rows), step):
                r = rows[at : at + step]
                apart_by = np.bitwise_count(folded[0][at : at + step, None, :] ^ folded[1][None, :, :]).sum(axis=2, dtype=np.int64)
                nu, nv = n[r][:, None], n[cols][None, :]
                near = (apart_by <= (nu + nv) * (b - a) // (a + b)) & (np.minimum(nu, nv) * b >= np.maximum(nu, nv) * a) & (root[r][:, None] != root[cols][None, :])
                i, j = np.nonzero(near)
                out += zip(r[i].tolist(), cols[j].tolist(), strict=True)
    return out


def _blocks(groups: DataFrame, key: str, nodes: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs of different components in large groups, compared block by block; only those with near sketches are returned."""
    dealt = groups.withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = dealt.join(nodes.select("node", "sketch"), "node")
    # a block meets itself and every other once; x tells the two sides of a meeting apart
    meets = rows.select(key, "node", "n", "root", "sketch", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    meets = meets.select(key, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("x"), "node", "n", "root", "sketch")

    def compare(table: pa.Table) -> pa.Table:
        x, node, n, root = (table.column(c).to_numpy() for c in ("x", "node", "n", "root"))
        sketches = table.column("sketch").to_pylist()
        same = not x.any()
        first, second = (np.arange(len(x)),) * 2 if same else (np.flatnonzero(x == 0), np.flatnonzero(x == 1))
        found = [p for p in near_pairs(first, second, n, root, sketches, similarity) if not same or p[0] < p[1]]
        a, b = (np.array([node[p[i]] for p in found], np.int64) for i in (0, 1))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return meets.groupBy(key, "i", "j").applyInArrow(compare, "a bigint, b bigint")


def links(table: DataFrame, texts_of, size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """(node, root) of all nodes that links reach. ``table`` is the written result of ``prints``; ``texts_of`` gives the texts (node, text) of nodes (node, r)."""
    each = table.select("node", "n", F.explode("sigs").alias("sig"))
    shared = each.groupBy("sig").agg(F.count("*").alias("c")).where("c > 1").select("sig")
    met = each.join(shared, "sig").groupBy("sig", "node").agg(F.min("n").alias("n"))  # copies are one node
    met = materialize(met, "ngram-met")
    first = met.groupBy("sig").agg(F.min(F.struct("node", "n")).alias("lo"), F.max("node").alias("hi")).where("lo.node < hi")
    filed = materialize(met.join(first.select("sig", F.col("lo.node").alias("lo"), F.col("lo.n").alias("nlo")), "sig"), "ngram-filed")
    discard(met)
    wanted = filed.select("node").distinct()
    nodes = table.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("r").alias("r"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    nodes = materialize(nodes, "ngram-nodes")
    texts = materialize(texts_of(nodes.select("node", "r")), "ngram-texts")
    check = lambda pairs: _verified(pairs, nodes, texts, size, similarity)
    joined = lambda found: components(found, "ngram-links")

    def apart_still(groups: DataFrame, roots: DataFrame, key: str, least: int = 3) -> DataFrame:
        out = _apart_still(groups, roots, key, least)
        discard(groups)
        return out

    stars = filed.where((F.col("lo") != F.col("node")) & _fits("n", "nlo", similarity)).select(*_ordered("lo", "node"))
    found = check(stars)
    roots = joined(found)
    groups = apart_still(filed, roots, "sig")
    found = found.unionByName(check(_pairs(groups, "sig", similarity, pair_limit)))
    large = groups.where(F.col("c") > pair_limit)
    if not large.isEmpty():
        pivot = large.groupBy("sig").agg(F.min(F.struct(F.xxhash64("node").alias("x"), "node", "n", "root")).alias("p"))
        again = large.join(pivot, "sig").where((F.col("root") != F.col("p.root")) & _fits("n", "p.n", similarity)).select(*_ordered("node", "p.node"))
        found = found.unionByName(check(again))
        roots = joined(found)
        large = _apart_still(large, roots, "sig")
        if not large.isEmpty():
            rare = materialize(_by_rare(large.select("node").distinct(), texts, size, similarity), "ngram-rare")
            grams = apart_still(rare, roots, "gram", 2)
            blocks = _blocks(grams.where(F.col("c") > pair_limit), "gram", nodes, similarity)
            found = found.unionByName(check(_pairs(grams, "gram", similarity, pair_limit).union(blocks)))
            discard(grams)
        discard(large)
    out = joined(found)
    discard(nodes, texts, groups)
    return out


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """(id, n, component_id) of every document: how many n-grams its set has, and the smallest id that links reach."""
    table = materialize(prints(docs, id_col, text_col, size, similarity), "ngram-prints")
    i, t = F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string")
    keyed = docs.select(F.xxhash64(i, t).alias("r"), t.alias("text"))
    texts_of = lambda nodes: passing(keyed, nodes, "r").join(nodes, "r").dropDuplicates(["r"]).select("node", "text")  # noqa: E731  repeated rows have the same r
    roots = links(table, texts_of, size, similarity, pair_limit)
    linked = table.select("id", "n", "node").join(roots, "node", "left").withColumn("root", F.when(F.col("n") > 0, F.coalesce("root", "node")))
    lows = linked.where("n > 0").groupBy("root").agg(F.min("id").alias("low"))
    return linked.join(lows, "root", "left").select("id", "n", F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("id")).alias("component_id"))
