"""Near-duplicates by SimHash fingerprints and deletion-variant signatures.

Linking at up to ``distance`` differing bits: the 64 bits are cut into
``distance // 2 + 1`` segments, so that in any such pair one segment differs by
at most one bit. Each fingerprint is filed under its segments with one bit
wildcarded, once for every bit; for an even distance the last segment needs no
wildcard, because there the other segments differ by two bits each. Fingerprints
that share a signature meet in an equality join and are verified.

Equal fingerprints are one node, however many documents have them. A signature
shared by more than ``pair_limit`` distinct fingerprints is not joined with
itself. Its fingerprints are filed instead under the whole fingerprint with
``distance`` bits wildcarded, where a group has at most 2 ** distance members, all
of them linked; that is exact and never forms all pairs of a group.

Null texts count as empty. A text without words has fingerprint zero, one with
fewer words than a shingle is one shingle. Repeated rows and ids are kept; a
component is named by its smallest id that is not null. Very long texts are counted block by block, whole. Only the
named columns are read, so other columns cannot clash. An empty table gives an empty one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import components, discard, map_batches, materialize, slices

BITS = 64
#: Signatures with more fingerprints than this go the way without pairs.
PAIR_LIMIT = 64
_BLOCK = 1 << 15  # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of the word shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: lowers A-Z, splits at ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _BLOCK):
        to = min(n, at + _BLOCK)
        h = np.array([digest(line[a:b], seed) for a, b in zip(starts[at:to].tolist(), ends[at + last : to + last].tolist(), strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp, k1, k2) of every document; k1 and k2 hash its id and text."""

    def make():
        def step(batch: pa.RecordBatch):
            for b in slices(batch, 1):
                fps = [fingerprint(x, shingle) for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), b.column(2), b.column(3)], names=["id", "fp", "k1", "k2"])

        return step

    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"), *_keys(id_col, text_col))
    return map_batches(source, make, "id bigint, fp bigint, k1 bigint, k2 bigint")


def _keys(id_col: str, text_col: str) -> list[Column]:
    both = [F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`")]
    return [F.xxhash64(F.lit(i), *both, F.lit(i)).alias(f"k{i}") for i in (1, 2)]


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    n = distance // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _mask(*bits: int) -> int:
    """All bits set but these, as a signed number."""
    m = (1 << BITS) - 1
    for b in bits:
        m &= ~(1 << b)
    return m - (1 << BITS) if m >> (BITS - 1) else m


def _only(first: int, width: int, *without: int) -> int:
    m = sum(1 << b for b in range(first, first + width) if b not in without)
    return m - (1 << BITS) if m >> (BITS - 1) else m


def signatures(fps: DataFrame, distance: int) -> DataFrame:
    """(fp, sig, value): the segments of each fingerprint, one bit wildcarded. ``sig`` names segment and bit; bit 64 is none."""
    keys = []
    segments = _segments(distance)
    for s, (first, width) in enumerate(segments):
        bits = [BITS] if s == len(segments) - 1 and distance % 2 == 0 else range(first, first + width)
        keys += [F.struct(F.lit(s * 100 + b).cast("int").alias("sig"), F.col("fp").bitwiseAND(F.lit(_only(first, width, b))).alias("value")) for b in bits]
    return fps.select("fp", F.inline(F.array(*keys)))


def _wildcards(fps: DataFrame, distance: int) -> DataFrame:
    """(fp, k, v): each fingerprint with every choice of ``distance`` bits cleared; k numbers the choice."""

    def make():
        masks = np.array([_mask(*c) for c in combinations(range(BITS), distance)], np.int64)

        def step(b: pa.RecordBatch):
            fps = b.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 256):  # bounds a batch
                f = fps[at : at + 256]
                v = f[:, None] & masks[None, :]
                k = np.broadcast_to(np.arange(len(masks), dtype=np.int32), v.shape)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(f, len(masks))), pa.array(k.ravel()), pa.array(v.ravel())], names=["fp", "k", "v"])

        return step

    return map_batches(fps, make, "fp bigint, k int, v bigint")


def shared_signatures(fps: DataFrame, distance: int) -> DataFrame:
    """(sig, value, fp, n): the signatures that n > 1 fingerprints have.

    Spark sizes the signatures as the fingerprints they were expanded from, some dozens of times too low, and would
    send all of them to the driver for a broadcast; so this join sorts.
    """
    sigs = signatures(fps, distance)
    shared = sigs.groupBy("sig", "value").agg(F.count("*").alias("n")).where("n > 1")
    return sigs.join(shared.hint("merge"), ["sig", "value"])


def pairs(filed: DataFrame, distance: int) -> DataFrame:
    """(a, b): the fingerprints of ``filed`` (sig, value, fp) that share a signature and differ in at most ``distance`` bits.

    Filed rows repeat a fingerprint dozens of times, which their files hold packed; by the files' size Spark would
    broadcast many times as much, so this join sorts.
    """
    a, b = (filed.select("sig", "value", F.col("fp").alias(x)) for x in "ab")
    # a pair whose segments are equal shares every wildcard of the segment; the one with the lowest bit stands for all
    wild = F.pmod(F.col("sig"), F.lit(100))
    lowest = F.lit(False)
    for first, _ in _segments(distance):
        lowest = lowest | (wild == first)
    at_wild = (wild == BITS) | lowest | (F.expr("shiftright(a ^ b, pmod(sig, 100)) & 1") == 1)
    return a.join(b.hint("merge"), ["sig", "value"]).where((F.col("a") < F.col("b")) & at_wild & (_differing("a", "b") <= distance)).select("a", "b")


def links(fps: DataFrame, distance: int, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints: enough of them to connect all that differ in at most ``distance`` bits.

    Below ``pair_limit`` they are all such pairs; above it, each member of a
    wildcard group is linked to the smallest.
    """
    filed = materialize(shared_signatures(fps, distance), "simhash-filed")
    near = pairs(filed.where(F.col("n") <= pair_limit), distance)
    hot = filed.where(F.col("n") > pair_limit).select("fp").distinct()
    groups = _wildcards(hot, distance).groupBy("k", "v").agg(F.sort_array(F.collect_set("fp")).alias("g")).where(F.size("g") > 1)
    stars = groups.select(F.element_at("g", 1).alias("a"), F.explode(F.slice("g", 2, 1 << distance)).alias("b"))
    out = materialize(near.union(stars).distinct(), "simhash-pairs")
    discard(filed)
    return out


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """(id, fp, k1, k2, root, component_id) of every document; the component is the smallest id that links reach."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("id").alias("low")), "simhash-nodes")
    found = links(nodes.select("fp"), distance)
    roots = components(found, "simhash-links")
    discard(found)
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    named = linked.join(lows, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select("id", "fp", "k1", "k2", "root", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One document of every component: that with the smallest id, nulls last; of several with that id or of repeated rows, one."""
    order = F.struct(F.col("id").isNull().alias("last"), "id", "k1", "k2")
    first = classes(docs, id_col, text_col, shingle, distance).groupBy("root").agg(F.min(order).alias("f")).select("f.k1", "f.k2")
    named = dict(zip(("__k1", "__k2"), _keys(id_col, text_col), strict=True))
    kept = docs.withColumns(named).join(first.toDF("__k1", "__k2"), ["__k1", "__k2"], "left_semi")
    return kept.dropDuplicates(["__k1", "__k2"]).drop("__k1", "__k2")
