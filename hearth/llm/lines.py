"""Removal of repeated lines: an edit-distance join on segments.

Two lines within ``threshold`` edits share one of ``threshold + 1`` segments of the
shorter line, near its place. Every distinct line is filed under (its length, number of
the segment, segment) and looks up, for every length up to ``threshold`` below its own,
the substrings that can match such a segment: those whose shift agrees with the edits
that may lie left and right of it. Lines that meet are verified by a banded bit-parallel
edit distance, one word of 2 * threshold + 1 bits for each number of errors.

Equal lines are one node, however often they occur. A segment with more than
``pair_limit`` lines is not joined with its probes when the threshold is 1: its lines
are filed under themselves with one character left out (and its place), where lines
that differ in that character meet, and under themselves as a shorter line, where those
with one character more meet. Lines that only share such a shorter form are two edits apart
and are not linked by it. That is exact up to 128-bit hashes, and links each to one line
instead of all pairs.

Linked lines form classes. Of a class with at least ``min_count`` occurrences the first
stays (smallest id, nulls last, then text and line number); the others are removed.
Equal lines form a class whatever their length; lines shorter than ``min_chars`` are not
joined with others by edits. Blank lines are left alone. Null texts have no lines. Repeated
rows (same id and text) are one document and are treated alike. Lines of any length are compared whole. ``remove``
keeps other columns, but for ones named like those that it adds, which are replaced; ``clean`` keeps all. An
empty table gives an empty one.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import components, discard, map_batches, materialize, slices
from hearth.operators.lookup import join_per_key

THRESHOLD = 1
#: Lines of fewer characters are joined only when equal: one edit is a large part of them.
MIN_CHARS = 20
#: A line that is not blank.
SOME = "[^\\x20\\x09-\\x0D]"
PAIR_LIMIT = 16
#: Forms of a line in a hot group: without a character and with its place, without a character, the line itself.
PLACED, BARE, WHOLE = 0, 1, 2


def segments(n: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of the nearly equal segments of a line of n characters."""
    base, longer = divmod(n, parts)
    out, at = [], 0
    for i in range(parts):
        size = base + (i >= parts - longer)
        out.append((at, size))
        at += size
    return out


def keys(line: str, threshold: int) -> tuple[list[int], list[tuple[int, bool]]]:
    """Hashes under which a line is filed, and those it looks up; the latter with whether they are of its own length."""
    n, hash_ = len(line), xxhash.xxh3_64_intdigest
    data = line.encode("utf-8", "surrogatepass")
    plain = len(data) == n  # characters are bytes

    def of(length: int, part: int, start: int, width: int) -> int:
        s = data[start : start + width] if plain else line[start : start + width].encode("utf-8", "surrogatepass")
        return hash_(s, length << 16 | part) - (1 << 63)

    filed = [of(n, i, a, w) for i, (a, w) in enumerate(segments(n, threshold + 1))]
    probes = []
    for length in range(max(0, n - threshold), n + 1):
        more = n - length
        for i, (a, w) in enumerate(segments(length, threshold + 1)):
            first = max(0, a - i, a + more - (threshold - i))
            last = min(n - w, a + i, a + more + (threshold - i))
            probes += [(filed[i] if not more and s == a else of(length, i, s, w), more == 0) for s in range(first, last + 1)]
    return filed, probes


def within(a: str, b: str, threshold: int) -> bool:
    """Whether the edit distance of two lines is at most ``threshold``."""
    if abs(len(a) - len(b)) > threshold:
        return False
    start, end = 0, min(len(a), len(b))
    if a[:end] == b[:end]:
        return True
    while start < end and a[start] == b[start]:
        start += 1
    tail = 0
    while tail < end - start and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[start : len(a) - tail], b[start : len(b) - tail]
    width = 2 * threshold + 1
    band = (1 << width) - 1
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << (i + threshold)
    # bit d of live[e]: with e errors the first j characters of b match the first j + d - threshold of a
    live, bit = [], 1 << threshold
    for e in range(threshold + 1):
        live.append(bit | (live[e - 1] << 1 if e else 0))
    for j, c in enumerate(b):
        match = places.get(c, 0) >> j & band
        new = [live[0] & match]
        for e in range(1, threshold + 1):
            new.append(((live[e] & match) | live[e - 1] | live[e - 1] >> 1 | new[e - 1] << 1) & band)
        live = new
        if not live[-1]:
            return False
    return bool(live[-1] >> (len(a) - len(b) + threshold) & 1)


def links(lines: DataFrame, threshold: int, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Links (a, b) between distinct ``lines`` (lid, line) that connect all within ``threshold`` edits."""

    def make():
        def step(batch: pa.RecordBatch):
            for b in slices(batch, 1):
                out: tuple[list, ...] = ([], [], [], [])
                for lid, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    filed, probes = keys(line, threshold)
                    probes = [p for p in probes if not (p[1] and p[0] in filed)]  # a filed row looks up its own key
                    out[0].extend(filed + [k for k, _ in probes])
                    out[1].extend([lid] * (len(filed) + len(probes)))
                    out[2].extend([True] * len(filed) + [False] * len(probes))
                    out[3].extend([True] * len(filed) + [same for _, same in probes])
                types = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["key", "lid", "filed", "same"])

        return step

    every = materialize(map_batches(lines.select("lid", "line"), make, "key bigint, lid bigint, filed boolean, same boolean"), "line-every")
    # only keys with a filed line and someone else's probe can link
    met = every.groupBy("key").agg(F.count_if("filed").alias("n"), F.min("lid").alias("lo"), F.max("lid").alias("hi")).where("n > 0 and lo < hi").select("key", "n")
    live = materialize(every.join(met, "key"), "line-keys")
    discard(every)
    usual = live.where(F.col("n") <= pair_limit) if threshold == 1 else live
    filed, probes = usual.where("filed").select("key", F.col("lid").alias("a")), usual.select("key", F.col("lid").alias("b"), "same")
    pairs = filed.join(probes, "key").where((F.col("a") < F.col("b")) | (~F.col("same") & (F.col("a") != F.col("b")))).select("a", "b").distinct()
    text = lines.select("lid", "line")
    pairs = pairs.join(text.withColumnsRenamed({"lid": "a", "line": "la"}), "a").join(text.withColumnsRenamed({"lid": "b", "line": "lb"}), "b")

    def verify():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            return b.filter(pa.array([within(x, y, threshold) for x, y in zip(b.column("la").to_pylist(), b.column("lb").to_pylist(), strict=True)], pa.bool_())).select(["a", "b"])

        return step

    found = map_batches(pairs, verify, "a bigint, b bigint")
    if threshold != 1:
        return _written(found, live)
    hot = live.where(F.col("n") > pair_limit).select("lid").distinct().join(text, "lid")
    left_out = map_batches(hot, _left_out, "x binary, lid bigint, kind int")
    # lines that share a form with its place differ there only; of those that share one without, only the line equal to it is one edit away
    whole, low = F.min(F.when(F.col("kind") == WHOLE, F.col("lid"))), F.min(F.when(F.col("kind") == PLACED, F.col("lid")))
    centre = left_out.groupBy("x").agg(F.coalesce(whole, low).alias("a"), F.count("*").alias("n")).where("n > 1 and a is not null")
    stars = left_out.join(centre.select("x", "a"), "x").where("lid <> a").select("a", F.col("lid").alias("b"))
    return _written(found.union(stars), live)


def _written(links: DataFrame, made_from: DataFrame) -> DataFrame:
    out = materialize(links, "line-pairs")
    discard(made_from)
    return out


def _left_out():
    """A line without each of its characters: with the place, for lines that differ there; without, for lines one shorter."""
    h = xxhash.xxh3_128_digest

    def step(b: pa.RecordBatch):
        for lid, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            cuts = [(line[:i] + line[i + 1 :]).encode("utf-8", "surrogatepass") for i in range(len(line))]
            xs = [h(c, seed=i + 1) for i, c in enumerate(cuts)] + [h(c) for c in {*cuts}] + [h(line.encode("utf-8", "surrogatepass"))]
            kinds = [PLACED] * len(cuts) + [BARE] * (len(xs) - len(cuts) - 1) + [WHOLE]
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), pa.array([lid] * len(xs), pa.int64()), pa.array(kinds, pa.int32())], names=["x", "lid", "kind"])

    return step


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    t = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r")
    return docs.select(row, F.col(f"`{id_col}`").cast("bigint").alias("id"), t.alias("text"), F.xxhash64(t, F.lit(1)).alias("h"))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, min_count: int = 2) -> DataFrame:
    """(id, h, dups): for documents with lines of a class of ``min_count`` or more, those lines.

    ``dups`` is an array of (line, first_id, first_line): number of the line and the first occurrence of its class.
    ``h`` is a hash of the text, for documents that share an id.
    """
    each = _keyed(docs, id_col, text_col).select("id", "h", F.posexplode(F.split("text", "\n")).alias("no", "line")).where(F.col("line").rlike(SOME))
    lines = each.groupBy("line").agg(F.count("*").alias("n")).select(F.monotonically_increasing_id().alias("lid"), "line", F.xxhash64("line").alias("x"), F.xxhash64(F.lit(7), "line").alias("y"))
    lines = materialize(lines, "lines")  # numbers are fixed from here on
    found = links(lines.where(F.char_length("line") >= min_chars), threshold)
    roots = components(found, "line-links")
    discard(found)
    classes = lines.select("lid", "x", "y").join(roots.withColumnRenamed("node", "lid"), "lid", "left").select("x", "y", F.coalesce("root", "lid").alias("class"))
    slim = each.select("id", "h", "no", F.xxhash64("line").alias("x"), F.xxhash64(F.lit(7), "line").alias("y"))
    placed = materialize(slim.join(classes, ["x", "y"]).select("class", "id", "h", "no"), "line-places")
    discard(lines)
    order = F.struct(F.col("id").isNull().alias("last"), "id", "h", "no")
    first = placed.groupBy("class").agg(F.count("*").alias("n"), F.min(order).alias("f")).where(F.col("n") >= max(2, min_count))
    dup = F.struct(F.col("no").alias("line"), F.col("f.id").alias("first_id"), F.col("f.no").alias("first_line"), (order == F.col("f")).alias("is_first"))
    met = join_per_key(placed, first, ["class"], ["h", "no"]).where("n IS NOT NULL")  # a class that holds much of all lines is spread
    return met.groupBy("id", "h").agg(F.sort_array(F.collect_set(dup)).alias("dups"))  # bounded by the document's lines


def remove(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, min_count: int = 2,
) -> DataFrame:
    """``docs`` with the text without repeated lines, and dups, n_lines, n_removed (lines) and removed_chars."""
    dups = duplicates(docs, id_col, text_col, threshold, min_chars, min_count).withColumnsRenamed({"id": "__id", "h": "__h"})
    keyed = _keyed(docs, id_col, text_col)
    joined = keyed.join(dups, F.col("id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")), "left")
    out = joined.select("r", "text", F.coalesce("dups", F.array().cast(dups.schema["dups"].dataType)).alias("dups")).withColumn("__l", F.split("text", "\n"))
    out = out.withColumn("__gone", F.transform(F.filter("dups", lambda d: ~d["is_first"]), lambda d: d["line"]))
    kept = F.array_join(F.filter("__l", lambda _, i: ~F.array_contains("__gone", i)), "\n")
    others = [F.col("r")[c].alias(c) for c in docs.columns if c not in (text_col, "dups", "n_lines", "n_removed", "removed_chars")]
    return out.select(
        *others, F.when(F.size("__gone") == 0, F.col("r")[text_col]).otherwise(kept).alias(text_col), "dups",
        F.size("__l").alias("n_lines"), F.size("__gone").alias("n_removed"),
        (F.char_length("text") - F.when(F.size("__gone") == 0, F.char_length("text")).otherwise(F.char_length(kept))).alias("removed_chars"),
    )


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_share: float = 0.8, **options) -> DataFrame:
    """``docs`` without repeated lines, and without documents that lose ``drop_share`` or more of their characters so."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    boxed = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))  # names cannot clash
    done = remove(boxed, "id", "text", **options)
    left = F.char_length(F.coalesce("text", F.lit("")))
    gone = F.col("removed_chars") >= (left + F.col("removed_chars")) * drop_share
    return done.where((F.col("n_removed") == 0) | ~gone).select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
