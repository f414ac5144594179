"""Importance resampling towards a target: documents whose features are likelier in the target are drawn more often.

Features are the runs of 1 to ``grams`` consecutive words, hashed into ``buckets``. All documents and
all texts of the target are counted; a bucket's gain is the logarithm of the ratio of its two
smoothed shares, a document's weight the mean gain of its features, its score the weight and a
Gumbel number that follows from its id, and the documents with the highest scores are drawn.

Lines are not counted again and again: newlines separate words, so they cut a text into segments.
Every distinct line's features are hashed once and counted as often as the line occurs, and its gain
is summed up once and joined back to the documents that have it. Features that reach from one
line into the next are counted for each text by itself. So a line that a third of all documents
share costs one count; lines meet documents in an equality join, which adaptive execution splits.

Counts, gains and weights are whole numbers, so the order of tasks changes nothing. The gains (one
number a bucket) go to the tasks, nothing else leaves them whole. Draws are placed by sorted ranges.

A null text has no words. Documents without features have weight 0; a bucket without
occurrences has a gain like any other. Without a document of ``least_words`` nobody is drawn. Ties go
to the smaller id, nulls last; repeated rows are documents of their own, whose places are
arbitrary among themselves. Lines are told apart by 128-bit hashes.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from hearth.llm.common import discard, fields, map_batches, materialize, slices
from hearth.operators.ranking import number_rows

BUCKETS = 10000
GRAMS = 1
SEED = 2024
LEAST_WORDS = 20
#: Share of the documents long enough that is drawn.
DRAWN = (10, 100)

# Words are runs of digits, letters and characters beyond ASCII; A-Z count as a-z.
_WORDS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split()


def features(ws: list[bytes], grams: int, buckets: int) -> np.ndarray:
    """Buckets of all runs of 1 to ``grams`` words."""
    runs = ws if grams == 1 else [b" ".join(ws[i : i + n]) for n in range(1, grams + 1) for i in range(len(ws) - n + 1)]
    return np.fromiter(map(crc32, runs), np.uint32, len(runs)) % np.uint32(buckets)


def across(lines: list[list[bytes]], grams: int, buckets: int) -> np.ndarray:
    """Buckets of the runs of words that begin in one line and end in a later one."""
    ws = [w for line in lines for w in line]
    line_of = [i for i, line in enumerate(lines) for _ in line]
    runs = [b" ".join(ws[i : i + n]) for n in range(2, grams + 1) for i in range(len(ws) - n + 1) if line_of[i] != line_of[i + n - 1]]
    return np.fromiter(map(crc32, runs), np.uint32, len(runs)) % np.uint32(buckets)


def _line_key(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def _documents(docs: DataFrame, grams: int, buckets: int) -> DataFrame:
    """(row, id, lines, across): the keys of a document's lines, and its features (with their words) across lines."""
    source = docs.select(F.monotonically_increasing_id().alias("row"), "id", "text")

    def make():
        def step(batch: pa.RecordBatch):
            for b in slices(batch, 2):
                lines = [(t or "").split("\n") for t in b.column(2).to_pylist()]
                keys = pa.array([[_line_key(x) for x in own if x and not x.isspace()] for own in lines], pa.list_(pa.binary()))
                over = pa.array([across([words(x) for x in own], grams, buckets).astype("<u4").tobytes() if grams > 1 else b"" for own in lines], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), keys, over], names=["row", "id", "lines", "across"])

        return step

    return map_batches(source, make, fields("row bigint", StructField("id", source.schema["id"].dataType), "lines array<binary>, across binary"))


def _distinct_lines(docs: DataFrame, grams: int, buckets: int) -> DataFrame:
    """(line, times, n_words, buckets) of every distinct line with words: how often it occurs in all documents, and its features."""
    each = docs.select(F.explode(F.split("text", "\n")).alias("text")).where(F.col("text").rlike("[0-9A-Za-z\\x{80}-\\x{10FFFF}]"))
    counted = each.groupBy("text").agg(F.count("*").alias("times"))

    def make():
        def step(batch: pa.RecordBatch):
            for b in slices(batch, 0):
                texts = b.column(0).to_pylist()
                lines = [words(t) for t in texts]
                found = pa.array([features(ws, grams, buckets).astype("<u4").tobytes() for ws in lines], pa.binary())
                cols = [pa.array(list(map(_line_key, texts)), pa.binary()), b.column(1), pa.array(list(map(len, lines)), pa.int64()), found]
                yield pa.RecordBatch.from_arrays(cols, names=["line", "times", "n_words", "buckets"])

        return step

    return map_batches(counted, make, "line binary, times bigint, n_words bigint, buckets binary")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all rows one after the other, and how many each row has."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<u4"), np.array([len(r) // 4 for r in rows], np.int64)


def _totals(parts: DataFrame, buckets: int) -> np.ndarray:
    """Features by bucket of the rows (times, buckets): one row a bucket and task is shuffled, one a bucket collected."""

    def count(batches):
        sums = np.zeros(buckets, np.int64)
        for b in batches:
            found, n = _flat(b.column(1))
            sums += np.bincount(found, np.repeat(b.column(0).to_numpy(), n), minlength=buckets).astype(np.int64)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(sums[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in parts.select("times", "buckets").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of the target's smoothed share over the source's, floored, by bucket."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    b = float(len(source))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


def _valued(df: DataFrame, column: str, gain: np.ndarray, *keep: str) -> DataFrame:
    """``keep`` with the number (n) and the total gain of the features in ``column``."""
    source = df.select(*keep, column)

    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            found, n = _flat(b.column(len(keep)))
            upto, ends = np.concatenate(([0], np.cumsum(gain[found]))), np.cumsum(n)
            cols = [pa.array(n), pa.array(upto[ends] - upto[ends - n])]
            return pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *cols], names=[*keep, "n", "gain"])

        return step

    return map_batches(source, make, fields(*[source.schema[k] for k in keep], "n bigint, gain bigint"))


def _gumbel(seed: int) -> Column:
    """1000 times a Gumbel number from the document's id, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, drawn: tuple[int, int] = DRAWN) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; ``rank`` is null if it is not drawn."""
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    aim = target.select(F.lit(0).alias("id"), F.col(f"`{target_col}`").cast("string").alias("text"))
    rows = materialize(_documents(own, grams, buckets), "resample-rows")  # the row numbers are fixed from here on
    lines = materialize(_distinct_lines(own, grams, buckets), "resample-lines")
    over = lambda d: d.select(F.lit(1).cast("bigint").alias("times"), F.col("across").alias("buckets"))
    counted, aimed = lines, _distinct_lines(aim, grams, buckets)
    if grams > 1:
        counted, aimed = (a.select("times", "buckets").union(over(b)) for a, b in ((lines, rows), (aimed, _documents(aim, grams, buckets))))
    gain = gains(_totals(counted, buckets), _totals(aimed, buckets))

    parts = rows.select("row", "id", F.explode_outer("lines").alias("line")).join(_valued(lines, "buckets", gain, "line", "n_words"), "line", "left")
    parts = parts.select("row", "id", "n_words", "n", "gain")
    if grams > 1:
        parts = parts.union(_valued(rows, "across", gain, "row", "id").select("row", "id", F.lit(0).cast("bigint"), "n", "gain"))
    summed = parts.groupBy("row", "id").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (("n_words", "__words"), ("n", "n_features"), ("gain", "__gain"))])
    weight = F.when(F.col("n_features") == 0, F.lit(0).cast("bigint")).otherwise(F.expr("(__gain - pmod(__gain, n_features)) div n_features"))
    scored = summed.withColumn("weight", weight).withColumn("score", F.col("weight") + _gumbel(seed)).withColumn("__fits", F.col("__words") >= least_words)
    scored = materialize(scored.select("id", "n_features", "weight", "score", "__fits"), "resample-scores")
    discard(rows, lines)
    places = drawn[0] * scored.where("__fits").count() // drawn[1]
    order = [F.desc("__fits"), F.desc("score"), F.asc_nulls_last("id"), F.asc("weight"), F.asc("n_features")]
    numbered = number_rows(scored, order, "__place")  # writes the rows anew
    discard(scored)
    rank = F.when(F.col("__fits") & (F.col("__place") <= places), F.col("__place"))
    return numbered.select("id", "n_features", "weight", "score", rank.alias("rank"))
