"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from hearth.session import discard, materialize

__all__ = ["components", "discard", "fields", "map_batches", "materialize", "parted", "slices", "table", "text_or_empty"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fields(*parts: StructField | tuple[str, DataType] | str) -> StructType:
    """A schema of fields, (name, type) pairs and DDL strings; unlike DDL it takes any name."""
    out: list[StructField] = []
    for p in parts:
        out += [p] if isinstance(p, StructField) else StructType.fromDDL(p).fields if isinstance(p, str) else [StructField(*p)]
    return StructType(out)


#: Bytes of text that a task turns into Python objects at once, and rows.
SLICE_BYTES, SLICE_ROWS = 8 << 20, 2048


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most about ``SLICE_BYTES`` of that text column; a longer text comes alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right"))
        to = min(max(to, at + 1), at + SLICE_ROWS)
        yield batch.slice(at, to - at)
        at = to


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with state built once per task by ``make``."""

    def run(batches):
        step = make()
        for b in batches:
            out = step(b)
            yield from [out] if isinstance(out, pa.RecordBatch) else out
        pa.default_memory_pool().release_unused()  # a worker waits for its next task with what it holds

    return df.mapInArrow(run, schema)


#: Bits of the bitmap by which rows are parted: for each row asked for, and at most (8 MB).
BITS_EACH, MOST_BITS = 16, 1 << 26


def parted(rows: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: all whose ``key`` is one of ``wanted`` with a few others, for a join to tell; and the rest, whose key is none of them.

    A bitmap of bounded size tells them, so it may go to all tasks; a full one only sends more rows to the join.
    """
    bits = min(MOST_BITS, max(1 << 15, 1 << (BITS_EACH * wanted.count()).bit_length()))
    spot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1  # these functions count from 1
    bucket, at = F.bitmap_bucket_number(spot), F.bitmap_bit_position(spot)
    marks = wanted.select(bucket.alias("bucket"), at.alias("at")).distinct().groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("marks"))
    byte = F.conv(F.hex(F.substring("marks", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    met = rows.withColumn("bucket", bucket).join(F.broadcast(marks), "bucket", "left")
    may = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return met.where(may).select(*rows.columns), met.where(~may).select(*rows.columns)


#: Links that one file holds at least, if there are as many.
LINKS_PER_FILE = 200_000


def _successor(old: DataFrame, new: DataFrame, name: str, rows: int) -> DataFrame:
    """``new`` (of about ``rows`` rows) as a written table, few links in few files; ``old``, from which it was made, is deleted."""
    out = materialize(new.coalesce(1 + rows // LINKS_PER_FILE), name)
    discard(old)
    return out


def components(edges: DataFrame, name: str = "component") -> DataFrame:
    """Connected components of the undirected links (a, b): one row (node, root), root being the smallest node.

    Alternating large-star and small-star steps, each a grouping and an equality
    join that adaptive execution may split, until the links no longer change.
    Every step is written to the shared folder, so a lost executor costs a re-read.
    """
    spark = edges.sparkSession
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    last = state(e)
    while last[0]:
        # large star: every larger neighbour of a node hangs on the node's smallest neighbour
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        e = _successor(e, large, name, last[0])
        # small star: a node and its smaller neighbours hang on the smallest of them
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        small = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        e = _successor(e, small.distinct(), name, last[0])
        now = state(e)
        if now == last:
            break
        last = now
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()) if last[0] else spark.createDataFrame([], "node bigint, root bigint")
