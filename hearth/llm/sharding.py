"""Shards of near equal bytes by sampled splitters.

Rows are ordered by their key, then by a number given to each row when the table
is first written. A sample in which a row's chance is in proportion to its size
gives splitters at its quantiles, and the rows are dealt into the ranges between
them. A range that holds more than its share is subdivided by splitters sampled
from it alone; the row number lets a single hot key be split too. Ranges are small,
so each is summed up in one task; from the ranges' totals, one row each, follows
the place of every row in the whole, in bytes and in rows. A row belongs to the
shard in which the middle of its bytes falls, so a shard misses the ideal size by
at most half a row at each end.

Null keys come first. Rows may repeat; each keeps its place. Sizes must be at least 1. Other columns stay, but for
ones named shard or slot, which are replaced. An empty table gives an empty one; one row larger than a shard's share
is not divided, whatever its size.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import map_batches, materialize

#: Ranges for each shard, sampled keys for each range, and the factor over the mean size beyond which a range is subdivided.
RANGES_PER_SHARD = 16
SAMPLES_PER_RANGE = 32
OVERFULL = 2.0
#: Rows that a range should not exceed by much, as one task sums it up.
ROWS_PER_RANGE = 1_000_000


def _sample(df: DataFrame, wanted: int, total: int, seed: int) -> list[tuple[int, int]]:
    """About ``wanted`` keys (key, row), drawn in proportion to size."""
    chance = F.col("size") * (wanted / max(1, total))
    draw = F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    return sorted((r[0], r[1]) for r in df.where(draw < chance).select("k", "row").collect())  # bounded by the number of ranges


def _quantiles(sample: list[tuple[int, int]], ranges: int) -> list[tuple[int, int]]:
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if len(sample) >= ranges else sorted(set(sample))


def _ranged(df: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """Adds ``range``: how many splitters are not above the row."""

    def make():
        keys = np.array([s[0] for s in splitters], np.int64)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            k, row = b.column(0).to_numpy(), b.column(1).to_numpy()
            low, high = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
            for i in np.flatnonzero(low < high):  # a splitter with this very key
                low[i] = bisect_right(splitters, (int(k[i]), int(row[i])), int(low[i]), int(high[i]))
            return pa.RecordBatch.from_arrays([*b.columns, pa.array(low.astype(np.int32))], names=["k", "row", "size", "range"])

        return step

    return map_batches(df, make, "k bigint, row bigint, size bigint, range int")


def shard(df: DataFrame, shards: int, key: str, size: str) -> DataFrame:
    """``df`` with shard (0 to ``shards`` - 1) and slot (gapless from 0 in each shard). ``key`` is a whole number."""
    names = [c for c in df.columns if c not in ("shard", "slot")]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("r"), F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{size}`").cast("bigint").alias("size"))
    rows = materialize(rows.select("*", F.monotonically_increasing_id().alias("row")), "shard-rows")  # the numbers are fixed from here on
    count, total = rows.agg(F.count("*"), F.sum("size")).first()
    if not count:
        return df.select(*[F.col(f"`{c}`") for c in names], F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot")).limit(0)
    lowest = F.lit(-(1 << 63))
    keyed = rows.select(F.coalesce("k", lowest).alias("k"), "row", "size")
    ranges = max(shards * RANGES_PER_SHARD, -(-count // ROWS_PER_RANGE))
    splitters = _quantiles(_sample(keyed, ranges * SAMPLES_PER_RANGE, total, 1), ranges)
    for seed in range(2, 12):
        dealt = _ranged(keyed, splitters)
        sums = dealt.groupBy("range").agg(F.sum("size").alias("bytes"), F.max("size").alias("most"), F.count("*").alias("n")).collect()  # one row a range
        # one very large row cannot be divided, so it does not count
        full = {r["range"]: r["bytes"] for r in sums if r["bytes"] - r["most"] > OVERFULL * total / ranges or r["n"] > 2 * ROWS_PER_RANGE}
        if not full:
            break
        inside = dealt.where(F.col("range").isin(list(full)))
        more = _sample(inside, 2 * SAMPLES_PER_RANGE * -(-sum(full.values()) * ranges // total), sum(full.values()), seed)
        new = sorted({*splitters, *_quantiles(more, max(2, len(more) // SAMPLES_PER_RANGE))})
        if new == splitters:
            break
        splitters = new
    before, at_byte, at_row = [], 0, 0
    for r in sorted(sums, key=lambda r: r["range"]):
        before.append((r["range"], at_byte, at_row))
        at_byte, at_row = at_byte + r["bytes"], at_row + r["n"]
    starts = df.sparkSession.createDataFrame(before, "range int, first_byte bigint, first_row bigint")
    w = Window.partitionBy("range").orderBy("k", "row")
    placed = dealt.withColumn("b", F.sum("size").over(w) - F.col("size")).withColumn("i", F.row_number().over(w).cast("bigint") - 1)
    middle = (F.col("first_byte") + F.col("b")) * 2 + F.col("size")
    placed = placed.join(starts, "range").select(
        "row", (F.col("first_row") + F.col("i")).alias("place"),
        F.least(F.lit(shards - 1), F.floor(middle.cast("decimal(38,0)") * shards / F.lit(2 * total).cast("decimal(38,0)"))).cast("int").alias("shard"),
    )
    placed = materialize(placed, "shard-places")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row a shard
    slots = placed.join(F.broadcast(first), "shard").select("row", "shard", (F.col("place") - F.col("first")).alias("slot"))
    return rows.join(slots, "row").select("r.*", "shard", "slot")
