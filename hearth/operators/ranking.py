"""Ranking over a whole table, without a window that meets all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.session import materialize


def preceding(df: DataFrame, order: Sequence[Column], amount: Column, name: str) -> DataFrame:
    """Add ``name``: the total ``amount`` (whole numbers) of all rows before a row in the given order.

    Rows are dealt into sorted ranges and written once, so that their dealing is fixed.
    Each range sums up its own rows; the ranges' totals, one number for each partition,
    are added up on the driver. ``order`` should leave few ties, as equal rows share a range;
    among them the order is arbitrary.
    """
    ranged = df.repartitionByRange(*order).withColumns({"__part": F.spark_partition_id(), "__amount": amount.cast("bigint")})
    rows = materialize(ranged, "ranges")
    totals = {r[0]: r[1] for r in rows.groupBy("__part").agg(F.sum("__amount")).collect()}  # one row a partition
    sums = [totals.get(p, 0) for p in range(max(totals, default=-1) + 1)]
    before = F.get(F.lit([0, *accumulate(sums)]).cast("array<bigint>"), F.col("__part"))
    own = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, before + F.coalesce(F.sum("__amount").over(own), F.lit(0))).drop("__part", "__amount")


def rank_desc(df: DataFrame, score: str, name: str) -> DataFrame:
    """Add ``rank() over (order by score desc nulls last)``.

    Equal scores are one row of the distinct scores, whose counts are added up range by range.
    """
    counts = df.groupBy(score).agg(F.count("*").alias("__n"))
    summed = preceding(counts, [F.col(score).desc_nulls_last()], F.col("__n"), "__before")
    ranks = summed.select(F.col(score).alias("__score"), (F.col("__before") + 1).cast("int").alias(name))
    return df.join(ranks, F.col(score).eqNullSafe(F.col("__score")), "left").drop("__score")


def number_rows(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``row_number() over (order by …)`` as a bigint."""
    return preceding(df, order, F.lit(1), "__before").withColumn(name, F.col("__before") + 1).drop("__before")
