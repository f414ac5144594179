"""Joins by time: latest row per key, exact-or-latest, as-of, prior year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: str | Sequence[str]):
    return F.col(cols) if isinstance(cols, str) else F.struct(*cols)


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with all of these columns present.

    Written as plain IS NOT NULL tests: the optimizer knows them from join keys
    too, so two uses of one source end up with equal plans and share a shuffle.
    """
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
    return df


def latest_per_key(df: DataFrame, keys: Sequence[str], order, cols: Sequence[str]) -> DataFrame:
    """One row per key: the columns of the row with the greatest ``order``.

    An aggregate rather than a sort window: each task keeps one row per key, so a
    hot key costs no more shuffle than any other. Give several order columns to
    break ties.
    """
    return df.groupBy(*keys).agg(*[F.max_by(c, _order(order)).alias(c) for c in cols])


def first_per_key(df: DataFrame, keys: Sequence[str], order, cols: Sequence[str]) -> DataFrame:
    """One row per key: the columns of the row with the smallest ``order``."""
    return df.groupBy(*keys).agg(*[F.min_by(c, _order(order)).alias(c) for c in cols])


def latest_rows(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Every row that carries its key's greatest ``order``; ties stay, NULL keys drop out.

    ``rank() = 1`` is planned with a group limit before the shuffle, so each
    task forwards only its own newest rows.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last())
    return not_null(df, keys).withColumn("__rank", F.rank().over(w)).filter("__rank = 1").drop("__rank")


def join_per_key(df: DataFrame, per_key: DataFrame, keys: Sequence[str], spread_by, copies: int = 8) -> DataFrame:
    """Left join to a table of one row per key, safe for keys that hold much of ``df``.

    Rows of a key are spread by a hash of ``spread_by``, and ``per_key``, which is
    small, is repeated for each share. It is usually the result of an aggregation
    over the same keys; joined directly it would bring along that partitioning,
    and adaptive execution could then not split a hot key. A small ``per_key`` is
    broadcast as ever.
    """
    shares = per_key.withColumn("__share", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    spread = F.pmod(F.hash(*([spread_by] if isinstance(spread_by, str) else spread_by)), F.lit(copies))
    return df.withColumn("__share", spread).join(shares, [*keys, "__share"], "left").drop("__share")


def exact_or_latest(spine: DataFrame, src: DataFrame, keys: Sequence[str], period: str, cols: Sequence[str]) -> DataFrame:
    """Add ``cols`` of ``src``: the row of the same key and period, else the key's newest row.

    The fallback is per column, so a NULL in an exact row is filled too. ``src``
    holds one row per (keys, period).
    """
    src = not_null(src, [*keys, period]).select(*keys, period, *cols)
    exact = src.select(*keys, period, *[F.col(c).alias(f"__exact_{c}") for c in cols])
    newest = latest_per_key(src, keys, period, cols).select(*keys, *[F.col(c).alias(f"__newest_{c}") for c in cols])
    joined = join_per_key(spine.join(exact, [*keys, period], "left"), newest, keys, period)
    return joined.select(
        *spine.columns, *[F.coalesce(f"__exact_{c}", f"__newest_{c}").alias(c) for c in cols]
    )


def exact_or_latest_scalar(spine: DataFrame, src: DataFrame, period: str, col: str) -> DataFrame:
    """``exact_or_latest`` for a series without a key (one national value per period).

    The newest value is a scalar subquery, so no join is needed for it, and an
    empty ``src`` leaves NULL instead of removing every row.
    """
    src = not_null(src, [period]).select(period, col)
    newest = src.agg(F.max_by(col, period)).scalar()
    joined = spine.join(src.withColumnRenamed(col, f"__exact_{col}"), [period], "left")
    return joined.select(*spine.columns, F.coalesce(F.col(f"__exact_{col}"), newest).alias(col))


def asof_left(spine: DataFrame, src: DataFrame, keys: Sequence[str], at: str, since: str, cols: Sequence[str]) -> DataFrame:
    """Add ``cols`` of the last ``src`` row of the same key with ``since <= at``; NULL if there is none.

    Only the distinct (keys, at) pairs go through the sort window, so a group
    holds at most one row per period whatever the number of spine rows behind
    it; the values then return to the spine by an equi-join, whose hot keys
    adaptive execution splits. ``src`` holds one row per (keys, since).
    """
    value = F.struct(*cols)
    wanted = not_null(spine, [*keys, at]).select(*keys, F.col(at).alias("__at")).distinct()
    known = not_null(src, [*keys, since]).select(
        *keys, F.col(since).alias("__at"), value.alias("__value"), F.lit(0).alias("__wanted")
    )
    events = known.unionByName(wanted.withColumn("__wanted", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("__at", "__wanted").rowsBetween(Window.unboundedPreceding, 0)
    filled = (
        events.withColumn("__value", F.last("__value", ignorenulls=True).over(w))
        .filter("__wanted = 1")
        .select(*keys, F.col("__at").alias(at), *[F.col(f"__value.{c}").alias(c) for c in cols])
    )
    return spine.join(filled, [*keys, at], "left").select(*spine.columns, *cols)


def asof_all(spine: DataFrame, keys: Sequence[str], at: str, sources: Sequence[tuple[DataFrame, str, Sequence[str]]], spread_by: str, copies: int = 8) -> DataFrame:
    """Add to every row the last row so far of each of several sources: (source, when it became known, its columns).

    Spine and sources are one stream of events, in which one window carries every source's last value forward;
    the spine is planned, shuffled and sorted once, however many sources there are. The rows of a key are
    spread over ``copies`` shares by a hash of ``spread_by``; the sources, one row per key and period, are repeated for each.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in spine.columns]).alias("__row")
    share = F.pmod(F.xxhash64(spread_by), F.lit(copies)).cast("int").alias("__share")
    events = spine.select(*keys, share, F.col(at).alias("__at"), F.lit(1).alias("__kind"), row)
    for i, (src, since, cols) in enumerate(sources):
        known = not_null(src, [*keys, since]).select(
            *keys, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("__share"), F.col(since).alias("__at"), F.lit(0).alias("__kind"), F.struct(*cols).alias(f"__v{i}")
        )
        events = events.unionByName(known, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "__share").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    filled = events.withColumns({f"__v{i}": F.last(f"__v{i}", ignorenulls=True).over(w) for i in range(len(sources))}).filter("__kind = 1")
    return filled.select("__row.*", *[F.col(f"__v{i}.{c}").alias(c) for i, (_, _, cols) in enumerate(sources) for c in cols])


def with_prior(df: DataFrame, keys: Sequence[str], index: str, lag: int, value: str, prior: str) -> DataFrame:
    """Add the value that the same key had ``lag`` periods earlier, by period number and not by row.

    Every row is emitted for its own period and, as the earlier value, for the
    period ``lag`` later; one aggregation pairs them up. That takes one scan and
    one shuffle where a self-join takes two of each. ``df`` holds one row per
    (keys, index).
    """
    null = F.lit(None).cast(df.schema[value].dataType)
    both = F.array(
        F.struct(F.col(index).alias("i"), F.col(value).alias("cur"), null.alias("old"), F.lit(True).alias("own")),
        F.struct((F.col(index) + lag).alias("i"), null.alias("cur"), F.col(value).alias("old"), F.lit(False).alias("own")),
    )
    return (
        df.select(*keys, F.inline(both))
        .groupBy(*keys, F.col("i").alias(index))
        .agg(F.max("cur").alias(value), F.max("old").alias(prior), F.bool_or("own").alias("__own"))
        .filter("__own")
        .drop("__own")
    )
