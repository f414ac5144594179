"""Profiles of a table: counts, ranges, means, NULLs and distinct values of groups, in one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions import stats
from hearth.functions.numeric import half_up

#: Binary logarithm of a sketch's buckets; its relative error is about 0.8 / sqrt(2 ** SKETCH_BITS).
SKETCH_BITS = 14


def profile(
    df: DataFrame,
    by: Sequence[str] = (),
    rows: str = "row_count",
    span: str | None = None,
    span_names: tuple[str, str] = ("earliest", "latest"),
    mean: Mapping[str, tuple[str, int, int]] | None = None,
    least: Mapping[str, str] | None = None,
    most: Mapping[str, str] | None = None,
    newest: Mapping[str, tuple[str, str]] | None = None,
    nulls: Mapping[str, str] | None = None,
    holding: Mapping[str, Column] | None = None,
    distinct: Mapping[str, str] | None = None,
    sketches: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row for each group (or one for all), from one pass with a partial step in every task.

    ``span`` is the column whose smallest and greatest values are named by ``span_names``. Of the others, each maps the names of
    result columns: ``mean`` to (column, decimals of its values, decimals of the mean), ``least`` and ``most`` to a
    column, ``newest`` to (column, what orders it), ``nulls`` to a column whose NULLs are counted, ``holding`` to a condition
    whose rows are, ``distinct`` to a column whose values are counted exactly, and ``sketches`` to one whose
    distinct values go into a sketch. Sketches of several profiles can be merged (``merged``), exact counts cannot.
    """
    aggs = [F.count("*").alias(rows)]
    if span:
        aggs += [F.min(span).alias(span_names[0]), F.max(span).alias(span_names[1])]
    aggs += [half_up(stats.exact_mean(c, own), places).alias(n) for n, (c, own, places) in (mean or {}).items()]
    aggs += [F.min(c).alias(n) for n, c in (least or {}).items()]
    aggs += [F.max(c).alias(n) for n, c in (most or {}).items()]
    aggs += [F.max_by(c, o).alias(n) for n, (c, o) in (newest or {}).items()]
    aggs += [F.count_if(F.col(c).isNull()).alias(n) for n, c in (nulls or {}).items()]
    aggs += [F.count_if(c).alias(n) for n, c in (holding or {}).items()]
    aggs += [F.count_distinct(c).alias(n) for n, c in (distinct or {}).items()]
    aggs += [F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias(n) for n, c in (sketches or {}).items()]
    return df.groupBy(*by).agg(*aggs)


def merged(profiles: DataFrame, by: Sequence[str] = (), rows: str = "row_count", least: Sequence[str] = (), most: Sequence[str] = (), sums: Sequence[str] = (), sketches: Sequence[str] = ()) -> DataFrame:
    """Profiles of several loads as one: rows and ``sums`` add up, ranges widen, sketches unite; the data are not read again."""
    aggs = [F.sum(c).alias(c) for c in (rows, *sums)] + [F.min(c).alias(c) for c in least] + [F.max(c).alias(c) for c in most]
    return profiles.groupBy(*by).agg(*aggs, *[F.hll_union_agg(c).alias(c) for c in sketches])


def estimated(df: DataFrame, *sketches: str) -> DataFrame:
    """``df`` with sketches replaced by the numbers of distinct values that they estimate."""
    return df.withColumns({c: F.hll_sketch_estimate(c) for c in sketches})


def columns_profile(df: DataFrame) -> DataFrame:
    """(column_name, row_count, null_count, least, most, values): a row for every column, from one pass.

    ``least`` and ``most`` are in the column's own order, as text; ``values`` is a sketch of its distinct values.
    """
    plain = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "array", "struct", "variant", "binary")]
    each = [
        F.struct(
            F.lit(c).alias("column_name"), F.count("*").alias("row_count"), F.count_if(F.col(f"`{c}`").isNull()).alias("null_count"),
            F.min(f"`{c}`").cast("string").alias("least"), F.max(f"`{c}`").cast("string").alias("most"),
            F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), SKETCH_BITS).alias("values"),
        )
        for c in plain
    ]
    return df.agg(F.array(*each).alias("p")).select(F.inline("p"))


def newest_row(df: DataFrame, order: str) -> DataFrame:
    """The row with the greatest ``order``, from one aggregate; none for an empty table."""
    row = F.max_by(F.struct(*df.columns), order)
    return df.agg(row.alias("r")).where("r IS NOT NULL").select("r.*")


def top(df: DataFrame, order: Sequence[Column], count: int) -> DataFrame:
    """The first ``count`` rows in an order; each task passes on that many at most."""
    return df.orderBy(*order).limit(count)
