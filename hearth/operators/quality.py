"""Data-quality checks. Each returns a DataFrame; an empty one of failures means "passed"."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail early on an empty input."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, null_count, row_count), from one pass over ``df``."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols], F.count("*").alias("row_count"))
    return one.unpivot(["row_count"], list(cols), "column_name", "null_count").select(
        "column_name", "null_count", "row_count"
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def orphans(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose (non-NULL) key the dimension does not have."""
    return df.dropna(subset=list(keys)).join(dim.select(*keys), list(keys), "left_anti")


def missing_keys(expected: DataFrame, found: DataFrame, *keys: str) -> DataFrame:
    """Expected keys that never occur in ``found``."""
    return expected.select(*keys).distinct().join(found.select(*keys).distinct(), list(keys), "left_anti")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def check_results(failures: Mapping[str, DataFrame]) -> DataFrame:
    """(step, status, failed_rows) with one row per check."""
    counted = row_counts(failures)
    return counted.select(
        F.col("table_name").alias("step"),
        F.when(F.col("row_count") == 0, "PASSED").otherwise("FAILED").alias("status"),
        F.col("row_count").alias("failed_rows"),
    )
