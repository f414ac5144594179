"""Rows of tables: upsert, and splitting off bad rows; folders that Spark can reach."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source``, plus the rows of ``target`` whose key ``source`` does not have."""
    return target.join(source, list(keys), "left_anti").unionByName(source.select(*target.columns))


def _fs(spark: SparkSession, path: str):
    # Spark's Python interface cannot list or delete, so its own file system is asked, for any store
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _found(spark: SparkSession, pattern: str) -> list:
    fs, p = _fs(spark, pattern)
    return list(fs.globStatus(p) or [])


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(_found(spark, path))


def list_paths(spark: SparkSession, pattern: str, folders_only: bool = False) -> list[str]:
    """What matches a pattern, in order of the names; nothing is read."""
    return sorted(s.getPath().toString() for s in _found(spark, pattern) if s.isDirectory() or not folders_only)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


OUTCOME = "outcome"
GOOD, BAD = "good", "quarantined"


def quarantine(df: DataFrame, valid: Column, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(good, quarantined, rows of each): one pass over ``df`` writes and counts both sides.

    Rows that do not fulfil ``valid``, NULL outcomes included, are quarantined. ``path`` is a fresh
    folder, partitioned by outcome, so either side is read without the other; ``df`` has no column ``outcome``.
    """
    ok = F.coalesce(valid, F.lit(False))
    seen = Observation()
    marked = df.withColumn(OUTCOME, F.when(ok, GOOD).otherwise(BAD))
    marked = marked.observe(seen, *[F.count_if(F.col(OUTCOME) == o).alias(o) for o in (GOOD, BAD)])
    marked.write.partitionBy(OUTCOME).parquet(path)
    both = df.sparkSession.read.schema(marked.schema).parquet(path)
    good, bad = (both.where(F.col(OUTCOME) == o).drop(OUTCOME) for o in (GOOD, BAD))
    return good, bad, {o: seen.get[o] for o in (GOOD, BAD)}
