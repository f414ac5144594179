"""Choosing among landed files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from hearth.operators.upsert import list_paths, path_exists


def files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the landed files (or folders of part files) that match a pattern, in order of their names."""
    return list_paths(spark, pattern)


def first_available(spark: SparkSession, candidates: Sequence[str]) -> str:
    """The first path of an ordered list that exists."""
    for path in candidates:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these exist: {list(candidates)}")


def first_readable(spark: SparkSession, candidates: Sequence[str], read: Callable[[str], DataFrame], skipped: list | None = None) -> DataFrame:
    """``read`` of the first path of an ordered list that exists and can be read.

    A path cannot be read if ``read`` raises ValueError, or Spark does. ``skipped`` gets (path, reason) of those passed over.
    """
    passed: list = []
    for path in candidates:
        if not path_exists(spark, path):
            passed.append((path, "absent"))
            continue
        try:
            out = read(path)
        except (ValueError, PySparkException) as e:
            passed.append((path, f"unreadable: {str(e).splitlines()[0][:200]}"))
            continue
        if skipped is not None:
            skipped += passed
        return out
    if skipped is not None:
        skipped += passed
    raise FileNotFoundError(f"none of these can be read: {passed}")
