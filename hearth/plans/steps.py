"""A run as named steps: each has a status and a number of rows, and after a failure the later ones are skipped."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

PASSED, FAILED, SKIPPED = "PASSED", "FAILED", "SKIPPED"


class Failed(RuntimeError):
    """A step's own verdict that it failed, with the rows that made it fail."""

    def __init__(self, message: str, rows: int = 0):
        super().__init__(message)
        self.rows = rows


class Steps:
    def __init__(self) -> None:
        self.done: list[tuple[str, str, int, str]] = []
        self.error: Exception | None = None

    def run(self, name: str, act: Callable[[], tuple[Any, int]]) -> Any:
        """The first part of what ``act`` returns; the second is the step's number of rows. None if it failed or was skipped."""
        if self.error is not None:
            self.done.append((name, SKIPPED, 0, ""))
            return None
        try:
            out, rows = act()
        except Exception as e:
            self.error = e
            self.done.append((name, FAILED, getattr(e, "rows", 0), (str(e).splitlines() or [type(e).__name__])[0][:500]))
            return None
        self.done.append((name, PASSED, rows, ""))
        return out

    def status(self, spark: SparkSession) -> DataFrame:
        """(step, status, row_count, message) in the order of the steps, which ``step_no`` numbers."""
        return spark.createDataFrame([(i, *d) for i, d in enumerate(self.done, 1)], "step_no int, step string, status string, row_count bigint, message string")
