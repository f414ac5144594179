"""Session settings and the scratch location for written intermediate tables."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from measured sizes and splits skewed partitions; nothing in
# the library forces a broadcast of a table that can grow.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build(master: str | None = None, app: str = "hearth", **extra) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()


@functools.cache
def _local_base() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="hearth-", ignore_cleanup_errors=True)  # goes with the process


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share.

    Only a local session may leave that setting unset; it then gets a temporary
    folder. On a cluster a machine-local folder would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base().name
    return f"{base.rstrip('/')}/hearth/{name}-{uuid.uuid4().hex[:12]}"


#: While an intermediate table is written: its job's shuffle files go with the job's end (else they stay until the driver happens
#: to collect its garbage), and Python workers get rows, whole texts among them, in small batches.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


@contextmanager
def _writing(spark: SparkSession):
    before = {k: spark.conf.get(k) for k in WRITING}
    try:
        for k, v in WRITING.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to scratch and read it back.

    Cuts lineage at a table that survives the loss of executors, and keeps a
    frame that is used several times from being computed several times.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _writing(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the folders of materialized frames once nothing reads them any more; other frames are left alone."""
    for df in frames:
        path = df.__dict__.pop("_scratch", None)
        if path:
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Materialize independent frames, their jobs running side by side."""
    if not frames:
        return {}
    with _writing(next(iter(frames.values())).sparkSession), ThreadPoolExecutor(len(frames)) as pool:
        return dict(zip(frames, pool.map(materialize, frames.values(), frames.keys())))
