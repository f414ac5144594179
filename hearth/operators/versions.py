"""Versioned tables: a warehouse changes from one complete set of tables to the next.

Every write of a table goes to a fresh folder. Which folders are current is said by one small
manifest row, written last for all tables together: until then readers see the old set, from
then on the new one, and a run that is cut off anywhere leaves only folders that nothing names. ``prune``
deletes those and the ones that only older versions name.

A table has one folder, or, if it was merged, one for each of its partitions; a merge
writes the partitions that it touches and keeps the folders of all others as they are.
There is one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hearth.operators.upsert import delete, list_paths, path_exists, upsert

#: Folder of the manifest rows below the warehouse. A row appears whole, as the one file of its write.
MANIFEST = "versions"
#: Names of the columns that tables are only stored by end so.
PART = "_part"
_ROW = "version bigint, tables map<string, array<string>>"


def _manifest(spark: SparkSession, warehouse: str) -> DataFrame | None:
    path = f"{warehouse}/{MANIFEST}"
    return spark.read.schema(_ROW).json(path) if path_exists(spark, f"{path}/*.json") else None


def current(spark: SparkSession, warehouse: str) -> tuple[int, dict[str, list[str]]]:
    """Number of the newest version and the folders of its tables, below the warehouse; 0 and none before the first."""
    rows = _manifest(spark, warehouse)
    newest = rows.agg(F.max("version"), F.max_by("tables", "version")).first() if rows else (None, None)
    return newest[0] or 0, {k: list(v) for k, v in (newest[1] or {}).items()}


def read(spark: SparkSession, warehouse: str, name: str, schema=None, stored: bool = False) -> DataFrame:
    """A table as the newest version has it; with ``stored``, also the columns that it is only stored by."""
    _, tables = current(spark, warehouse)
    if name not in tables:
        raise FileNotFoundError(f"{warehouse} has no table {name}")
    return _open(spark, warehouse, tables[name], schema, stored)


def _open(spark: SparkSession, warehouse: str, folders: Sequence[str], schema=None, stored: bool = False) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*[f"{warehouse}/{f}" for f in folders])
    return df if stored else df.drop(*[c for c in df.columns if c.endswith(PART)])


@dataclass
class Draft:
    """The next version while it is written. ``rows`` counts what each write wrote."""

    spark: SparkSession
    warehouse: str
    version: int
    tables: dict[str, list[str]]
    rows: dict[str, int] = field(default_factory=dict)

    def _fresh(self, name: str) -> str:
        return f"{name}/v{self.version:06d}-{uuid.uuid4().hex[:8]}"

    def _counted(self, df: DataFrame, name: str):
        seen = Observation()
        return df.observe(seen, F.count(F.lit(1)).alias("n")), seen

    def write(self, name: str, df: DataFrame, part: Sequence[str] = ()) -> DataFrame:
        """Replace a table as a whole, stored by the columns in ``part``, whose names end in ``PART``; ``df`` may read the table's own current version."""
        folder = self._fresh(name)
        counted, seen = self._counted(df, name)
        writer = counted.hint("rebalance", *part).write.partitionBy(*part) if part else counted.write
        writer.parquet(f"{self.warehouse}/{folder}")
        self.rows[name] = seen.get["n"]
        self.tables[name] = [folder]
        return _open(self.spark, self.warehouse, [folder], df.schema)

    def merge(self, name: str, df: DataFrame, keys: Sequence[str], part: str) -> DataFrame:
        """Upsert the rows of ``df`` by ``keys``, of which ``part`` is one; only its values that ``df`` has are written."""
        values = [r[0] for r in df.select(F.col(part).cast("string")).distinct().collect()]  # one a partition
        label = f"{part}{PART}"
        touched = {f"{label}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for v in values}
        old = self.tables.get(name, [])
        kept = [f for f in old if f.rsplit("/", 1)[1].startswith(f"{label}=") and f.rsplit("/", 1)[1] not in touched]
        again = [f for f in old if f not in kept]
        merged = upsert(_open(self.spark, self.warehouse, again, df.schema), df, keys) if again else df
        folder = self._fresh(name)
        counted, seen = self._counted(merged.withColumn(label, F.col(part).cast("string")), name)
        counted.hint("rebalance", label).write.partitionBy(label).parquet(f"{self.warehouse}/{folder}")
        self.rows[name] = seen.get["n"]
        written = list_paths(self.spark, f"{self.warehouse}/{folder}/{label}=*", folders_only=True)
        self.tables[name] = kept + sorted(f"{folder}/{w.rsplit('/', 1)[1]}" for w in written)
        return _open(self.spark, self.warehouse, self.tables[name], df.schema)

    def commit(self) -> int:
        """Make this version the current one, all tables at once."""
        row = self.spark.createDataFrame([(self.version, self.tables)], _ROW)
        row.coalesce(1).write.mode("append").json(f"{self.warehouse}/{MANIFEST}")
        return self.version


def begin(spark: SparkSession, warehouse: str) -> Draft:
    """A draft of the next version; it starts with the current tables."""
    version, tables = current(spark, warehouse)
    return Draft(spark, warehouse, version + 1, tables)


def replace(spark: SparkSession, warehouse: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Replace several tables in one version."""
    draft = begin(spark, warehouse)
    out = {name: draft.write(name, df) for name, df in tables.items()}
    draft.commit()
    return out


def prune(spark: SparkSession, warehouse: str, keep: int = 2) -> list[str]:
    """Delete the folders that none of the newest ``keep`` versions names; returns them. Not while a draft is written."""
    rows = _manifest(spark, warehouse)
    if rows is None:
        return []
    recent = rows.orderBy(F.desc("version")).limit(keep).collect()
    names = {name for r in rows.select(F.explode(F.map_keys("tables"))).distinct().collect() for name in r}
    used = {"/".join(f.split("/")[: name.count("/") + 2]) for r in recent for name, v in r["tables"].items() for f in v}
    gone = []
    for name in sorted(names):
        for path in list_paths(spark, f"{warehouse}/{name}/v*", folders_only=True):
            folder = f"{name}/{path.rsplit('/', 1)[1]}"
            if folder not in used:
                delete(spark, path)
                gone.append(folder)
    return gone
