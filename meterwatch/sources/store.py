"""Staged publication: tables written below a run of their own and switched all at once by one manifest entry.

A run's tables lie in `runs/<id>/<table>`. Committing appends one Parquet file with a row per table to the manifest; a
reader follows the manifest, so it sees all tables of a run or none, and a run that breaks off leaves the old ones as they
are. A later run of the same period replaces that period's tables. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from meterwatch.sources import tables

MANIFEST = "seq bigint, run string, period string, name string, path string"


@dataclass(frozen=True)
class Store:
    """Published tables below `root`, by period. A period is named by its first time, so that names sort by time."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"

    def entries(self) -> list[Row]:
        """The valid entries: of every table and period that of the latest run. One row a table and period."""
        try:
            rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest").collect()
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        latest = {(r.name, r.period): r for r in sorted(rows, key=lambda r: (r.seq, r.run))}
        return sorted(latest.values(), key=lambda r: (r.period, r.name))

    def periods(self, name: str) -> list[str]:
        return [r.period for r in self.entries() if r.name == name]

    def read(self, name: str, schema: str | None = None, before: str | None = None) -> DataFrame | None:
        """A table over all its periods, or those before a time; None if there is none."""
        paths = [r.path for r in self.entries() if r.name == name and (before is None or r.period < before)]
        if not paths:
            return None
        if self.fmt == "parquet":
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return reader.parquet(*paths)
        if schema is None:
            return self.spark.read.option("header", True).option("escape", '"').csv(paths)
        return tables.read_csv(self.spark, paths, schema)

    def as_of(self, name: str, before: str | None = None, schema: str | None = None) -> DataFrame | None:
        """A table of the latest period, or of the latest one before a time."""
        periods = [p for p in self.periods(name) if before is None or p < before]
        return self._only(name, max(periods), schema) if periods else None

    def _only(self, name: str, period: str, schema: str | None) -> DataFrame:
        path = next(r.path for r in self.entries() if r.name == name and r.period == period)
        if self.fmt == "parquet":
            return self.spark.read.parquet(path) if schema is None else self.spark.read.schema(schema).parquet(path)
        return self.spark.read.option("header", True).option("escape", '"').csv(path) if schema is None else tables.read_csv(self.spark, path, schema)

    def begin(self, period: str) -> Draft:
        return Draft(self, period, uuid.uuid4().hex)


class Draft:
    """The tables of one run until it commits; nobody reads them before."""

    def __init__(self, store: Store, period: str, run: str):
        self.store, self.period, self.run, self.written = store, period, run, {}

    def write(self, table: DataFrame, name: str) -> None:
        if name in self.written:
            raise ValueError(f"{name} is already written in this run")
        path = f"{self.store.root}/runs/{self.run}/{name}"
        sink: Callable[[DataFrame, str], None] = tables.write_csv if self.store.fmt == "csv" else tables.write_parquet
        sink(table, path)
        self.written[name] = path

    def read(self, name: str) -> DataFrame:
        """A table of this run, before it commits."""
        if self.store.fmt == "csv":
            return self.store.spark.read.option("header", True).option("escape", '"').csv(self.written[name])
        return self.store.spark.read.parquet(self.written[name])

    def commit(self) -> None:
        """Publish all written tables: a single file, and so a single rename, adds them to the manifest."""
        spark, store = self.store.spark, self.store
        last = max((r.seq for r in store.entries()), default=0)
        rows = [(last + 1, self.run, self.period, name, path) for name, path in sorted(self.written.items())]
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{store.root}/manifest")
