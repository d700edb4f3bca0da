"""One published state of tables that belong together.

A run writes each table into a folder of its own and publishes all of them last, by one small file: the next
version of the list that tells which run holds which season of which table. Readers resolve the newest version
once, so they see tables of one state whatever is being written, and a run that breaks off has changed nothing:
done again, it starts from the same state. Folders of such runs, and those that no version in use names, can be removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reddwatch.sources import tables

# A row for each season of a table, and one without a season for its schema (and its run, if it has no seasons).
ROW = "name string, run string, season int, schema string"


def _versions(spark: SparkSession, root: str) -> DataFrame | None:
    folder = f"{root}/state"
    if not tables.exists(spark, folder):
        return None
    return spark.read.schema(f"{ROW}, version long").parquet(folder)


def _folder(root: str, name: str, run: str) -> str:
    return f"{root}/{name}/run={run}"


@dataclass(frozen=True)
class State:
    """One version of the list."""

    spark: SparkSession
    root: str
    rows: list[T.Row]

    @classmethod
    def newest(cls, spark: SparkSession, root: str) -> State:
        """The newest version; without any tables if there is none.

        The list has a row for each table and season, which are calendar years.
        """
        versions = _versions(spark, root)
        if versions is None:
            return cls(spark, root, [])
        last = versions.agg(F.max("version")).scalar()
        return cls(spark, root, versions.filter(F.col("version") == last).collect())

    def has(self, name: str) -> bool:
        return any(r.name == name for r in self.rows)

    def table(self, name: str) -> DataFrame:
        """A table as of this state; its season filters prune folders."""
        mine = [r for r in self.rows if r.name == name]
        if not mine:
            raise ValueError(f"no table {name} is published under {self.root}")
        head = next(r for r in mine if r.season is None)
        schema = T.StructType.fromJson(json.loads(head.schema))

        def part(run: str) -> DataFrame:
            return self.spark.read.schema(schema).parquet(_folder(self.root, name, run)).select(*schema.fieldNames())

        if head.run is not None:
            return part(head.run)
        runs: dict[str, list[int]] = {}
        for r in mine:
            if r.season is not None:
                runs.setdefault(r.run, []).append(r.season)
        parts = [tables.in_seasons(part(run), seasons) for run, seasons in sorted(runs.items())]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the newest state. For several of one state, resolve `State.newest` once."""
    return State.newest(spark, root).table(name)


class Run:
    """Tables computed anew for some seasons, or for all of them if none are named, and published together."""

    def __init__(self, spark: SparkSession, root: str, seasons: Iterable[int] | None = None):
        self.spark, self.root = spark, root
        self.seasons = None if seasons is None else set(seasons)
        self.run = uuid.uuid4().hex
        self.before = State.newest(spark, root)
        self.saved: dict[str, list[tuple]] = {}

    def save(self, name: str, table: DataFrame, cluster: Sequence[str] = ()) -> DataFrame:
        """Write the run's seasons of a table and read them back; `cluster` as in `tables.clustered`."""
        folder = _folder(self.root, name, self.run)
        written = tables.write_seasons(table, folder, whole=True, cluster=cluster)
        self.saved[name] = [(name, None, None, table.schema.json()), *((name, self.run, s, None) for s in sorted(written))]
        return self._written(table, folder)

    def save_whole(self, name: str, table: DataFrame, cluster: Sequence[str] = ()) -> DataFrame:
        """Write a table that has no seasons and read it back."""
        folder = _folder(self.root, name, self.run)
        tables.save_table(table, folder, cluster)
        self.saved[name] = [(name, self.run, None, table.schema.json())]
        return self._written(table, folder)

    def keep(self, name: str, table: DataFrame) -> DataFrame:
        """Write rows that the run reads several times; they are not published."""
        folder = _folder(self.root, name, self.run)
        table.write.parquet(folder)
        return self._written(table, folder)

    def _written(self, table: DataFrame, folder: str) -> DataFrame:
        return self.spark.read.schema(table.schema).parquet(folder).select(*table.columns)

    def publish(self) -> None:
        """Make what was saved the newest state. Seasons and tables that the run left alone stay as they are."""
        rows = [row for saved in self.saved.values() for row in saved]
        for r in self.before.rows:
            left_alone = self.seasons is not None and r.season is not None and r.season not in self.seasons
            if r.name not in self.saved or left_alone:
                rows.append((r.name, r.run, r.season, r.schema))
        versions = _versions(self.spark, self.root)
        last = None if versions is None else versions.agg(F.max("version")).first()[0]
        version = 0 if last is None else last + 1
        listed = self.spark.createDataFrame(rows, ROW)
        # The folder must not be there: of two writers one fails.
        listed.coalesce(1).write.parquet(f"{self.root}/state/version={version}")
