"""Where the tables of a warehouse lie, and how they are replaced.

A store is a folder of Parquet tables, a schema of the catalog, or whatever a connector offers; the jobs
see no difference.

A table of a folder that is replaced has a folder per version, ``v-<number>``, and an empty marker
``_committed-<number>`` beside it, created last. Readers take the version of the highest marker, so a
job that dies at any point leaves the old table, and two jobs that replace a table at once cannot both
commit: the second one fails. The version before the current one is kept for readers that have begun. In the catalog the marker is the
location of the table, which is switched last. A connector commits its own writes.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from listenhouse.session import located, staging
from listenhouse.sinks.tables import FILE_FORMATS, write_table
from listenhouse.sources.tables import read_table, table_exists

_MODE = "spark.sql.sources.partitionOverwriteMode"
_VERSION, _MARKER = re.compile(r"v-(\d+)$"), re.compile(r"_committed-(\d+)$")


def _listed(spark: SparkSession, path: str):
    """The file system of a path, and the names in the folder."""
    folder, system = located(spark, path)
    return system, [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []


def _numbers(names: Sequence[str], pattern: re.Pattern) -> list[int]:
    return [int(m[1]) for m in map(pattern.match, names) if m]


def current_path(spark: SparkSession, path: str) -> str:
    """The folder of the current version; the path itself if the table has no versions."""
    committed = _numbers(_listed(spark, path)[1], _MARKER)
    return f"{path}/v-{max(committed)}" if committed else path


def replace_version(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write a new version of a Parquet table and make it the current one; rows written.

    The rows may come from the table itself.
    """
    spark = df.sparkSession
    _, names = _listed(spark, path)
    number = max([0, *_numbers(names, _VERSION), *_numbers(names, _MARKER)]) + 1
    rows = write_table(df, f"{path}/v-{number}", "errorifexists", "parquet", partition_by)
    commit_version(spark, path, number)
    return rows


def commit_version(spark: SparkSession, path: str, number: int) -> None:
    """Make a written version the current one, then delete what lies behind the one before."""
    system, names = _listed(spark, path)
    committed = _numbers(names, _MARKER)
    if max([0, *committed]) >= number or not system.createNewFile(located(spark, f"{path}/_committed-{number}")[0]):
        raise RuntimeError(f"{path}: another job has committed version {number}")
    old = {f"{kind}{n}" for n in _numbers(names, _VERSION) if n < max([0, *committed]) for kind in ("_committed-", "v-")}
    loose = {n for n in names if not n.startswith(("_", ".", "v-"))}  # of a table without versions
    for name in sorted(old | loose if committed else old):
        system.delete(located(spark, f"{path}/{name}")[0], True)


@dataclass(frozen=True)
class Store:
    """Tables under ``base``: a folder (``format="parquet"``), a schema (``format=None``), or names for a connector.

    ``missing``: a pattern of the message by which a connector says that there is no such table.
    """

    spark: SparkSession
    base: str
    format: str | None = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    missing: str = ""

    @property
    def in_files(self) -> bool:
        return self.format in FILE_FORMATS

    def name(self, table: str) -> str:
        return f"{self.base}/{table}" if self.in_files else f"{self.base}.{table}"

    def _place(self, table: str) -> str:
        return current_path(self.spark, self.name(table)) if self.in_files else self.name(table)

    def exists(self, table: str) -> bool:
        return table_exists(self.spark, self._place(table), self.format, self.missing, **self.options)

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self._place(table), self.format, **self.options)

    def append(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> int:
        return write_table(df, self._place(table), "append", self.format, partition_by, **self.options)

    def replace(self, df: DataFrame, table: str) -> int:
        """The whole table by ``df``, which may read the table. A reader sees the old or the new one."""
        if self.in_files:
            return replace_version(df, self.name(table))
        if self.format is None:
            return self._relocate(df, table)
        with staging(self.spark) as stage:
            return write_table(stage(df, table), self.name(table), "overwrite", self.format, **self.options)

    def _relocate(self, df: DataFrame, table: str) -> int:
        """A table of the catalog: written to a new folder, to which its location is switched."""
        name = self.name(table)
        place = f"{self.spark.catalog.getDatabase(self.base).locationUri}/{table}-{uuid.uuid4().hex[:12]}"
        if not self.exists(table):
            return write_table(df, name, "errorifexists", None, path=place, **self.options)
        rows = write_table(df.select(*self.read(table).columns), place, "errorifexists", "parquet")
        self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
        self.spark.catalog.refreshTable(name)
        return rows

    def replace_days(self, df: DataFrame, table: str, days: Sequence[date | None], column: str = "event_date") -> int:
        """The rows of ``days`` by those of ``df``, in a table partitioned by day. ``df`` must not read the table."""
        rows = df.hint("rebalance", column)
        if not self.exists(table):
            by = [column] if self.in_files or self.format is None else ()
            return write_table(rows, self.name(table), "append", self.format, by, **self.options)
        if self.in_files:
            return write_table(rows, self._place(table), "overwrite", self.format, [column], partitionOverwriteMode="dynamic", **self.options)
        stored = self.read(table)
        if self.format is None:
            return self._insert_days(rows.select(*stored.columns), table)
        return self.replace(stored.where(~in_days(F.col(column), days)).unionByName(df), table)


    def _insert_days(self, df: DataFrame, table: str) -> int:
        """Into a table of the catalog only the session says that other days stay."""
        mode = self.spark.conf.get(_MODE)
        self.spark.conf.set(_MODE, "dynamic")
        try:
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(self.name(table), overwrite=True)
            return seen.get["rows"]
        finally:
            self.spark.conf.set(_MODE, mode)


def in_days(day: Column, days: Sequence[date | None]) -> Column:
    """Whether a date is one of ``days``, among which null may be."""
    known = day.isin([d for d in days if d is not None])
    return F.coalesce(known, F.lit(None in days))
