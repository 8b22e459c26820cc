"""The rows each load adds, kept by load, so that later layers read only what changed.

A load's new rows are written here first (``load=N`` folders, one set for each
table) and appended to their tables from here.  The load is sealed when all
appends are done.  A load that wasn't sealed is finished by the next one: rows
that the interrupted appends didn't store yet are appended, then it is sealed.
So a row is in its table exactly if its load is sealed, and no reader of the
changes misses a row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.operators.hub import insert_only_merge
from lakevault.sources.tables import TableSpec, _max_version, _missing, conform, empty_frame

LOAD_NO = "load"


@dataclass(frozen=True)
class TrackedTable:
    """A table whose loads are tracked: ``identity`` are the columns that tell its rows apart."""

    name: str
    spec: TableSpec
    identity: tuple[str, ...]
    read: Callable[[], DataFrame]
    append: Callable[[DataFrame], None]


@dataclass(frozen=True)
class ChangeLog:
    path: str
    tables: tuple[TrackedTable, ...]

    def _folder(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def _rows(self, spark: SparkSession, table: TrackedTable, load: int) -> DataFrame:
        return spark.read.schema(table.spec.schema).parquet(f"{self._folder(table.name)}/{LOAD_NO}={load}")

    def sealed(self, spark: SparkSession) -> int:
        """Number of the last sealed load, 0 before the first."""
        return _max_version(spark, self._folder("sealed"), column=LOAD_NO) or 0

    def finish(self, spark: SparkSession) -> None:
        """Complete a load that was written here but not sealed."""
        load = self.sealed(spark) + 1
        written = []
        for table in self.tables:
            try:
                written.append((table, self._rows(spark, table, load)))
            except AnalysisException as exc:
                if not _missing(exc):
                    raise
                return  # the load never had all its rows here, so nothing of it was appended
        for table, rows in written:
            table.append(insert_only_merge(rows, table.read(), table.identity))
        self._seal(spark, load)

    def load(self, spark: SparkSession, new_rows: dict[str, Callable[[], DataFrame]], run_all: Callable[[dict], dict]) -> int:
        """Write the new rows of every table, append them, seal the load; returns its number.

        ``run_all`` runs a dict of independent actions (in threads, for instance).
        """
        self.finish(spark)
        load = self.sealed(spark) + 1

        def write(table: TrackedTable) -> None:
            rows = conform(new_rows[table.name](), table.spec)
            rows.hint("rebalance").write.mode("overwrite").parquet(f"{self._folder(table.name)}/{LOAD_NO}={load}")

        run_all({t.name: (lambda t=t: write(t)) for t in self.tables})
        run_all({t.name: (lambda t=t: t.append(self._rows(spark, t, load))) for t in self.tables})
        self._seal(spark, load)
        return load

    def _seal(self, spark: SparkSession, load: int) -> None:
        spark.range(1).select(F.lit(load).alias(LOAD_NO)).coalesce(1).write.mode("append").parquet(self._folder("sealed"))

    def since(self, spark: SparkSession, name: str, after: int, upto: int) -> DataFrame:
        """Rows of one table from the sealed loads after ``after``; other loads' folders aren't opened."""
        table = next(t for t in self.tables if t.name == name)
        schema = T.StructType([*table.spec.schema.fields, T.StructField(LOAD_NO, T.IntegerType())])
        try:
            rows = spark.read.schema(schema).parquet(self._folder(name))
        except AnalysisException as exc:
            if not _missing(exc):
                raise
            return empty_frame(spark, table.spec)
        return rows.filter(F.col(LOAD_NO).between(after + 1, upto)).drop(LOAD_NO)

    def keys_since(self, spark: SparkSession, key: str, after: int, upto: int, names: Sequence[str]) -> DataFrame:
        """The change set: distinct keys with rows in any of the named tables since ``after``."""
        frames = [self.since(spark, n, after, upto).select(key) for n in names]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out.distinct()
