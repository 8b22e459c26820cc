"""Tables stored by the hash of their key: an upsert writes only the partitions it touches.

Rows lie in ``part=N`` folders, N being a hash of the key.  An upsert reads the
partitions its keys fall into, puts the new rows over the old ones, and writes
just these partitions with dynamic partition overwrite; files of the others
aren't read, written or renamed.

Replacing several folders isn't atomic, so the new content is first written
next to the table and announced in a small log.  A run that finds an announced
but unfinished upsert repeats its last step, which gives the same files'
content; the table is never left with rows missing.  The log also carries the
facts an incremental load needs: how far it has read and the greatest id.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.sources.tables import ConcurrentWriteError, TableSpec, _missing, conform, empty_frame, scratch_table, write_observed

PART = "part"
ANNOUNCED, DONE = "announced", "done"


@dataclass(frozen=True)
class KeyedTable:
    """``parts`` is fixed when the table is created: about the table's size over the size of a file."""

    spec: TableSpec
    path: str
    key: tuple[str, ...]
    parts: int = 64

    def _folder(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def part_of(self) -> Column:
        """The partition of a row whose key columns have the declared types."""
        return F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int")

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        return rows.hint("rebalance", PART).sortWithinPartitions(PART, *self.key)

    def typed(self, rows: DataFrame) -> DataFrame:
        return conform(rows, self.spec).withColumn(PART, self.part_of())

    def typed_keys(self, rows: DataFrame) -> DataFrame:
        types = {c.name: c.dtype for c in self.spec.columns}
        return rows.select(*[F.col(k).cast(types[k]).alias(k) for k in self.key]).distinct().withColumn(PART, self.part_of())

    def read(self, spark: SparkSession, parts: Sequence[int] | None = None) -> DataFrame:
        """The table's columns; only the named partitions' folders if ``parts`` is given."""
        schema = T.StructType([*self.spec.schema.fields, T.StructField(PART, T.IntegerType())])
        try:
            frame = spark.read.schema(schema).parquet(self._folder("data"))
        except AnalysisException as exc:
            if not _missing(exc):
                raise
            return empty_frame(spark, self.spec)
        if parts is not None:
            frame = frame.filter(F.col(PART).isin(*parts) if parts else F.lit(False))
        return frame.drop(PART)

    def rows_of(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        """The stored rows of ``keys`` (a stored, distinct frame); other partitions aren't opened."""
        typed = self.typed_keys(keys)
        touched = sorted(r[PART] for r in typed.select(PART).distinct().collect())  # ``parts`` numbers at most
        return self.read(spark, touched).join(typed.drop(PART), list(self.key), "left_semi")

    def state(self, spark: SparkSession) -> dict:
        """Facts stored with the last finished upsert; an unfinished one is finished first."""
        log = self._log(spark)
        if log.get(ANNOUNCED, (0, None))[0] > log.get(DONE, (0, None))[0]:
            run, facts = log[ANNOUNCED]
            self._publish(spark, run, facts)
            return json.loads(facts)
        return json.loads(log[DONE][1]) if DONE in log else {}

    def upsert(self, rows: DataFrame, facts: dict | None = None, greatest: str | None = None) -> list[int]:
        """Put ``rows`` (unique keys) over the stored ones; returns the partitions written.

        ``facts`` are merged into the state.  ``greatest`` names a column
        whose greatest value is kept in the state under the same name.
        """
        spark = rows.sparkSession
        state = self.state(spark)
        run = self._log(spark).get(DONE, (0, None))[0] + 1
        path = scratch_table(spark, self.spec.name)
        seen = write_observed(
            lambda df: df.write.parquet(path), self.typed(rows),
            touched=F.collect_set(PART), **({"top": F.max(greatest)} if greatest else {}),
        )
        touched = sorted(seen["touched"] or [])
        state.update(facts or {})
        if greatest and seen["top"] is not None:
            state[greatest] = max(int(seen["top"]), state.get(greatest, int(seen["top"])))
        if not touched:
            self._note(spark, run, DONE, json.dumps(state))
            return []
        schema = T.StructType([*self.spec.schema.fields, T.StructField(PART, T.IntegerType())])
        new = spark.read.schema(schema).parquet(path)
        kept = self.read(spark, touched).join(new.select(*self.key), list(self.key), "left_anti").withColumn(PART, self.part_of())
        self._laid_out(kept.unionByName(new)).write.mode("overwrite").parquet(self._folder("_next"))
        if self._log(spark).get(DONE, (0, None))[0] + 1 != run:
            raise ConcurrentWriteError(f"{self.path}: another upsert was faster; run the load again")
        self._note(spark, run, ANNOUNCED, json.dumps(state))
        self._publish(spark, run, json.dumps(state))
        return touched

    def register_view(self, spark: SparkSession, name: str) -> None:
        """A catalog view by that name; it lists the folders when it is read, so it stays current."""
        cols = ", ".join(f"CAST(`{c.name}` AS {c.dtype.simpleString()}) AS `{c.name}`" for c in self.spec.columns)
        folder = self._folder("data").replace("`", "``")
        spark.sql(f"CREATE OR REPLACE VIEW IDENTIFIER(:name) AS SELECT {cols} FROM parquet.`{folder}`", args={"name": name})

    def _publish(self, spark: SparkSession, run: int, facts: str) -> None:
        schema = T.StructType([*self.spec.schema.fields, T.StructField(PART, T.IntegerType())])
        rows = spark.read.schema(schema).parquet(self._folder("_next"))
        writer = self._laid_out(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PART).parquet(self._folder("data"))
        self._note(spark, run, DONE, facts)

    def _note(self, spark: SparkSession, run: int, step: str, facts: str) -> None:
        row = spark.range(1).select(F.lit(run).cast("long").alias("run"), F.lit(step).alias("step"), F.lit(facts).alias("facts"))
        row.coalesce(1).write.mode("append").parquet(self._folder("_log"))

    def _log(self, spark: SparkSession) -> dict[str, tuple[int, str]]:
        """The last run announced and the last one done."""
        try:
            log = spark.read.schema("run long, step string, facts string").parquet(self._folder("_log"))
        except AnalysisException as exc:
            if not _missing(exc):
                raise
            return {}
        last = log.groupBy("step").agg(F.max(F.struct("run", "facts")).alias("last")).collect()
        return {r["step"]: (r["last"]["run"], r["last"]["facts"]) for r in last}


@dataclass(frozen=True)
class RangeTable(KeyedTable):
    """A keyed table whose partitions are ranges of its one key: files with disjoint key ranges.

    Partition i holds keys up to ``bounds[i]``, the last one all greater keys;
    each is one sorted file, so a probe for some keys opens only the files of
    their ranges.  The bounds come from stored rows (``key_bounds``), as many as give files of a good size,
    and stay with the table.
    """

    bounds: tuple = ()

    @classmethod
    def open(cls, spark: SparkSession, spec: TableSpec, path: str, key: str, first_rows: DataFrame | None = None,
             ranges: int = 64) -> RangeTable:
        """The stored table, or a new one with bounds from ``first_rows``."""
        found = KeyedTable(spec, path, (key,)).state(spark).get("bounds")
        if found is None:
            if first_rows is None:
                raise ValueError(f"{spec.name}: a new table takes its bounds from its first rows")
            found = key_bounds(first_rows, key, ranges)
        return cls(spec, path, (key,), len(found) + 1, tuple(found))

    def part_of(self) -> Column:
        key = F.col(self.key[0])
        below = F.filter(F.array(*[F.lit(b) for b in self.bounds]), lambda b: b < key) if self.bounds else F.array()
        return F.size(below).cast("int")

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(PART).sortWithinPartitions(PART, *self.key)

    def upsert(self, rows: DataFrame, facts: dict | None = None, greatest: str | None = None) -> list[int]:
        return super().upsert(rows, {**(facts or {}), "bounds": list(self.bounds)}, greatest)

    def read_between(self, spark: SparkSession, low, high) -> DataFrame:
        """Rows with keys from ``low`` to ``high``; only their ranges' files are opened."""
        parts = list(range(bisect_left(self.bounds, low), bisect_left(self.bounds, high) + 1))
        return self.read(spark, parts).filter(F.col(self.key[0]).between(low, high))


def key_bounds(rows: DataFrame, key: str, ranges: int) -> list:
    """At most ``ranges - 1`` increasing bounds that split a numeric key evenly (one aggregate, no shuffle of rows)."""
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx(key, shares, 10_000).alias("b")).first()["b"]
    return sorted(set(found or []))
