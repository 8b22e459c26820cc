"""Silver/gold tables: declared schemas, appends and versioned full states.

Storage is plain Parquet, so the two MERGE shapes of a Data Vault load are
re-expressed with Spark's file writers:

* insert-only MERGE (hubs, satellites) -> the loader already returns only rows
  that are not in the table, so the write is an **append**; old files are
  never rewritten;
* upsert MERGE (Type-1 dimension) -> the loader returns the **new full
  state**, written as a new ``version=N`` partition of the table folder.  The
  plan that reads version N writes version N+1, so no job overwrites a path
  it is reading, and a failed write leaves the previous version current.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.functions.columns import require_not_null

VERSION_COL = "version"
# The table property that turns rebalanced writes on ("true", the default) or off.
OPTIMIZE_WRITE = "lakevault.optimizeWrite"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: T.DataType
    nullable: bool = False
    comment: str = ""


@dataclass(frozen=True)
class TableSpec:
    """Declared table: typed columns, NOT NULL flags, comments, layout."""

    name: str
    columns: tuple[ColumnSpec, ...]
    comment: str = ""
    cluster_by: tuple[str, ...] = ()
    properties: dict[str, str] = field(default_factory=dict)
    bloom: tuple[str, ...] = ()  # key columns whose files carry a Bloom filter

    @property
    def optimized_write(self) -> bool:
        """Whether writes rebalance their output into well-sized files."""
        return self.properties.get(OPTIMIZE_WRITE, "true") == "true"

    @property
    def write_options(self) -> dict[str, str]:
        return {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.bloom}

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(c.name, c.dtype, c.nullable, {"comment": c.comment} if c.comment else {})
                for c in self.columns
            ]
        )

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]


def empty_frame(spark: SparkSession, spec: TableSpec | T.StructType | str) -> DataFrame:
    """An empty DataFrame with the given schema, built JVM-side (one empty
    partition; no Python-side rows or Python workers involved)."""
    if isinstance(spec, TableSpec):
        schema = spec.schema
    elif isinstance(spec, str):
        schema = T._parse_datatype_string(spec)
    else:
        schema = spec
    return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Select the spec's columns in order, cast to the declared types and
    enforce NOT NULL inside the same job (no separate validation pass)."""
    missing = [c for c in spec.column_names if c not in df.columns]
    if missing:
        raise ValueError(f"{spec.name}: missing columns {missing}")
    typed = df.select(*[F.col(c.name).cast(c.dtype).alias(c.name) for c in spec.columns])
    return require_not_null(typed, spec.not_null, spec.name)


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns_ddl(spec: TableSpec) -> str:
    cols = []
    for c in spec.columns:
        col = f"`{c.name}` {c.dtype.simpleString()}"
        if not c.nullable:
            col += " NOT NULL"
        if c.comment:
            col += f" COMMENT {_sql_text(c.comment)}"
        cols.append(col)
    return ", ".join(cols)


def _table_ddl_tail(spec: TableSpec) -> str:
    out = f" COMMENT {_sql_text(spec.comment)}" if spec.comment else ""
    if spec.properties:
        out += " TBLPROPERTIES (" + ", ".join(f"{_sql_text(k)} = {_sql_text(v)}" for k, v in sorted(spec.properties.items())) + ")"
    return out


def _require_location(spark: SparkSession, table: str, path: str) -> None:
    """Raise if a table of that name is stored elsewhere: it is another lake's."""
    found = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": table}).filter("col_name = 'Location'").first()
    plain = lambda x: re.sub(r"^file:/*", "/", x).rstrip("/")
    if found is not None and plain(found["data_type"]) != plain(path):
        raise ValueError(f"table {table} is stored at {found['data_type']}, not at {path}; use another table prefix")


def table_ddl(spec: TableSpec, path: str, table_name: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for ``spec``: typed columns, NOT
    NULL flags, column and table comments and the ``CLUSTER BY`` columns
    (recorded as the table's clustering columns), over an external folder."""
    ddl = f"CREATE TABLE IF NOT EXISTS {table_name or spec.name} ({_columns_ddl(spec)}) USING parquet{_table_ddl_tail(spec)}"
    if spec.cluster_by:
        ddl += " CLUSTER BY (" + ", ".join(f"`{c}`" for c in spec.cluster_by) + ")"
    return ddl + f" LOCATION {_sql_text(path)}"


def ensure_table(spark: SparkSession, spec: TableSpec, path: str, table_name: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over ``path`` with the declared schema.

    Registers an external Parquet table in the session catalog with column
    comments, NOT NULL flags (enforced by ``conform`` on write, since Parquet
    tables accept NULLs), the table comment and the clustering columns.  The
    layout itself is produced by the writers (sorted, well-sized files).
    """
    name = table_name or spec.name
    spark.sql(table_ddl(spec, path, "IDENTIFIER(:name)"), args={"name": name})
    _require_location(spark, table_name or spec.name, path)


def register_current(spark: SparkSession, spec: TableSpec, path: str, version: int, table_name: str | None = None) -> None:
    """Point the catalog name at a committed version of a versioned table.

    The table is external, so dropping the old entry removes no files.
    """
    name = table_name or spec.name
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
    ensure_table(spark, spec, _version_dir(path, version), name)


def _cluster(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rebalance, then sort each written file by the cluster columns.

    The ``rebalance`` hint is Spark's optimised write: AQE splits or merges
    the output partitions to the advisory size (64 MB by default), so a load
    writes a few well-sized files instead of one file per shuffle partition,
    and a skewed partition is split rather than written by one task.  The
    sort gives tight min/max statistics per row group for later filters.

    Deliberately no ``repartitionByRange``: its sampling job would evaluate
    the load query a second time, and for satellites the cluster column is
    the load time, which is one constant per load -- a range exchange on it
    would put every new row of the load into a single task.  Each append
    already lands in its own files, so the table stays clustered by load.
    """
    balanced = df.hint("rebalance") if spec.optimized_write else df
    return balanced.sortWithinPartitions(*spec.cluster_by) if spec.cluster_by else balanced


def _missing(exc: AnalysisException) -> bool:
    """Whether Spark reports that the path isn't there; any other error, a failed
    listing for instance, must not pass for an empty table."""
    return exc.getCondition() == "PATH_NOT_FOUND"


def read_table(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Read an append-only table, or an empty frame when it does not exist yet."""
    try:
        return spark.read.schema(spec.schema).parquet(path)
    except AnalysisException as exc:
        if _missing(exc):
            return empty_frame(spark, spec)
        raise


def append_rows(df: DataFrame, spec: TableSpec, path: str) -> None:
    """Insert-only load: append the (already anti-joined) new rows."""
    _cluster(conform(df, spec), spec).write.mode("append").options(**spec.write_options).parquet(path)


COMMITS_DIR = "_commits"  # leading underscore: invisible to partition discovery


def _max_version(spark: SparkSession, path: str, sub: str = "", column: str = VERSION_COL) -> int | None:
    target = f"{path.rstrip('/')}/{sub}" if sub else path
    try:
        frame = spark.read.parquet(target)
    except AnalysisException as exc:
        if _missing(exc):  # a missing folder means "no version yet"
            return None
        raise
    if column not in frame.columns:
        return None
    row = frame.select(F.max(column).alias("v")).first()
    return None if row is None or row["v"] is None else int(row["v"])


def current_version(spark: SparkSession, path: str) -> int | None:
    """Newest *committed* version: read from the commit log, which gets its
    row only after that version's files were written successfully.  A
    version folder left behind by a failed or interrupted write is ignored."""
    return _max_version(spark, path, COMMITS_DIR)


def _committed(spark: SparkSession, path: str, version: int) -> dict:
    rows = (
        spark.read.parquet(f"{path.rstrip('/')}/{COMMITS_DIR}")
        .filter(F.col(VERSION_COL) == F.lit(version))
        .collect()
    )
    return rows[-1].asDict() if rows else {}


def _folder_exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder exists: a file listing on the driver, no Spark job."""
    try:
        spark.read.format("binaryFile").load(folder)
        return True
    except AnalysisException as exc:
        if _missing(exc):
            return False
        raise


def _version_dir(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{VERSION_COL}={version}"


def read_state(
    spark: SparkSession, spec: TableSpec, path: str, bucketing: "Bucketing | None" = None
) -> tuple[DataFrame, int | None]:
    """Current full state of a versioned table and its version number.

    With ``bucketing``, a version that was written bucketed is read as a
    bucketed catalog table (registered on demand over its folder), so a join
    on the bucket columns reads it already partitioned.
    """
    version = current_version(spark, path)
    if version is None:
        # the first version may be left by an interrupted write; a second one was preceded by a commit
        if _folder_exists(spark, _version_dir(path, 1)) and _folder_exists(spark, _version_dir(path, 2)):
            raise RuntimeError(f"{path} holds versions but no commit log")
        return empty_frame(spark, spec), None
    if bucketing is not None:
        info = _committed(spark, path, version)
        if info.get("buckets") == bucketing.num_buckets and info.get("bucket_cols") == ",".join(bucketing.columns):
            versioned = Bucketing(f"{bucketing.table}_v{version}", bucketing.columns, bucketing.num_buckets)
            ensure_bucketed_table(spark, spec, _version_dir(path, version), versioned)
            return spark.table(versioned.table), version
    frame = spark.read.schema(spec.schema.add(VERSION_COL, T.IntegerType())).parquet(path)
    return frame.filter(F.col(VERSION_COL) == F.lit(version)).drop(VERSION_COL), version


def write_state(
    df: DataFrame,
    spec: TableSpec,
    path: str,
    previous_version: int | None,
    bucketing: "Bucketing | None" = None,
) -> int:
    """Write the new full state as the next version, then commit it.

    The number is past every existing version folder, so the files of an
    interrupted earlier attempt are never mixed into the new version.  With
    ``bucketing`` the version is written as a bucketed table (one file per
    bucket) in its own ``version=N`` folder; the commit row records it.
    A version isn't committed if another run committed one meanwhile.
    """
    spark = df.sparkSession
    version = (previous_version or 0) + 1
    while _folder_exists(spark, _version_dir(path, version)):  # left by an interrupted write
        version += 1
    if bucketing is None:
        out = _cluster(conform(df, spec), spec).withColumn(VERSION_COL, F.lit(version))
        out.write.mode("append").partitionBy(VERSION_COL).parquet(path)
    else:
        cols = list(bucketing.columns)
        out = conform(df, spec).repartition(bucketing.num_buckets, *cols)
        (
            out.write.bucketBy(bucketing.num_buckets, *cols)
            .sortBy(*cols)
            .option("path", _version_dir(path, version))
            .saveAsTable(f"{bucketing.table}_v{version}")
        )
    if current_version(spark, path) != previous_version:
        raise ConcurrentWriteError(f"{path}: version {previous_version} isn't the current one any more; run the load again")
    commit = spark.range(1).select(
        F.lit(version).cast("int").alias(VERSION_COL),
        F.lit(bucketing.num_buckets if bucketing else None).cast("int").alias("buckets"),
        F.lit(",".join(bucketing.columns) if bucketing else None).cast("string").alias("bucket_cols"),
    )
    commit.write.mode("append").parquet(f"{path.rstrip('/')}/{COMMITS_DIR}")
    return version


_SCOPE: ContextVar[str] = ContextVar("scratch_scope", default="")


def scratch_table(spark: SparkSession, label: str) -> str:
    """A new folder for an intermediate table, under the session's shared checkpoint folder."""
    from lakevault.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/materialized/{_SCOPE.get()}{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end.

    For actions only: no frame that reads such a table may be used afterwards.
    """
    from lakevault.session import ensure_checkpoint_dir

    name = f"run-{uuid.uuid4().hex}/"
    token = _SCOPE.set(name)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/materialized/{name}")
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


class ConcurrentWriteError(RuntimeError):
    """Another run changed the table since this one read it."""


def write_observed(write: Callable[[DataFrame], None], df: DataFrame, **metrics: Column) -> dict:
    """Run a write and return aggregates of the rows it wrote, from the same job.

    A map task that is run again after an executor loss can count its rows
    twice: use counts only for "any?" and for sizes, never as exact totals;
    minimum and maximum aren't affected.
    """
    seen = Observation(f"write-{uuid.uuid4().hex}")
    write(df.observe(seen, *[c.alias(name) for name, c in metrics.items()]))
    return seen.get


def materialize(df: DataFrame, label: str = "state", rebalance: bool = True) -> DataFrame:
    """Write ``df`` once as Parquet under the session's reliable checkpoint
    folder and return a DataFrame reading it back.

    Cuts the lineage like ``checkpoint()`` but with a single job (an RDD
    checkpoint of an un-persisted plan computes it twice), and the stored
    copy lives on the shared file system named by ``spark.checkpoint.dir``,
    never on an executor's local disk.
    """
    spark = df.sparkSession
    path = scratch_table(spark, label)
    (df.hint("rebalance") if rebalance else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Bucketing:
    """Catalog table bucketed (and sorted) by the columns a load joins on.

    With the satellite history stored bucketed by ``(hk, hd)`` the daily
    anti join reads it already hash-partitioned: only the day's candidates
    are shuffled, never the whole history.  Each append is repartitioned by
    the same hash into ``num_buckets`` tasks, so a load adds at most one file
    per bucket.  Choose ``num_buckets`` >= ``spark.sql.shuffle.partitions``:
    with fewer buckets Spark prefers to re-shuffle both join sides for
    parallelism and the bucketed layout goes unused.
    """

    table: str
    columns: tuple[str, ...]
    num_buckets: int


def ensure_bucketed_table(spark: SparkSession, spec: TableSpec, path: str, bucketing: Bucketing) -> None:
    """``CREATE TABLE IF NOT EXISTS .. CLUSTERED BY .. INTO n BUCKETS`` over
    ``path`` (re-registering an existing folder is safe)."""
    keys = ", ".join(f"`{c}`" for c in bucketing.columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {bucketing.table} ({_columns_ddl(spec)}) USING parquet{_table_ddl_tail(spec)} "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {bucketing.num_buckets} BUCKETS "
        f"LOCATION {_sql_text(path)}"
    )
    _require_location(spark, bucketing.table, path)


def read_bucketed(spark: SparkSession, bucketing: Bucketing) -> DataFrame:
    return spark.table(bucketing.table)


def append_bucketed(df: DataFrame, spec: TableSpec, bucketing: Bucketing) -> None:
    """Insert-only load into a bucketed table: one file per bucket per load."""
    out = conform(df, spec).repartition(bucketing.num_buckets, *bucketing.columns)
    out.write.insertInto(bucketing.table)


def _merge_condition(keys: Sequence[str], target: str = "t", source: str = "s") -> Column:
    cond = None
    for k in keys:
        part = F.col(f"{target}.{k}") == F.col(f"{source}.{k}")
        cond = part if cond is None else cond & part
    return cond


def merge_insert_only(rows: DataFrame, table: str, keys: Sequence[str]) -> None:
    """``MERGE .. WHEN NOT MATCHED THEN INSERT *`` into a catalog table that
    supports row-level operations (e.g. Delta or Iceberg tables).

    Only for such catalogs; plain Parquet tables use ``append_rows`` with the
    anti-joined rows, which has the same result.
    """
    _require_row_level(rows.sparkSession, table)
    rows.alias("s").mergeInto(table, _merge_condition(keys)).whenNotMatched().insertAll().merge()


def merge_upsert(rows: DataFrame, table: str, keys: Sequence[str]) -> None:
    """``MERGE .. WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *`` (the Type-1
    apply of changed + new rows, e.g. ``scd1_delta``) into a row-level table."""
    _require_row_level(rows.sparkSession, table)
    (
        rows.alias("s")
        .mergeInto(table, _merge_condition(keys))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def _require_row_level(spark: SparkSession, table: str) -> None:
    provider = None
    try:
        for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
            if row[0] == "Provider":
                provider = (row[1] or "").lower()
    except Exception as exc:  # noqa: BLE001
        raise ValueError(f"table {table!r} not found in the catalog") from exc
    if provider in ("parquet", "orc", "csv", "json", "text", "avro", "hive"):
        raise ValueError(
            f"table {table!r} ({provider}) has no row-level MERGE; use append_rows / write_state instead"
        )
