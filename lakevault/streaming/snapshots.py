"""Run the batch loads as bronze snapshots land, with Structured Streaming.

The loads themselves are batch operations over whole tables (anti joins
against the stored hub/satellites, a full-outer upsert of the dimension);
streaming only decides *when* they run.  A file source over the bronze
folder yields the rows of newly arrived snapshot files per micro-batch, and
``foreachBatch`` hands every snapshot date of the batch, oldest first, to
the same idempotent load used by the scheduled run.  Progress is tracked in
the stream's checkpoint, so each snapshot file is loaded once; a retried
micro-batch is harmless because the loads are idempotent.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakevault.operators.context import LoadContext
from lakevault.sources.snapshots import snapshot_date_from_parts, store_rejects

_DATE = "__snapshot_date"


def snapshot_stream(
    spark: SparkSession,
    bronze_path: str,
    schema: T.StructType,
    checkpoint_location: str,
    on_snapshot: Callable[[DataFrame, dt.date], None],
    date_col=None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    trigger_interval: str = "1 minute",
    on_rejects: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Start a stream calling ``on_snapshot(rows, date)`` per arrived snapshot.

    ``schema`` must include the partition columns (file streams do not infer
    schemas).  ``available_now`` processes what has landed and stops (for a
    scheduled job); otherwise the stream polls every ``trigger_interval``.  Only the distinct snapshot dates of a micro-batch reach the
    driver (a handful of values); the rows stay distributed.  A micro-batch is
    read once, however many dates it holds.  Rows without a valid date go to
    ``on_rejects``; without one they stop the stream, so that none is lost unseen.
    """
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(bronze_path)
    date_expr = date_col if date_col is not None else snapshot_date_from_parts()

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn(_DATE, date_expr).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = {r[_DATE] for r in dated.select(_DATE).distinct().collect()}
            if None in found:
                if on_rejects is None:
                    raise ValueError(f"micro-batch {batch_id} holds rows without a valid snapshot date")
                on_rejects(dated.filter(F.col(_DATE).isNull()).drop(_DATE))
            for day in sorted(found - {None}):
                on_snapshot(dated.filter(F.col(_DATE) == F.lit(day)).drop(_DATE), day)
        finally:
            dated.unpersist()

    writer = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger_interval)
    return writer.start()


def customer_snapshot_stream(
    spark: SparkSession,
    paths,
    schema: T.StructType,
    checkpoint_location: str,
    record_source: str,
    load_ts_of: Callable[[dt.date], str] | None = None,
    available_now: bool = True,
    rejects: str | None = None,
    **load_options,
) -> StreamingQuery:
    """Customer hub/satellites/dimension loaded per arriving snapshot.

    ``load_ts_of`` pins the load time of each snapshot (default: the snapshot
    date at midnight, so replays stamp the same values).  ``rejects`` is a
    folder for rows without a valid date; without it they stop the stream.
    ``load_options`` are those of ``load_snapshot``: ``sep``, ``mode``,
    ``phone_how``, ``gold``, ``buckets``, ``table_prefix``, ``register_tables``.
    """
    from lakevault.plans.customer import load_snapshot

    stamp = load_ts_of or (lambda day: f"{day.isoformat()} 00:00:00")

    def on_snapshot(rows: DataFrame, day: dt.date) -> None:
        load_snapshot(spark, rows, paths, LoadContext(stamp(day), record_source), **load_options)

    def on_rejects(rows: DataFrame) -> None:
        store_rejects(rows, rejects, F.current_timestamp())

    return snapshot_stream(
        spark, paths.bronze, schema, checkpoint_location, on_snapshot, available_now=available_now,
        on_rejects=on_rejects if rejects else None,
    )
