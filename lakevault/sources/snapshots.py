"""Bronze snapshots: run window and choice of the newest full snapshot.

A bronze table holds one full extract of a source table per day, normally in
Hive-style partition folders (``año=2024/mes=1/dia=18``).  A load picks the
newest snapshot inside a look-back window ending at the process date.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class RunWindow:
    """Inclusive date window ``[start, end]`` of one load run."""

    start: dt.date
    end: dt.date

    def contains(self, day: dt.date) -> bool:
        return self.start <= day <= self.end


def _to_date(value: str | dt.date | dt.datetime) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(value[:10], "%Y-%m-%d").date()


def run_window(process_date: str | dt.date | dt.datetime, lookback_days: int | str) -> RunWindow:
    """``[process_date - lookback_days, process_date]``; only the dates count.

    The time of day of the bounds is irrelevant: the comparison is made on
    whole dates, so the end of the window includes all of ``process_date``.
    """
    end = _to_date(process_date)
    days = int(lookback_days)
    if days < 0:
        raise ValueError("lookback_days must be >= 0")
    return RunWindow(start=end - dt.timedelta(days=days), end=end)


def snapshot_date_from_parts(year: str = "año", month: str = "mes", day: str = "dia") -> Column:
    """Snapshot date from three integer partition columns.

    Built only from partition columns, so a filter on it is a partition
    filter (the scan lists and opens just the matching folders).  Invalid
    parts give NULL instead of failing the job under ANSI mode.
    """
    text = F.concat_ws(
        "-",
        F.col(f"`{year}`").cast("string"),
        F.col(f"`{month}`").cast("string"),
        F.col(f"`{day}`").cast("string"),
    )
    return F.try_to_date(text, "yyyy-M-d")


def with_snapshot_date(df: DataFrame, date_col: Column, name: str = "snapshot_date") -> DataFrame:
    return df.withColumn(name, date_col)


def read_snapshots(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a bronze folder with partition discovery (schema inferred)."""
    return spark.read.format(fmt).load(path)


def latest_snapshot(
    df: DataFrame,
    window: RunWindow,
    date_col: Column | None = None,
    timestamp_col: str | None = None,
) -> tuple[DataFrame, dt.date | None]:
    """Rows of the newest snapshot date inside ``window``.

    ``date_col`` derives the snapshot date (default: from ``año/mes/dia``
    partition columns).  When the date comes from a data timestamp instead,
    pass ``timestamp_col`` and the date is ``CAST(ts AS DATE)``; an extra
    half-open range on the raw timestamp is added so the parquet reader can
    skip row groups (a cast is not pushed down by itself).

    One small job finds the newest date (it reads partition values or a
    single pruned column); the returned DataFrame then filters on that date
    as a literal, so only that snapshot's files are scanned.  An empty
    window yields an empty DataFrame and ``None`` -- the load is a no-op.
    """
    if timestamp_col is not None:
        ts = F.col(timestamp_col)
        date_col = ts.cast("date")
        lo = dt.datetime.combine(window.start, dt.time())
        hi = dt.datetime.combine(window.end + dt.timedelta(days=1), dt.time())
        scoped = df.filter((ts >= F.lit(lo.isoformat(" "))) & (ts < F.lit(hi.isoformat(" "))))
    else:
        date_col = date_col if date_col is not None else snapshot_date_from_parts()
        scoped = df
    in_window = scoped.filter(date_col.between(F.lit(window.start), F.lit(window.end)))
    newest = in_window.select(F.max(date_col).alias("d")).first()["d"]
    if newest is None:
        return df.filter(F.lit(False)), None
    if timestamp_col is not None:
        ts = F.col(timestamp_col)
        lo = dt.datetime.combine(newest, dt.time())
        hi = lo + dt.timedelta(days=1)
        chosen = df.filter((ts >= F.lit(lo.isoformat(" "))) & (ts < F.lit(hi.isoformat(" "))))
    else:
        chosen = df.filter(date_col == F.lit(newest))
    return chosen, newest


# The partition folders of a snapshot and the number of digits a part may be padded to.
DATE_PARTS = (("año", 4), ("mes", 2), ("dia", 2))
SOURCE_FILE = "__source_file"
REJECT_REASON, REJECT_DATE = "reason", "snapshot_text"


def day_folders(day: dt.date, parts: tuple[tuple[str, int], ...] = DATE_PARTS) -> str:
    """Glob of a day's folders, with and without leading zeros: ``año=2024/mes={1,01}/dia=18``."""
    out = []
    for (name, digits), value in zip(parts, (day.year, day.month, day.day)):
        texts = sorted({str(value), str(value).zfill(digits)})
        out.append(f"{name}={texts[0] if len(texts) == 1 else '{' + ','.join(texts) + '}'}")
    return "/".join(out)


def newest_folder(
    spark: SparkSession, path: str, schema: T.StructType, window: RunWindow, parts: tuple[tuple[str, int], ...] = DATE_PARTS,
    fmt: str = "parquet",
) -> tuple[DataFrame, dt.date | None]:
    """Rows of the newest day inside ``window`` that has files, chosen by folder names alone.

    With a declared schema neither the choice nor the plan opens a file, and
    only the window's folders are listed, newest first: the number of
    listings is bounded by the window, not by the age of the lake.  A day's
    folder without files isn't a snapshot; a day whose files hold no rows is one.  An empty window
    yields an empty frame and ``None``.
    """
    full = schema
    for name, _ in parts:
        if name not in schema.names:
            full = T.StructType([*full.fields, T.StructField(name, T.IntegerType())])
    day = window.end
    while day >= window.start:
        try:
            frame = spark.read.format(fmt).schema(full).option("basePath", path).load(f"{path.rstrip('/')}/{day_folders(day, parts)}")
            if frame.inputFiles():
                return frame, day
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
        day -= dt.timedelta(days=1)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in full.fields]), None


def with_source_file(df: DataFrame, name: str = SOURCE_FILE) -> DataFrame:
    """Adds the file each row was read from (``df`` must scan files): the row's own record source."""
    return df.select("*", F.col("_metadata.file_path").alias(name))


def rejected_rows(df: DataFrame, year: str = "año", month: str = "mes", day: str = "dia") -> DataFrame:
    """Rows whose date parts give no date, with the parts as text and the reason.

    The other side of ``snapshot_date_from_parts``: together they are all rows.
    """
    parts = [F.col(f"`{c}`").cast("string") for c in (year, month, day)]
    text = F.concat_ws("-", *[F.coalesce(p, F.lit("")) for p in parts])
    missing = parts[0].isNull() | parts[1].isNull() | parts[2].isNull()
    number = [p.try_cast("int") for p in parts]
    reason = (
        F.when(missing, F.lit("part missing"))
        .when(number[0].isNull() | number[1].isNull() | number[2].isNull(), F.lit("part is no number"))
        .when((number[1] < 1) | (number[1] > 12), F.lit("no such month"))
        .otherwise(F.lit("no such day"))
    )
    bad = missing | snapshot_date_from_parts(year, month, day).isNull()
    return df.filter(bad).select("*", text.alias(REJECT_DATE), reason.alias(REJECT_REASON))


def store_rejects(df: DataFrame, path: str, load_ts: Column, **date_parts: str) -> int:
    """Append the rejected rows to a reject table; returns their number.

    The count comes from the write's own job.  When the parts are partition
    columns only the folders with unparsable dates are read.
    """
    from lakevault.sources.tables import write_observed

    rows = rejected_rows(df, **date_parts).withColumn("load_ts", load_ts)
    seen = write_observed(lambda x: x.write.mode("append").parquet(path), rows, n=F.count(F.lit(1)))
    return int(seen["n"])
