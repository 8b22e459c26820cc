"""Run context shared by the loaders."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LoadContext:
    """One pinned load time and one record source per run.

    The load time is a text ``yyyy-MM-dd HH:mm:ss`` parsed in the session time
    zone, so every job of the run (and every retry of a task) stamps the same
    value -- unlike ``current_timestamp()``, which is re-evaluated per action.
    """

    load_ts: str
    record_source: str

    def __post_init__(self) -> None:
        dt.datetime.strptime(self.load_ts, "%Y-%m-%d %H:%M:%S")

    def load_ts_col(self, granularity: str = "second") -> Column:
        """Load time as a TIMESTAMP column; ``granularity="day"`` truncates to
        midnight (a load *date* stored in a TIMESTAMP column)."""
        ts = F.to_timestamp(F.lit(self.load_ts))
        if granularity == "second":
            return ts
        if granularity == "day":
            return F.date_trunc("DAY", ts)
        raise ValueError(f"unknown granularity {granularity!r}")

    def source_col(self) -> Column:
        return F.lit(self.record_source)
