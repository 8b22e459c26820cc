"""Key/value parameter tables.

A run is configured from a small two-column table (key, value), typically
read over JDBC by the caller (``spark.read.format("jdbc")...load()``).  All
requested keys are fetched with ONE job instead of one ``first()`` per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MissingParameterError(KeyError):
    pass


class AmbiguousParameterError(ValueError):
    pass


def load_params(
    params: DataFrame,
    keys: Sequence[str],
    key_col: str,
    value_col: str,
) -> dict[str, str]:
    """Collect the requested parameters into a dict with a single action.

    Only the requested keys leave the executors (the filter is pushed down to
    the source), aggregated to one row per key, so the driver receives at most
    ``len(keys)`` rows.  A missing key raises, as a missing parameter must stop
    the load; so does a key with different values.
    """
    frame = params.select(F.col(key_col).alias("k"), F.col(value_col).cast("string").alias("v"))
    frame = frame.filter(F.col("k").isin(list(keys)))
    one = frame.groupBy("k").agg(F.min("v").alias("v"), F.max("v").alias("other"), F.count("v").alias("n"), F.count(F.lit(1)).alias("rows"))
    found: dict[str, str] = {}
    for row in one.collect():
        if row["v"] != row["other"] or row["n"] not in (0, row["rows"]):
            raise AmbiguousParameterError(f"parameter {row['k']!r} has several values")
        found[row["k"]] = row["v"]
    missing = [k for k in keys if k not in found]
    if missing:
        raise MissingParameterError(f"parameters not found: {missing}")
    return found
