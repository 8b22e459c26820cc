"""Shared helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words (space and the ASCII controls 9 to 13).
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables (``spark.checkpoint.dir``).

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster run needs a shared folder")
    root = tempfile.mkdtemp(prefix="lakevault-llm-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the plan is cut,
    and a lost executor costs only the tasks that read the files again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words of a text as an array (NULL text: no words)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


@contextmanager
def session_conf(spark: SparkSession, **settings: str):
    """Session settings for the actions inside; dots are written as double underscores."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged_matches(big: DataFrame, ids: DataFrame, on: str | list[str], name: str) -> DataFrame:
    """The rows of ``big`` whose ``on`` is in ``ids`` (a staged table, distinct), joined
    with it and staged.  Spark sends a Bloom filter of each key, at most 8 MB,
    to the scan, so only matching rows (and false positives) are shuffled.
    """
    spark = big.sparkSession
    on = [on] if isinstance(on, str) else on
    ids = ids.filter(F.col(on[0]) >= F.lit(-(1 << 63)))  # Spark builds a filter only over a filtered scan
    with session_conf(
        spark,
        spark__sql__optimizer__runtime__bloomFilter__enabled="true",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0",
        spark__sql__optimizer__runtime__bloomFilter__creationSideThreshold="1g",
    ):
        return staged(big.join(ids, on), name)
