"""Inputs derived from the driver's tables (TPC-H-like parquet).

The tables have no phone/e-mail/address columns, so a customer snapshot is
derived from ``customer`` joined with ``nation`` by fixed expressions; the
same expressions appear in the DuckDB oracle text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lpad_int(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def customer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer extract with NULL keys, blanks, odd zips, odd phones and
    NULL / 'NULL' e-mails, one row per customer."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    joined = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    phone = (
        F.when(k % 23 == 0, F.lit(None))
        .when(k % 29 == 0, F.lit("NULL"))
        .when(k % 31 == 0, F.concat(F.lit("9163"), _lpad_int(k, 6)))
        .when(k % 37 == 0, F.lit("(916) abc"))
        .otherwise(
            F.concat(
                F.lit("("),
                (F.col("c_nationkey") + 100).cast("string"),
                F.lit(") "),
                _lpad_int(k % 1000, 3),
                F.lit("-"),
                _lpad_int((k * 7) % 10000, 4),
            )
        )
    )
    return joined.select(
        k.alias("c_custkey"),
        F.when(k % 97 == 96, F.lit(None)).otherwise(k.cast("int")).alias("customer_id"),
        F.when(k % 11 == 0, F.lit("  "))
        .when(k % 13 == 0, F.lit(None))
        .otherwise(F.substring("c_name", 1, 8))
        .alias("first_name"),
        F.expr("substr(c_name, 10)").alias("last_name"),
        F.concat(F.col("n_name"), F.lit(" "), (k % 100).cast("string")).alias("street"),
        F.col("n_name").alias("city"),
        F.substring("c_mktsegment", 1, 2).alias("state"),
        F.when(k % 17 == 0, F.lit(None))
        .when(k % 19 == 0, F.lit(0))
        .otherwise((k + 10000).cast("int"))
        .alias("zip_code"),
        phone.alias("phone"),
        F.when(k % 41 == 0, F.lit(None))
        .when(k % 43 == 0, F.lit("NULL"))
        .otherwise(F.concat(F.lit("c"), k.cast("string"), F.lit("@example.com")))
        .alias("email"),
    )


def customer_bronze_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily snapshots with ``año/mes/dia`` columns.

    Day 1 (2024-01-19) lacks keys divisible by 7 (they are new on day 2),
    shows an older city for keys divisible by 5 and an older phone for keys
    divisible by 6; day 2 (2024-01-20) is the snapshot as derived.
    """
    snap = customer_snapshot(spark, sf_dir)
    k = F.col("c_custkey")
    day1 = snap.filter((k % 7 != 0) | F.col("customer_id").isNull()).select(
        *[c for c in snap.columns if c not in ("city", "phone")],
        F.when(k % 5 == 0, F.concat(F.col("city"), F.lit("_OLD"))).otherwise(F.col("city")).alias("city"),
        F.when(k % 6 == 0, F.lit("(999) 000-0000")).otherwise(F.col("phone")).alias("phone"),
    )
    day2 = snap

    def stamp(df: DataFrame, day: int) -> DataFrame:
        return df.select(
            *[c for c in snap.columns],
            F.lit(2024).alias("año"),
            F.lit(1).alias("mes"),
            F.lit(day).alias("dia"),
        )

    return stamp(day1, 19).unionByName(stamp(day2, 20))
