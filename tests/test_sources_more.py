"""Range layout, Bloom probes, choice by folder names, rejects, lineage, names from parameters."""

import datetime as dt
import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.operators.hub import selective_probe
from lakevault.plans import customer as cust
from lakevault.plans.queries import PIPELINE_LOOKBACK, PIPELINE_RUNS, hub_in_ranges, pipeline_dimension_frame
from lakevault.plans.testdata import customer_bronze_two_days
from lakevault.sources.keyed import RangeTable, key_bounds
from lakevault.sources.snapshots import (
    day_folders,
    newest_folder,
    rejected_rows,
    run_window,
    snapshot_date_from_parts,
    store_rejects,
)
from lakevault.sources.tables import ColumnSpec, TableSpec, append_rows, read_table

from conftest import SF_SMALL

SPEC = TableSpec("keys", (ColumnSpec("k", T.LongType()),), cluster_by=("k",), bloom=("k",))


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def local(path):
    return re.sub(r"^file:/*", "/", path)


def lake(scratch, name="lake"):
    return cust.LakePaths(f"{scratch}/bronze", *[f"{scratch}/{name}_{n}" for n in ("hub", "general", "phone", "email", "dim")])


def two_days(spark, scratch):
    customer_bronze_two_days(spark, SF_SMALL).write.partitionBy("año", "mes", "dia").parquet(f"{scratch}/bronze")


def rows_scanned(df):
    """Rows that left the scan when ``df`` ran: what row-group and page statistics didn't skip."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    plan = leaves.apply(0)
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan().collectLeaves().apply(0)
    return plan.metrics().apply("numOutputRows").value()


def test_files_of_a_range_table_have_disjoint_key_ranges(spark, scratch):
    hub = hub_in_ranges(spark, SF_SMALL, f"{scratch}/hub", 5)
    stored = hub.read(spark)
    ranges = []
    for f in stored.inputFiles():
        keys = pq.read_table(local(f), columns=["customer_key"]).column(0).to_pylist()
        ranges.append((min(keys), max(keys)))
    ranges.sort()
    assert len(ranges) >= 4  # one file a range, after two loads
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    low, high = ranges[1]
    probe = hub.read_between(spark, low, high)
    assert rows(probe) == rows(stored.filter(F.col("customer_key").between(low, high)))
    assert rows_scanned(hub.read_between(spark, low, high)) < stored.count() / 2
    again = RangeTable.open(spark, hub.spec, hub.path, "customer_key")
    assert again.bounds == hub.bounds and again.parts == hub.parts


def test_bounds_of_few_and_equal_keys(spark, scratch):
    few = spark.createDataFrame([(5,), (5,), (5,)], "k long")
    assert key_bounds(few, "k", 8) == [5] and key_bounds(few, "k", 1) == [] and key_bounds(few.limit(0), "k", 8) == []
    t = RangeTable.open(spark, SPEC, f"{scratch}/t", "k", few.limit(0), 8)
    t.upsert(spark.createDataFrame([(-3,), (9,)], "k long"))
    assert rows(t.read(spark)) == [("-3",), ("9",)]
    with pytest.raises(ValueError):
        RangeTable.open(spark, SPEC, f"{scratch}/none", "k")


def test_a_selective_probe_reads_few_rows(spark, scratch):
    """Keys dealt at random over 20 files: only Bloom filters can tell which hold a key."""
    path = f"{scratch}/hub"
    spark.range(0, 40_000, 2).selectExpr("id * 7919 % 40009 * 2 AS k").repartition(20).write.options(**SPEC.write_options).parquet(path)
    state = read_table(spark, SPEC, path)
    present = [r.k for r in state.limit(3).collect()]
    keys = spark.createDataFrame([(k,) for k in present] + [(1,), (10**9 + 1,)], "k long")
    near = selective_probe(state, keys, "k")
    assert sorted(r.k for r in near.collect()) == sorted(present)
    assert rows_scanned(selective_probe(state, keys, "k")) <= 20_000 * 5 / 20  # a file for each key found, and false hits
    # sorted files: the range alone skips, also for more keys than are listed
    append_rows(state, SPEC, f"{scratch}/sorted")
    ordered = spark.read.schema(SPEC.schema).parquet(path).repartitionByRange(20, "k").sortWithinPartitions("k")
    ordered.write.parquet(f"{scratch}/ranged")
    ranged = read_table(spark, SPEC, f"{scratch}/ranged")
    some = spark.range(1000, 1400).selectExpr("id AS k")
    assert rows_scanned(selective_probe(ranged, some, "k", most_values=10)) <= 20_000 / 10
    assert rows(keys.join(near, "k", "left_anti")) == rows(keys.join(state, "k", "left_anti"))
    assert selective_probe(state, keys.limit(0), "k").count() == 0


def test_the_snapshot_is_chosen_without_opening_other_days(spark, scratch):
    two_days(spark, scratch)
    for day in (19, 21):  # not Parquet: opening them would fail
        folder = f"{scratch}/bronze/año=2024/mes=1/dia={day}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/part-broken.parquet", "wb") as f:
            f.write(b"broken")
    os.makedirs(f"{scratch}/bronze/año=2024/mes=1/dia=20/empty", exist_ok=True)
    out = cust.run_customer_load(
        spark, lake(scratch), "2024-01-20 06:00:00", "s", "2024-01-20", 3, bronze_schema=cust.BRONZE_SCHEMA)
    assert out["snapshot_date"] == dt.date(2024, 1, 20) and out["dim_version"] == 1
    with pytest.raises(Exception):
        cust.run_customer_load(spark, lake(scratch, "other"), "2024-01-20 06:00:00", "s", "2024-01-20", 3)


def test_folder_names_with_and_without_zeros(spark, scratch):
    schema = T.StructType([T.StructField("x", T.LongType())])
    spark.range(3).selectExpr("id AS x").write.parquet(f"{scratch}/b/año=2024/mes=01/dia=05")
    spark.range(2).selectExpr("id AS x").write.parquet(f"{scratch}/b/año=2023/mes=12/dia=31")
    os.makedirs(f"{scratch}/b/año=2024/mes=1/dia=6")  # no files: no snapshot
    assert day_folders(dt.date(2024, 1, 5)) == "año=2024/mes={01,1}/dia={05,5}"
    df, day = newest_folder(spark, f"{scratch}/b", schema, run_window("2024-01-07", 5))
    assert day == dt.date(2024, 1, 5) and rows(df) == [(str(i), "2024", "1", "5") for i in range(3)]
    df, day = newest_folder(spark, f"{scratch}/b", schema, run_window("2024-01-03", 5))
    assert day == dt.date(2023, 12, 31) and df.count() == 2
    df, day = newest_folder(spark, f"{scratch}/b", schema, run_window("2020-01-03", 5))
    assert day is None and df.count() == 0 and df.columns == ["x", "año", "mes", "dia"]


def test_rejects_are_the_rows_without_a_date(spark, scratch):
    parts = [("2024", "1", "5"), ("2024", "13", "1"), ("2024", "2", "30"), ("2024", None, "1"), ("x", "1", "1"), (None, None, None)]
    df = spark.createDataFrame(parts, "`año` string, mes string, dia string")
    bad = rejected_rows(df)
    assert sorted((r.snapshot_text, r.reason) for r in bad.collect()) == [
        ("--", "part missing"), ("2024--1", "part missing"), ("2024-13-1", "no such month"), ("2024-2-30", "no such day"),
        ("x-1-1", "part is no number")]
    assert bad.count() + df.filter(snapshot_date_from_parts().isNotNull()).count() == df.count()
    ts = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    assert store_rejects(df, f"{scratch}/r", ts) == 5 and store_rejects(df.limit(0), f"{scratch}/r", ts) == 0
    assert spark.read.parquet(f"{scratch}/r").count() == 5


def test_a_load_stores_rejects_and_files(spark, scratch):
    two_days(spark, scratch)
    bad = customer_bronze_two_days(spark, SF_SMALL).filter("dia = 20").withColumn("dia", F.lit(31)).withColumn("mes", F.lit(2))
    bad.write.mode("append").partitionBy("año", "mes", "dia").parquet(f"{scratch}/bronze")
    paths = lake(scratch)
    out = cust.run_customer_load(
        spark, paths, "2024-01-20 06:00:00", "s", "2024-01-20", 3, lineage=True, rejects=f"{scratch}/rejects")
    assert out["rejected_rows"] == bad.count() == spark.read.parquet(f"{scratch}/rejects").count()
    for name, spec in (("hub", cust.HUB_SPEC), ("general", cust.GENERAL_SPEC), ("phone", cust.PHONE_SPEC), ("email", cust.EMAIL_SPEC)):
        sources = {r[0] for r in read_table(spark, spec, getattr(paths, name)).select(cust.SOURCE).distinct().collect()}
        assert sources and all("dia=20" in s and s.endswith(".parquet") for s in sources)


def test_a_load_with_all_names_from_the_parameters(spark, scratch):
    two_days(spark, scratch)
    spark.sql("CREATE DATABASE IF NOT EXISTS params_schema_test")
    values = {
        cust.PARAM_PROCESS_DATE: "2024-01-20", cust.PARAM_LOOKBACK_DAYS: "3", cust.PARAM_LAKE: scratch, cust.PARAM_BRONZE: "bronze",
        cust.PARAM_SCHEMA: "params_schema_test", cust.PARAM_VAULT_CATALOG: "vault", cust.PARAM_DWH_CATALOG: "dwh",
    }
    params = spark.createDataFrame(list(values.items()), "Clave string, Valor string")
    before = spark.catalog.currentDatabase()
    out = cust.run_from_params(spark, params, "2024-01-20 06:00:00", {"bronze": "{LagoDatos}/{MedallaBronce}"})
    assert out["dim_version"] == 1 and spark.catalog.currentDatabase() == before
    hub = spark.table(f"params_schema_test.{cust.HUB_TABLE}")
    assert hub.count() > 0 and {r[0] for r in hub.select(cust.SOURCE).distinct().collect()} == {f"{scratch}/bronze"}
    assert spark.table(f"params_schema_test.{cust.DIM_TABLE}").count() > 1
    info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED params_schema_test.{cust.HUB_TABLE}").collect()}
    assert "lakevault.optimizeWrite=true" in info["Table Properties"] and info["Location"].endswith(f"/vault/{cust.HUB_TABLE}")
    for spec in (cust.HUB_SPEC, cust.GENERAL_SPEC, cust.PHONE_SPEC, cust.EMAIL_SPEC, cust.DIM_SPEC_TABLE):
        spark.sql(f"DROP TABLE params_schema_test.{spec.name}")
    missing = params.filter(F.col("Clave") != cust.PARAM_LAKE)
    with pytest.raises(KeyError):
        cust.run_from_params(spark, missing, "2024-01-20 06:00:00")


def test_replayed_lake_is_the_replayed_dimension(spark):
    paths = cust.replay_lake(spark, customer_bronze_two_days(spark, SF_SMALL), PIPELINE_RUNS, PIPELINE_LOOKBACK, "bronze/customers")
    assert rows(cust.read_dimension(spark, paths)) == rows(pipeline_dimension_frame(spark, SF_SMALL))
