"""Declared tables: create-if-absent, typed appends, NOT NULL on write."""

import pytest
from pyspark.sql import functions as F

from lakevault.plans import customer as cust
from lakevault.sources.tables import append_rows, ensure_table, read_table


def test_ensure_table_registers_declared_schema_once(spark, scratch):
    path = f"{scratch}/hub"
    ensure_table(spark, cust.HUB_SPEC, path, "hub_declared_test")
    ensure_table(spark, cust.HUB_SPEC, path, "hub_declared_test")  # idempotent
    cols = {c.name: c for c in spark.catalog.listColumns("hub_declared_test")}
    assert list(cols) == cust.HUB_SPEC.column_names
    assert cols[cust.BK].dataType == "int" and cols[cust.HK].dataType == "binary"
    assert cols[cust.HK].description == "hash of the business key"
    assert cols[cust.BK].isCluster  # CLUSTER BY (business key), as declared
    info = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED hub_declared_test").collect()}
    assert info["Comment"] == cust.HUB_SPEC.comment and info["Type"] == "EXTERNAL"
    spark.sql("DROP TABLE hub_declared_test")


def test_append_casts_types_and_enforces_not_null(spark, scratch):
    path = f"{scratch}/hub"
    good = spark.createDataFrame([(b"ab", 5, "s")], "h binary, k long, src string").select(
        F.col("h").alias(cust.HK),
        F.col("k").alias(cust.BK),
        F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias(cust.LOAD),
        F.col("src").alias(cust.SOURCE),
    )
    append_rows(good, cust.HUB_SPEC, path)
    stored = read_table(spark, cust.HUB_SPEC, path)
    assert stored.schema[cust.BK].dataType.simpleString() == "int"
    assert stored.count() == 1
    bad = good.withColumn(cust.SOURCE, F.lit(None).cast("string"))
    with pytest.raises(Exception, match="NULL in NOT NULL column Hub_Clientes.FuenteDatos"):
        append_rows(bad, cust.HUB_SPEC, path)
    assert read_table(spark, cust.HUB_SPEC, path).count() == 1  # failed append left nothing


def test_read_table_of_missing_path_is_empty(spark, scratch):
    assert read_table(spark, cust.GENERAL_SPEC, f"{scratch}/nothing").count() == 0


def test_merge_writers_refuse_plain_parquet_tables(spark, scratch):
    from lakevault.sources.tables import merge_insert_only, merge_upsert

    ensure_table(spark, cust.HUB_SPEC, f"{scratch}/hub", "hub_merge_test")
    rows = spark.table("hub_merge_test")
    with pytest.raises(ValueError, match="no row-level MERGE"):
        merge_insert_only(rows, "hub_merge_test", [cust.BK])
    with pytest.raises(ValueError, match="no row-level MERGE"):
        merge_upsert(rows, "hub_merge_test", [cust.BK])
    spark.sql("DROP TABLE hub_merge_test")


def test_customer_run_registers_declared_silver_tables(spark, scratch):
    from lakevault.plans.testdata import customer_bronze_two_days
    from conftest import SF_SMALL

    customer_bronze_two_days(spark, SF_SMALL).write.partitionBy("año", "mes", "dia").parquet(f"{scratch}/bronze")
    paths = cust.LakePaths(f"{scratch}/bronze", *[f"{scratch}/{n}" for n in ("hub", "general", "phone", "email", "dim")])
    cust.run_customer_load(
        spark, paths, "2024-01-20 06:00:00", "s", "2024-01-20", 3, register_tables=True, table_prefix="reg_"
    )
    for spec in (cust.HUB_SPEC, cust.GENERAL_SPEC, cust.PHONE_SPEC, cust.EMAIL_SPEC):
        table = f"reg_{spec.name}"
        assert spark.table(table).count() == spark.read.parquet(getattr(paths, {
            cust.HUB_TABLE: "hub", cust.SAT_GENERAL_TABLE: "general", cust.SAT_PHONE_TABLE: "phone",
            cust.SAT_EMAIL_TABLE: "email"}[spec.name])).count() > 0
        spark.sql(f"DROP TABLE {table}")
    from lakevault.sources.tables import read_state

    state, _ = read_state(spark, cust.DIM_SPEC_TABLE, paths.dim)
    named = spark.table(f"reg_{cust.DIM_TABLE}")
    assert sorted(map(str, named.select(*state.columns).collect())) == sorted(map(str, state.collect()))
    spark.sql(f"DROP TABLE reg_{cust.DIM_TABLE}")


def test_a_foreign_error_is_not_an_empty_table(spark, scratch, monkeypatch):
    from pyspark.errors import AnalysisException
    from pyspark.sql import DataFrameReader

    from lakevault.plans import customer as cust
    from lakevault.sources.tables import read_table

    def fails(self, *a, **k):
        raise AnalysisException("bucket does not exist for now")

    monkeypatch.setattr(DataFrameReader, "parquet", fails)
    with pytest.raises(AnalysisException):
        read_table(spark, cust.HUB_SPEC, f"{scratch}/hub")


def test_versions_without_a_commit_log_raise(spark, scratch):
    from lakevault.plans import customer as cust
    from lakevault.sources.tables import read_state

    for v in (1, 2):
        spark.range(1).write.parquet(f"{scratch}/dim/version={v}")
    with pytest.raises(RuntimeError):
        read_state(spark, cust.DIM_SPEC_TABLE, f"{scratch}/dim")
