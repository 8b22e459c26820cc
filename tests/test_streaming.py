"""Snapshots arriving as files drive the same loads through foreachBatch."""

from lakevault.plans import customer as cust
from lakevault.plans.testdata import customer_bronze_two_days
from lakevault.sources.tables import read_state
from lakevault.streaming import customer_snapshot_stream

from conftest import SF_SMALL


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_stream_of_two_days_equals_two_batch_runs(spark, scratch):
    bronze_all = customer_bronze_two_days(spark, SF_SMALL)
    schema = bronze_all.schema
    stream_paths = cust.LakePaths(f"{scratch}/s_bronze", *[f"{scratch}/s_{n}" for n in ("hub", "general", "phone", "email", "dim")])
    batch_paths = cust.LakePaths(f"{scratch}/b_bronze", *[f"{scratch}/b_{n}" for n in ("hub", "general", "phone", "email", "dim")])

    for day in (19, 20):  # day 1 lands, stream runs; day 2 lands, stream runs again
        part = bronze_all.filter(f"dia = {day}")
        part.write.mode("append").partitionBy("año", "mes", "dia").parquet(stream_paths.bronze)
        part.write.mode("append").partitionBy("año", "mes", "dia").parquet(batch_paths.bronze)
        q = customer_snapshot_stream(spark, stream_paths, schema, f"{scratch}/stream_ckpt", "bronze/customers")
        q.awaitTermination(600)
        assert q.exception() is None
        cust.run_customer_load(
            spark, batch_paths, f"2024-01-{day} 00:00:00", "bronze/customers", f"2024-01-{day}", 3
        )

    streamed, v1 = read_state(spark, cust.DIM_SPEC_TABLE, stream_paths.dim)
    batched, v2 = read_state(spark, cust.DIM_SPEC_TABLE, batch_paths.dim)
    assert v1 == v2 == 2
    assert rows(streamed) == rows(batched)


def test_two_snapshots_in_one_micro_batch_load_in_date_order(spark, scratch):
    bronze_all = customer_bronze_two_days(spark, SF_SMALL)
    stream_paths = cust.LakePaths(f"{scratch}/s_bronze", *[f"{scratch}/s_{n}" for n in ("hub", "general", "phone", "email", "dim")])
    batch_paths = cust.LakePaths(f"{scratch}/b_bronze", *[f"{scratch}/b_{n}" for n in ("hub", "general", "phone", "email", "dim")])
    # day 20 is written first: arrival order must not matter, dates decide
    for day in (20, 19):
        bronze_all.filter(f"dia = {day}").write.mode("append").partitionBy("año", "mes", "dia").parquet(stream_paths.bronze)
    bronze_all.write.partitionBy("año", "mes", "dia").parquet(batch_paths.bronze)
    q = customer_snapshot_stream(spark, stream_paths, bronze_all.schema, f"{scratch}/ckpt", "bronze/customers")
    q.awaitTermination(600)
    assert q.exception() is None
    for day in (19, 20):
        cust.run_customer_load(spark, batch_paths, f"2024-01-{day} 00:00:00", "bronze/customers", f"2024-01-{day}", 3)
    streamed, v1 = read_state(spark, cust.DIM_SPEC_TABLE, stream_paths.dim)
    batched, v2 = read_state(spark, cust.DIM_SPEC_TABLE, batch_paths.dim)
    assert v1 == v2 == 2
    assert rows(streamed) == rows(batched)


def test_stream_takes_the_options_of_the_batch_load_and_stores_rejects(spark, scratch):
    import pytest
    from pyspark.errors import StreamingQueryException
    from pyspark.sql import functions as F

    bronze = customer_bronze_two_days(spark, SF_SMALL)
    bad = bronze.filter("dia = 20").withColumn("mes", F.lit(13))
    bronze.unionByName(bad).write.partitionBy("año", "mes", "dia").parquet(f"{scratch}/bronze")
    names = ("hub", "general", "phone", "email", "dim")
    streamed = cust.LakePaths(f"{scratch}/bronze", *[f"{scratch}/s_{n}" for n in names])
    batch = cust.LakePaths(f"{scratch}/bronze", *[f"{scratch}/b_{n}" for n in names])
    options = dict(phone_how="left", mode="latest", gold="changes")
    q = customer_snapshot_stream(
        spark, streamed, bronze.schema, f"{scratch}/ckpt", "s", rejects=f"{scratch}/rejects", **options)
    q.awaitTermination(600)
    assert q.exception() is None
    for day in (19, 20):
        cust.run_customer_load(spark, batch, f"2024-01-{day} 00:00:00", "s", f"2024-01-{day}", 0, **options)
    assert rows(cust.read_dimension(spark, streamed, "changes")) == rows(cust.read_dimension(spark, batch, "changes"))
    assert spark.read.parquet(f"{scratch}/rejects").count() == bad.count()
    # without a place for them, rows without a date stop the stream
    other = cust.LakePaths(f"{scratch}/bronze", *[f"{scratch}/o_{n}" for n in names])
    with pytest.raises(StreamingQueryException):
        customer_snapshot_stream(spark, other, bronze.schema, f"{scratch}/ckpt2", "s").awaitTermination(600)
