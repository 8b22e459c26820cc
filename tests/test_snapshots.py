import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakevault.sources import latest_snapshot, run_window, snapshot_date_from_parts
from conftest import plan_text
from lakevault.sources.params import AmbiguousParameterError, MissingParameterError, load_params


def write_days(spark, path, days):
    rows = [(i, 2024, 1, d) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "customer_id int, `año` int, mes int, dia int")
    df.write.partitionBy("año", "mes", "dia").parquet(path)
    return spark.read.parquet(path)


def test_run_window():
    w = run_window("2024-01-20", 5)
    assert (w.start, w.end) == (dt.date(2024, 1, 15), dt.date(2024, 1, 20))
    assert run_window("2024-01-20 10:11:12", "0").start == dt.date(2024, 1, 20)


@pytest.mark.parametrize(
    "days, chosen",
    [([14, 15, 18], 18), ([15], 15), ([20, 21], 20), ([14], None)],
)
def test_latest_snapshot_choice(spark, scratch, days, chosen):
    bronze = write_days(spark, f"{scratch}/bronze", days)
    snap, newest = latest_snapshot(bronze, run_window("2024-01-20", 5), snapshot_date_from_parts())
    if chosen is None:
        assert newest is None and snap.count() == 0
    else:
        assert newest == dt.date(2024, 1, chosen)
        assert [r["dia"] for r in snap.select("dia").distinct().collect()] == [chosen]


def test_latest_snapshot_prunes_partitions(spark, scratch):
    bronze = write_days(spark, f"{scratch}/bronze", [14, 15, 18])
    snap, _ = latest_snapshot(bronze, run_window("2024-01-20", 5), snapshot_date_from_parts())
    plan = plan_text(snap)
    # the chosen date is a partition filter over año/mes/dia; no data filter
    assert "PartitionFilters: [(gettimestamp(concat_ws" in plan and "2024-01-18" in plan
    assert snap.count() == 1


def test_latest_snapshot_from_timestamp_pushes_range(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    snap, newest = latest_snapshot(events, run_window("2024-01-20", 5), timestamp_col="ts")
    assert newest == dt.date(2024, 1, 20)
    plan = snap._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan
    assert snap.filter(F.to_date("ts") != F.lit(newest)).count() == 0


def test_load_params_single_job_and_missing_key(spark):
    params = spark.createDataFrame(
        [("FechaProceso", "2024-01-20"), ("DiasCargarBorrar", "5"), ("Otro", "x")], "Clave string, Valor string"
    )
    assert load_params(params, ["FechaProceso", "DiasCargarBorrar"], "Clave", "Valor") == {
        "FechaProceso": "2024-01-20",
        "DiasCargarBorrar": "5",
    }
    with pytest.raises(MissingParameterError):
        load_params(params, ["FechaProceso", "Nope"], "Clave", "Valor")
    with pytest.raises(AmbiguousParameterError):
        load_params(params.union(params.selectExpr("Clave", "concat(Valor, '1')")), ["FechaProceso"], "Clave", "Valor")


def test_invalid_partition_date_is_ignored_not_fatal(spark, scratch):
    rows = [(1, 2024, 1, 18), (2, 2024, 13, 1), (3, 2024, 2, 30)]  # month 13, 30 February
    df = spark.createDataFrame(rows, "customer_id int, `año` int, mes int, dia int")
    df.write.partitionBy("año", "mes", "dia").parquet(f"{scratch}/bronze")
    bronze = spark.read.parquet(f"{scratch}/bronze")
    snap, newest = latest_snapshot(bronze, run_window("2024-03-05", 60), snapshot_date_from_parts())
    assert newest == dt.date(2024, 1, 18)
    assert [r["customer_id"] for r in snap.collect()] == [1]
