"""Gold from changed keys: change log, point-in-time table, tables stored by key."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.operators.pit import pit_rows
from lakevault.plans import customer as cust
from lakevault.plans import incremental as inc
from lakevault.plans.queries import PIPELINE_LOOKBACK, PIPELINE_RUNS, pipeline_dimension_frame, pit_in_two_loads, q_pit_view, q_current_entity_view
from lakevault.plans.testdata import customer_bronze_two_days
from lakevault.sources.keyed import KeyedTable
from lakevault.sources.tables import ColumnSpec, TableSpec

from conftest import SF_SMALL, plan_text

SPEC = TableSpec("kv", (ColumnSpec("k", T.IntegerType()), ColumnSpec("v", T.StringType(), nullable=True)))


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def lake(scratch, name):
    return cust.LakePaths(f"{scratch}/bronze", *[f"{scratch}/{name}_{n}" for n in ("hub", "general", "phone", "email", "dim")])


def files_by_part(df):
    out = {}
    for f in df.inputFiles():
        part = next(x for x in f.split("/") if x.startswith("part="))
        out.setdefault(part, set()).add(f.split("/")[-1])
    return out


def test_upsert_rewrites_only_touched_partitions(spark, scratch):
    t = KeyedTable(SPEC, f"{scratch}/kv", ("k",), 8)
    first = spark.range(200).selectExpr("id AS k", "'old' AS v")  # bigint keys, conformed before hashing
    assert len(t.upsert(first, {"upto": 1}, greatest="k")) == 8
    before = files_by_part(t.read(spark))
    touched = t.upsert(spark.createDataFrame([(3, "new"), (1000, None)], "k int, v string"), {"upto": 2}, greatest="k")
    after = files_by_part(t.read(spark))
    assert 1 <= len(touched) <= 2
    for part, names in before.items():
        assert (after[part] == names) == (int(part.split("=")[1]) not in touched)
    got = {r.k: r.v for r in t.read(spark).collect()}
    assert got == {**{k: "old" for k in range(200)}, 3: "new", 1000: None}
    assert t.state(spark) == {"upto": 2, "k": 1000}
    assert t.upsert(first.limit(0), {"upto": 3}) == [] and t.state(spark)["upto"] == 3
    some = spark.createDataFrame([(3,), (5000,)], "k int")
    assert rows(t.rows_of(spark, some)) == [("3", "new")]


def test_an_interrupted_upsert_is_finished_by_the_next_reader(spark, scratch, monkeypatch):
    t = KeyedTable(SPEC, f"{scratch}/kv", ("k",), 4)
    t.upsert(spark.range(50).selectExpr("id AS k", "'old' AS v"), {"upto": 1})

    def dies(self, *a):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_publish", dies)
        with pytest.raises(RuntimeError):
            t.upsert(spark.createDataFrame([(7, "new")], "k int, v string"), {"upto": 2})
    assert t.state(spark) == {"upto": 2}  # repeats the last step
    assert {r.k: r.v for r in t.read(spark).collect()} == {**{k: "old" for k in range(50)}, 7: "new"}


@pytest.mark.parametrize("gold", inc.MODES)
def test_incremental_runs_equal_full_ones(spark, scratch, gold):
    customer_bronze_two_days(spark, SF_SMALL).write.partitionBy("año", "mes", "dia").parquet(f"{scratch}/bronze")
    paths = lake(scratch, gold)
    outs = []
    for day, ts in (*PIPELINE_RUNS, PIPELINE_RUNS[1]):
        outs.append(cust.run_customer_load(spark, paths, ts, "bronze/customers", day, PIPELINE_LOOKBACK, gold=gold))
    assert [o["dim_upto"] for o in outs] == [1, 2, 3]
    assert outs[2]["dim_parts_written"] == []  # the same snapshot again writes nothing
    dim = cust.read_dimension(spark, paths, gold)
    assert rows(dim) == rows(pipeline_dimension_frame(spark, SF_SMALL))
    ids = sorted(r[0] for r in dim.select(cust.DIM_ID).collect())
    assert ids == [-1] + list(range(1, len(ids)))


def test_an_interrupted_load_is_finished_by_the_next(spark, scratch, monkeypatch):
    """Rows appended to one table only: the load is sealed later, and gold sees all of it."""
    bronze = customer_bronze_two_days(spark, SF_SMALL)
    bronze.write.partitionBy("año", "mes", "dia").parquet(f"{scratch}/bronze")
    paths, whole = lake(scratch, "cut"), lake(scratch, "whole")
    plain = cust.SilverTables.append

    def dies(self, name, df):
        if name == "phone":
            raise RuntimeError("driver lost")
        plain(self, name, df)

    args = (PIPELINE_RUNS[0][1], "s", PIPELINE_RUNS[0][0], PIPELINE_LOOKBACK)
    with monkeypatch.context() as m:
        m.setattr(cust.SilverTables, "append", dies)
        with pytest.raises(RuntimeError):
            cust.run_customer_load(spark, paths, *args, gold="changes")
    cust.run_customer_load(spark, paths, *args, gold="changes")
    cust.run_customer_load(spark, whole, *args, gold="changes")
    assert rows(cust.read_dimension(spark, paths, "changes")) == rows(cust.read_dimension(spark, whole, "changes"))
    for name in ("hub", "general", "phone"):
        assert rows(spark.read.parquet(getattr(paths, name))) == rows(spark.read.parquet(getattr(whole, name)))


def test_the_semi_join_is_below_the_window(spark, scratch):
    customer_bronze_two_days(spark, SF_SMALL).write.partitionBy("año", "mes", "dia").parquet(f"{scratch}/bronze")
    paths = lake(scratch, "plan")
    cust.run_customer_load(spark, paths, PIPELINE_RUNS[0][1], "s", PIPELINE_RUNS[0][0], PIPELINE_LOOKBACK, gold="changes")
    silver = cust.SilverTables(spark, paths, None)
    log = inc.change_log(spark, paths, silver)
    keys = log.keys_since(spark, cust.HK, 0, 1, inc.TRACKED)
    view = inc.changed_view(spark, paths, silver, log, keys, 1, "changes")
    lines = view._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    windows = [i for i, x in enumerate(lines) if "Window [row_number" in x]
    assert len(windows) == 2
    for i in windows:
        below = [x for x in lines[i + 1 :]]
        below = below[: next((k for k, x in enumerate(below) if depth(x) <= depth(lines[i])), len(below))]
        assert any("LeftSemi" in x for x in below)
    # the point-in-time way has no window over the satellites at all
    pit = inc.current_of_pit(inc.update_pit(spark, paths, log, 1).read(spark))
    assert "Window" not in plan_text(pit) and rows(pit) == rows(view)


def test_pit_table_keeps_the_newest_rows(spark, scratch):
    assert rows(q_pit_view(spark, SF_SMALL)) == rows(q_current_entity_view(spark, SF_SMALL))
    pit = pit_in_two_loads(spark, SF_SMALL, f"{scratch}/pit", 4)
    assert pit.read(spark).groupBy("hk").count().filter("count > 1").count() == 0


def test_pit_ties_and_late_rows(spark):
    """An older row that comes later doesn't replace a newer one; ties go to the smaller diff hash."""
    lay = inc.PIT_LAYOUT
    ts = lambda d: F.to_timestamp(F.lit(f"2024-01-{d:02d} 00:00:00"))

    def phone(day, hd, code):
        return spark.range(1).select(
            F.lit(b"k").alias(cust.HK), ts(day).alias(cust.LOAD), F.lit(hd).alias(cust.HD), F.lit(code).alias(cust.PHONE_CODE),
            F.lit(1).alias(cust.PHONE_NUMBER), F.lit("s").alias(cust.SOURCE))

    hub = spark.range(1).select(F.lit(b"k").alias(cust.HK), F.lit(5).alias(cust.BK))
    keys = hub.select(cust.HK)
    none = {"general": spark.createDataFrame([], cust.GENERAL_SPEC.schema)}
    stored = spark.createDataFrame([], lay.spec.schema)
    for new, want in ((phone(5, b"b", "(5)"), "(5)"), (phone(3, b"a", "(3)"), "(5)"), (phone(5, b"a", "(5a)"), "(5a)"), (phone(6, b"z", "(6)"), "(6)")):
        stored = spark.createDataFrame(pit_rows(stored, hub, {**none, "phone": new}, keys, lay).collect(), lay.spec.schema)
        assert [(r[cust.BK], r[f"phone_{cust.PHONE_CODE}"], r[f"general_{cust.HD}"]) for r in stored.collect()] == [(5, want, None)]


def test_gold_runs_few_jobs(spark, scratch):
    """The statistics come from the classification's write: no job of their own (A5, A3, N2)."""
    from lakevault.operators.dimension import classify_once

    dim = pipeline_dimension_frame(spark, SF_SMALL)
    view = dim.filter(F.col(cust.DIM_ID) > 0).select(
        F.col(cust.DIM_BK).alias(cust.BK), *cust.GENERAL_ATTRS, F.col(cust.DIM_PHONE_CODE).alias(cust.PHONE_CODE))
    more = view.limit(1).withColumn(cust.BK, F.lit(10**8))
    changed = view.withColumn("Nombre", F.when(F.col(cust.BK) % 10 == 0, F.lit("X")).otherwise(F.col("Nombre")))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}  # one job per action
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup("classify", "classify")
    try:
        found = classify_once(dim, changed.union(more), cust.DIM_SPEC)
        jobs = list(spark.sparkContext.statusTracker().getJobIdsForGroup("classify"))
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
        for k, v in before.items():
            spark.conf.set(k, v)
    assert (found.n_new, found.n_changed) == (1, view.filter(F.col(cust.BK) % 10 == 0).count())
    assert found.max_id == view.count()
    assert len(jobs) == 1  # the write's own


def test_the_dimension_by_name_stays_current(spark, scratch):
    customer_bronze_two_days(spark, SF_SMALL).write.partitionBy("año", "mes", "dia").parquet(f"{scratch}/bronze")
    paths = lake(scratch, "named")
    for day, ts in PIPELINE_RUNS:
        cust.run_customer_load(
            spark, paths, ts, "bronze/customers", day, PIPELINE_LOOKBACK, gold="pit", register_tables=True, table_prefix="inc_",
            selective=True)
    named = spark.table(f"inc_{cust.DIM_TABLE}")
    assert rows(named) == rows(pipeline_dimension_frame(spark, SF_SMALL))
    assert named.schema.simpleString() == cust.DIM_SPEC_TABLE.schema.simpleString()
    spark.sql(f"DROP VIEW inc_{cust.DIM_TABLE}")
    for spec in (cust.HUB_SPEC, cust.GENERAL_SPEC, cust.PHONE_SPEC, cust.EMAIL_SPEC):
        spark.sql(f"DROP TABLE inc_{spec.name}")


def test_two_writers_of_one_table(spark, scratch, monkeypatch):
    """The slower of two runs that read the same state doesn't overwrite the faster one's rows."""
    from lakevault.sources import keyed
    from lakevault.sources.tables import ConcurrentWriteError, read_state, write_state

    t = KeyedTable(SPEC, f"{scratch}/kv", ("k",), 4)
    t.upsert(spark.range(5).selectExpr("id AS k", "'old' AS v"))
    plain, racing = keyed.write_observed, []

    def slow(write, df, **metrics):
        if not racing:
            racing.append(1)
            t.upsert(spark.createDataFrame([(1, "faster")], "k int, v string"))
        return plain(write, df, **metrics)

    with monkeypatch.context() as m:
        m.setattr(keyed, "write_observed", slow)
        with pytest.raises(ConcurrentWriteError):
            t.upsert(spark.createDataFrame([(1, "slower")], "k int, v string"))
    assert {r.k: r.v for r in t.read(spark).collect()}[1] == "faster"

    state, version = read_state(spark, SPEC, f"{scratch}/versions")
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    write_state(first, SPEC, f"{scratch}/versions", version)
    with pytest.raises(ConcurrentWriteError):
        write_state(first, SPEC, f"{scratch}/versions", version)
    assert read_state(spark, SPEC, f"{scratch}/versions")[1] == 1


def test_a_load_leaves_no_intermediate_tables(spark, scratch):
    import os

    from lakevault.session import ensure_checkpoint_dir

    customer_bronze_two_days(spark, SF_SMALL).write.partitionBy("año", "mes", "dia").parquet(f"{scratch}/bronze")
    folder = f"{ensure_checkpoint_dir(spark)}/materialized"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    for gold in ("full", *inc.MODES):
        cust.run_customer_load(spark, lake(scratch, gold), PIPELINE_RUNS[0][1], "s", PIPELINE_RUNS[0][0], PIPELINE_LOOKBACK, gold=gold)
    assert set(os.listdir(folder)) == before
