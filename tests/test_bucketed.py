"""Bucketed satellite storage: the history side of the anti join is not shuffled."""

import pytest

from lakevault.operators import LoadContext
from lakevault.plans import customer as cust
from lakevault.plans.testdata import customer_snapshot
from lakevault.sources.tables import Bucketing, append_bucketed, ensure_bucketed_table, read_bucketed

from conftest import SF_SMALL


def test_bucketed_history_anti_join_shuffles_only_candidates(spark, scratch):
    b = Bucketing("sat_general_bucketed_test", (cust.HK, cust.HD), 8)
    ensure_bucketed_table(spark, cust.GENERAL_SPEC, f"{scratch}/sat", b)
    snap = customer_snapshot(spark, SF_SMALL)
    ctx1 = LoadContext("2024-01-19 00:00:00", "s")
    append_bucketed(cust.general_rows(snap, read_bucketed(spark, b), ctx1), cust.GENERAL_SPEC, b)
    stored = read_bucketed(spark, b)
    first = stored.count()
    assert first > 0
    files = {f.split("/")[-1].split("_")[-1].split(".")[0] for f in stored.inputFiles()}
    assert len(stored.inputFiles()) <= 8 and len(files) <= 8  # one file per bucket

    new = cust.general_rows(snap, read_bucketed(spark, b), LoadContext("2024-01-20 00:00:00", "s"))
    assert new.count() == 0  # same snapshot again: nothing new
    # the plan at scale: no broadcast, sort-merge anti join
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # one exchange on the join keys: the candidates', hashed like the buckets;
    # the stored history is read already partitioned (no exchange of its own)
    assert plan.count("Exchange hashpartitioning(Hk_Clientes#") == 1
    spark.sql(f"DROP TABLE {b.table}")


def test_bucketed_customer_runs_equal_plain_runs(spark, scratch):
    from lakevault.plans.testdata import customer_bronze_two_days
    from lakevault.sources.tables import read_state

    bronze = f"{scratch}/bronze"
    customer_bronze_two_days(spark, SF_SMALL).write.partitionBy("año", "mes", "dia").parquet(bronze)
    plain = cust.LakePaths(bronze, *[f"{scratch}/p_{n}" for n in ("hub", "general", "phone", "email", "dim")])
    bucketed = cust.LakePaths(bronze, *[f"{scratch}/b_{n}" for n in ("hub", "general", "phone", "email", "dim")])
    for day in (19, 20):
        args = (f"2024-01-{day} 06:00:00", "bronze/customers", f"2024-01-{day}", 3)
        cust.run_customer_load(spark, plain, *args)
        cust.run_customer_load(spark, bucketed, *args, buckets=8, table_prefix="bkt_")
    a, _ = read_state(spark, cust.DIM_SPEC_TABLE, plain.dim)
    b, _ = read_state(spark, cust.DIM_SPEC_TABLE, bucketed.dim)
    as_rows = lambda df: sorted(tuple(str(v) for v in r) for r in df.collect())
    assert as_rows(a) == as_rows(b)
    assert spark.table("bkt_" + cust.HUB_TABLE).count() == spark.read.parquet(plain.hub).count()

    # the stored dimension is read bucketed: the SCD-1 join shuffles only the view
    from lakevault.operators import scd1_classify
    from lakevault.sources.tables import Bucketing as B

    dim, version = read_state(spark, cust.DIM_SPEC_TABLE, bucketed.dim, B("bkt_" + cust.DIM_TABLE, (cust.DIM_BK,), 8))
    view = a.filter(a[cust.DIM_ID] > 0).select(
        a[cust.DIM_BK].alias(cust.BK), *cust.GENERAL_ATTRS, a[cust.DIM_PHONE_CODE].alias(cust.PHONE_CODE)
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = scd1_classify(dim, view, cust.DIM_SPEC)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Bucketed: true" in plan and "FullOuter" in plan
    assert plan.count("Exchange hashpartitioning(") == 1  # the view's; none for the dimension
    for spec in (cust.HUB_SPEC, cust.GENERAL_SPEC, cust.PHONE_SPEC, cust.EMAIL_SPEC):
        spark.sql(f"DROP TABLE bkt_{spec.name}")
    for v in (1, 2):
        spark.sql(f"DROP TABLE IF EXISTS bkt_{cust.DIM_TABLE}_v{v}")


def test_two_lakes_with_the_same_table_names_raise(spark, scratch):
    from lakevault.plans import customer as cust
    from lakevault.sources.tables import Bucketing, ensure_bucketed_table

    b = Bucketing("two_lakes_hub", (cust.BK,), 4)
    ensure_bucketed_table(spark, cust.HUB_SPEC, f"{scratch}/a/hub", b)
    ensure_bucketed_table(spark, cust.HUB_SPEC, f"{scratch}/a/hub", b)
    with pytest.raises(ValueError, match="another table prefix"):
        ensure_bucketed_table(spark, cust.HUB_SPEC, f"{scratch}/b/hub", b)
