"""Skew and partitioning properties.

A third of the rows get one hot key; results are compared with a brute-force
pandas computation on the same fixture, and plans must reduce the hot key
before the shuffle.
"""

import re

import pandas as pd
from pyspark.sql import functions as F

from lakevault.operators import LoadContext, hub_new_rows, latest_per_key, satellite_new_rows, satellite_stage
from lakevault.plans.queries import QUERIES, q_pipeline_dimension

from conftest import SF_MID, SF_SMALL, plan_text

HOT = 7


def hot_events(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("user_id")))


def test_latest_per_key_with_a_hot_key(spark):
    ev = hot_events(spark)
    got = latest_per_key(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").asc()]).select("user_id", "event_id")
    pdf = ev.select("user_id", "event_id", "ts").toPandas()
    pdf = pdf.sort_values(["user_id", "ts", "event_id"], ascending=[True, False, True])
    expect = pdf.groupby("user_id", as_index=False).head(1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect[["user_id", "event_id"]].itertuples(index=False)))
    plan = plan_text(got)
    assert "WindowGroupLimit" in plan and "Partial" in plan  # hot key cut to one row per map task


def test_hub_with_a_hot_key_aggregates_before_the_shuffle(spark):
    ev = hot_events(spark)
    empty = spark.createDataFrame([], "user_id bigint")
    new = hub_new_rows(ev, empty, {"user_id": F.col("user_id")}, LoadContext("2024-02-01 00:00:00", "e"))
    assert new.count() == ev.select("user_id").distinct().count()
    plan = new._jdf.queryExecution().executedPlan().toString()
    # the keys are reduced below the exchange (the tree prints parents first)
    assert re.search(r"HashAggregate\(keys=\[user_id[^\n]*\n[^\n]*Exchange hashpartitioning\(user_id[^\n]*\n[^\n]*HashAggregate\(keys=\[user_id", plan)


def test_satellite_with_a_hot_key_matches_brute_force(spark):
    ev = hot_events(spark)
    day = F.to_timestamp(F.lit("2024-01-20 00:00:00"))
    payload = {"user_id": F.col("user_id"), "event_type": F.col("event_type")}
    staged = satellite_stage(
        ev.filter(F.col("ts") >= day), "user_id", payload, diff_cols=[F.col("event_type")], diff_bits=256,
        hash_form="hex",
    )
    history = satellite_stage(
        ev.filter(F.col("ts") < day), "user_id", {**payload, "load_ts": F.col("ts")},
        diff_cols=[F.col("event_type")], diff_bits=256, hash_form="hex", dedupe=False,
    )
    got = satellite_new_rows(staged, history, LoadContext("2024-02-01 00:00:00", "e"))
    got_pairs = sorted((r["user_id"], r["event_type"]) for r in got.collect())

    pdf = ev.select("user_id", "event_type", "ts").toPandas()
    cut = pd.Timestamp("2024-01-20")
    seen = set(map(tuple, pdf[pdf.ts < cut][["user_id", "event_type"]].itertuples(index=False)))
    staged_pairs = set(map(tuple, pdf[pdf.ts >= cut][["user_id", "event_type"]].itertuples(index=False)))
    assert got_pairs == sorted(p for p in staged_pairs if p not in seen)


def test_satellite_plans_spread_hot_pairs_and_hot_keys(spark):
    ev = hot_events(spark)
    payload = {"user_id": F.col("user_id"), "event_type": F.col("event_type")}
    staged = satellite_stage(ev, "user_id", payload, diff_cols=[F.col("event_type")], diff_bits=256, hash_form="hex")
    history = satellite_stage(ev, "user_id", {**payload, "load_ts": F.col("ts")}, diff_cols=[F.col("event_type")],
                              diff_bits=256, hash_form="hex", dedupe=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mode in ("ever_seen", "latest"):
            new = satellite_new_rows(staged, history, LoadContext("2024-02-01 00:00:00", "e"), mode=mode)
            plan = new._jdf.queryExecution().executedPlan().toString()
            exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
            pairs = [x for x in exchanges if "hk#" in x and "hd#" in x]
            keys = [x for x in exchanges if "hk#" in x and "hd#" not in x]
            assert len(pairs) == 2, plan  # candidates once, history once
            assert len(keys) == (1 if mode == "latest" else 0)  # the newest row per key, limited before its exchange
            below = plan[plan.rindex("Exchange hashpartitioning(hk"):]
            assert ("WindowGroupLimit" if mode == "latest" else "HashAggregate(keys=[hk#") in below
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_pipeline_independent_of_shuffle_partitions(spark):
    results = []
    for parts in ("1", "37"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            results.append(sorted(tuple(str(v) for v in r) for r in q_pipeline_dimension(spark, SF_SMALL).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_every_registered_query_is_independent_of_shuffle_partitions(spark):
    def run(parts):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            out = {}
            for name, fn in QUERIES.items():
                df = fn(spark, SF_SMALL)
                out[name] = sorted(tuple(str(v) for v in r) for r in df.collect())
            return out
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    one, many = run("1"), run("37")
    assert [n for n in one if one[n] != many[n]] == []


def test_no_registered_query_plans_a_cross_join(spark):
    bad = []
    for threshold in (str(10 * 1024 * 1024), "-1"):  # default, and every side treated as large
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            for name, fn in QUERIES.items():
                plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
                if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
                    bad.append((threshold, name))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert bad == []
