"""The registered queries: every operator run on the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables.  Hashes are returned as hex text and timestamps as
``yyyy-MM-dd HH:mm:ss`` text so an independent SQL engine can reproduce
every value (see ``oracle.py``).  The oracle cannot compute SHA-512, so the
diff hashes here use 256 bits (``diff_bits`` is a parameter of the
operators; the 512-bit default is checked against ``hashlib`` in the tests).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.functions.columns import (
    FIELD_SEPARATOR,
    clean_positive_int,
    clean_text,
    drop_null_tokens,
    hash_diff,
    hash_key,
    split_phone,
    timestamp_text,
)
from lakevault.operators.context import LoadContext
from lakevault.operators.dimension import (
    DimensionSpec,
    ensure_unknown_member,
    max_surrogate_key,
    scd1_changed,
    scd1_delta,
    scd1_merge,
    scd1_new,
)
from lakevault.operators.entity import SatelliteView, current_entity_view
from lakevault.operators.hub import hub_new_rows
from lakevault.operators.latest import latest_per_key
from lakevault.operators.pit import PitLayout, pit_rows, pit_view
from lakevault.operators.satellite import satellite_new_rows, satellite_stage
from lakevault.operators.surrogate import assign_surrogate_keys
from lakevault.plans import customer as cust
from lakevault.plans.testdata import customer_bronze_two_days, customer_snapshot, table
from lakevault.sources.keyed import KeyedTable, RangeTable
from lakevault.sources.params import load_params
from lakevault.sources.snapshots import (
    SOURCE_FILE,
    latest_snapshot,
    newest_folder,
    run_window,
    store_rejects,
    with_source_file,
)
from lakevault.sources.tables import ColumnSpec, TableSpec, append_rows, empty_frame, materialize, read_table, scratch_table

# Pinned run values shared with the oracle text.
LOAD_TS = "2024-02-01 00:00:00"
HUB_OLD_TS = "1996-01-01 00:00:00"
DIM_OLD_TS = "2024-01-01 00:00:00"
ORDERS_SPLIT = "1996-01-01 00:00:00"
PROCESS_DATE = "2024-01-20"
LOOKBACK_DAYS = 5
PIPELINE_RUNS = (("2024-01-19", "2024-01-19 06:00:00"), ("2024-01-20", "2024-01-20 06:00:00"))
PIPELINE_LOOKBACK = 3


def _hex(name: str) -> F.Column:
    return F.col(name).cast("string").alias(name)


def _ts(name: str) -> F.Column:
    return timestamp_text(name).alias(name)


# --- snapshots ----------------------------------------------------------------------


def q_snapshot_latest(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    snap, _ = latest_snapshot(events, run_window(PROCESS_DATE, LOOKBACK_DAYS), timestamp_col="ts")
    return snap.select(
        "event_id", "user_id", "event_type", F.date_format(F.col("ts").cast("date"), "yyyy-MM-dd").alias("snapshot_date")
    )


def q_snapshot_empty_window(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    snap, _ = latest_snapshot(events, run_window("2023-12-31", LOOKBACK_DAYS), timestamp_col="ts")
    return snap.agg(F.count(F.lit(1)).alias("n_rows"))


# --- hub ------------------------------------------------------------------------------


def _orders_hub(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders")
    split = F.to_timestamp(F.lit(ORDERS_SPLIT))
    before = orders.filter(F.col("o_orderdate") < split)
    after = orders.filter(F.col("o_orderdate") >= split)
    keys = {"customer_key": F.col("o_custkey")}
    empty = empty_frame(spark, "customer_key bigint")
    existing = hub_new_rows(before, empty, keys, LoadContext(HUB_OLD_TS, "orders"), hash_form="hex")
    new = hub_new_rows(after, existing, keys, LoadContext(LOAD_TS, "orders"), hash_form="hex")
    return existing, new


def q_hub_new_keys(spark: SparkSession, sf: str) -> DataFrame:
    _, new = _orders_hub(spark, sf)
    return new.select("hk", "customer_key", _ts("load_ts"), "record_source")


def q_hub_merged(spark: SparkSession, sf: str) -> DataFrame:
    existing, new = _orders_hub(spark, sf)
    return existing.unionByName(new).select("hk", "customer_key", _ts("load_ts"), "record_source")


# --- column functions -------------------------------------------------------------


def q_hash_key_256(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select("c_custkey", hash_key("c_custkey", bits=256, form="hex").alias("hk"))


def q_hash_diff_256(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey",
        hash_diff("c_custkey", "c_name", "c_mktsegment", "c_nationkey", bits=256, form="hex").alias("hd"),
    )


def q_hash_diff_compat(spark: SparkSession, sf: str) -> DataFrame:
    """The stored tables' form of the change hash: no separator."""
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey", hash_diff("c_custkey", "c_name", "c_mktsegment", "c_nationkey", bits=256, sep="", form="hex").alias("hd")
    )


def q_clean_attributes(spark: SparkSession, sf: str) -> DataFrame:
    snap = customer_snapshot(spark, sf)
    return snap.select(
        "c_custkey",
        "customer_id",
        clean_text("first_name", cust.NOT_RECORDED).alias("first_name"),
        clean_text("last_name", cust.NOT_RECORDED).alias("last_name"),
        clean_text("street", cust.NOT_RECORDED).alias("street"),
        clean_text("city", cust.NOT_RECORDED).alias("city"),
        clean_text("state", cust.STATE_NOT_RECORDED).alias("state"),
        clean_positive_int("zip_code", -1).alias("zip_code"),
    )


def q_split_phone(spark: SparkSession, sf: str) -> DataFrame:
    snap = customer_snapshot(spark, sf)
    area, rest, number = split_phone("phone")
    return snap.filter(drop_null_tokens("phone", ("NULL",))).select(
        "c_custkey",
        F.coalesce(F.col("customer_id"), F.lit(-1)).alias("customer_id"),
        area.alias("area_code"),
        rest.alias("phone_rest"),
        number.alias("phone_number"),
    )


def q_null_tokens_and(spark: SparkSession, sf: str) -> DataFrame:
    snap = customer_snapshot(spark, sf)
    return snap.filter(drop_null_tokens("phone", ("NULL",))).select("c_custkey", "phone")


def q_null_tokens_or(spark: SparkSession, sf: str) -> DataFrame:
    snap = customer_snapshot(spark, sf)
    return snap.filter(drop_null_tokens("email", ())).select("c_custkey", "email")


# --- latest per key and satellites -----------------------------------------------------


def q_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    newest = latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").asc()])
    return newest.select("user_id", "event_id", "event_type")


def _event_payload(with_load: bool) -> dict:
    payload = {
        "user_id": F.col("user_id"),
        "event_type": F.col("event_type"),
        "value_bucket": F.floor(F.col("value") / 10).cast("bigint"),
    }
    if with_load:
        payload["load_ts"] = F.col("ts")
    return payload


def _event_diff() -> list:
    return [F.col("event_type"), F.floor(F.col("value") / 10).cast("bigint")]


def _events_satellite(events: DataFrame, with_load: bool) -> DataFrame:
    # candidates (no load time) are de-duplicated; a history is only probed
    # by (hk, hd) or reduced to its newest row, so duplicates cannot matter
    return satellite_stage(
        events, "user_id", _event_payload(with_load), diff_cols=_event_diff(), diff_bits=256, hash_form="hex",
        dedupe=not with_load,
    )


def _satellite_events(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    events = table(spark, sf, "events")
    day = F.to_timestamp(F.lit(PROCESS_DATE + " 00:00:00"))
    staged = _events_satellite(events.filter(F.col("ts") >= day), with_load=False)
    history = _events_satellite(events.filter(F.col("ts") < day), with_load=True)
    new = satellite_new_rows(staged, history, LoadContext(LOAD_TS, "events"), mode=mode)
    return new.select("hk", "hd", "user_id", "event_type", "value_bucket", _ts("load_ts"), "record_source")


def q_satellite_new_ever_seen(spark: SparkSession, sf: str) -> DataFrame:
    return _satellite_events(spark, sf, "ever_seen")


def q_satellite_new_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _satellite_events(spark, sf, "latest")


def _customer_stage_out(staged: DataFrame) -> DataFrame:
    return staged.select(_hex(cust.HK), _hex(cust.HD), *[c for c in staged.columns if c not in (cust.HK, cust.HD)])


def q_general_stage(spark: SparkSession, sf: str) -> DataFrame:
    return _customer_stage_out(cust.general_stage(customer_snapshot(spark, sf), FIELD_SEPARATOR, diff_bits=256))


def q_phone_stage(spark: SparkSession, sf: str) -> DataFrame:
    return _customer_stage_out(cust.phone_stage(customer_snapshot(spark, sf), FIELD_SEPARATOR, diff_bits=256))


def q_email_stage(spark: SparkSession, sf: str) -> DataFrame:
    return _customer_stage_out(cust.email_stage(customer_snapshot(spark, sf), FIELD_SEPARATOR, diff_bits=256))


# --- current entity view -----------------------------------------------------------------


def _entity_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as a hub, their orders and events as satellites."""
    customer = table(spark, sf, "customer")
    orders = table(spark, sf, "orders")
    events = table(spark, sf, "events")
    empty = empty_frame(spark, "customer_key bigint")
    hub = hub_new_rows(customer, empty, {"customer_key": F.col("c_custkey")}, LoadContext(LOAD_TS, "customer"),
                       hash_form="hex")
    order_sat = satellite_stage(
        orders,
        "o_custkey",
        {"load_ts": F.col("o_orderdate"), "order_status": F.col("o_orderstatus"),
         "order_priority": F.col("o_orderpriority")},
        diff_cols=[F.col("o_orderstatus"), F.col("o_orderpriority")],
        diff_bits=256,
        hash_form="hex",
        dedupe=False,
    )
    return hub, order_sat, _events_satellite(events, with_load=True)


def q_current_entity_view(spark: SparkSession, sf: str) -> DataFrame:
    hub, order_sat, event_sat = _entity_tables(spark, sf)
    return current_entity_view(
        hub,
        [
            SatelliteView(order_sat, {"last_order_status": "order_status", "last_order_priority": "order_priority"}),
            SatelliteView(event_sat, {"last_event_type": "event_type", "last_value_bucket": "value_bucket"}),
        ],
        bk_cols=["customer_key"],
        keep_hk=True,
    )


# --- Type-1 dimension ---------------------------------------------------------------------

DIM_TEST_SPEC = DimensionSpec(
    id_col="dim_id",
    bk_cols=("customer_key",),
    attrs={"name": "name", "segment": "segment", "nation": "nation"},
    load_col="load_ts",
    unknown={"customer_key": -1, "name": "unknown", "segment": "unknown", "nation": "unknown"},
)


def _dim_source(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("nation"),
    )


def _dim_existing(spark: SparkSession, sf: str, source: DataFrame) -> DataFrame:
    k = F.col("customer_key")
    base = source.filter(k % 10 != 0).select(
        "customer_key",
        "name",
        F.when(k % 4 == 0, F.lit("OLD")).otherwise(F.col("segment")).alias("segment"),
        "nation",
    )
    numbered = assign_surrogate_keys(base, ["customer_key"], "dim_id", start_after=0)
    dim = numbered.select(
        "dim_id", "customer_key", "name", "segment", "nation", F.to_timestamp(F.lit(DIM_OLD_TS)).alias("load_ts")
    )
    return ensure_unknown_member(dim, DIM_TEST_SPEC, LoadContext(DIM_OLD_TS, "customer"))


def _dim_out(df: DataFrame) -> DataFrame:
    return df.select("dim_id", "customer_key", "name", "segment", "nation", _ts("load_ts"))


def _dim_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, LoadContext]:
    source = _dim_source(spark, sf)
    return _dim_existing(spark, sf, source), source, LoadContext(LOAD_TS, "customer")


def q_scd1_changed(spark: SparkSession, sf: str) -> DataFrame:
    dim, source, ctx = _dim_inputs(spark, sf)
    return _dim_out(scd1_changed(dim, source, DIM_TEST_SPEC, ctx))


def q_scd1_new(spark: SparkSession, sf: str) -> DataFrame:
    dim, source, ctx = _dim_inputs(spark, sf)
    return _dim_out(scd1_new(dim, source, DIM_TEST_SPEC, ctx))


def q_scd1_delta(spark: SparkSession, sf: str) -> DataFrame:
    dim, source, ctx = _dim_inputs(spark, sf)
    return _dim_out(scd1_delta(dim, source, DIM_TEST_SPEC, ctx))


def q_scd1_merged(spark: SparkSession, sf: str) -> DataFrame:
    dim, source, ctx = _dim_inputs(spark, sf)
    return _dim_out(scd1_merge(dim, source, DIM_TEST_SPEC, ctx))


def q_unknown_member(spark: SparkSession, sf: str) -> DataFrame:
    dim, _, ctx = _dim_inputs(spark, sf)
    twice = ensure_unknown_member(dim, DIM_TEST_SPEC, ctx)
    return twice.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.when(F.col("dim_id") == -1, F.lit(1))).alias("unknown_rows"),
    )


def q_max_surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    dim, _, _ = _dim_inputs(spark, sf)
    return max_surrogate_key(dim, DIM_TEST_SPEC)


def q_surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "lineitem").select("l_orderkey").distinct()
    return assign_surrogate_keys(orders, ["l_orderkey"], "order_id", start_after=100)


# --- parameters ------------------------------------------------------------------------------

PARAM_KEYS = ("AFRICA", "ASIA", "EUROPE")


def q_param_lookup(spark: SparkSession, sf: str) -> DataFrame:
    region = table(spark, sf, "region")
    found = load_params(region, PARAM_KEYS, key_col="r_name", value_col="r_regionkey")
    return spark.range(1).select(*[F.lit(found[k]).alias(k) for k in PARAM_KEYS])


# --- whole pipeline ------------------------------------------------------------------------------


def pipeline_dimension_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Two daily runs of the customer loads (hub, 3 satellites, dimension)
    through the production path: appends and dimension versions in storage."""
    bronze = customer_bronze_two_days(spark, sf)
    return cust.replay_runs(spark, bronze, PIPELINE_RUNS, PIPELINE_LOOKBACK, "bronze/customers")


def q_pipeline_dimension(spark: SparkSession, sf: str) -> DataFrame:
    dim = pipeline_dimension_frame(spark, sf)
    return dim.select(*[c for c in dim.columns if c != cust.LOAD], _ts(cust.LOAD))


# --- stored satellites, lineage, layouts, rejects ------------------------------------------------------


def _replayed(spark: SparkSession, sf: str, spec: TableSpec, name: str) -> DataFrame:
    paths = cust.replay_lake(spark, customer_bronze_two_days(spark, sf), PIPELINE_RUNS, PIPELINE_LOOKBACK, "bronze/customers")
    stored = read_table(spark, spec, getattr(paths, name))
    kept = [c for c in spec.column_names if c not in (cust.HK, cust.HD, cust.LOAD)]  # the oracle has no SHA-512
    return stored.select(_hex(cust.HK), _ts(cust.LOAD), *kept)


def q_pipeline_sat_phone(spark: SparkSession, sf: str) -> DataFrame:
    return _replayed(spark, sf, cust.PHONE_SPEC, "phone")


def q_pipeline_sat_email(spark: SparkSession, sf: str) -> DataFrame:
    return _replayed(spark, sf, cust.EMAIL_SPEC, "email")


def q_hub_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """A hub of customers that order or cause events; each key's record source is its (first) file's name."""
    file_name = F.element_at(F.split(F.col(SOURCE_FILE), "/"), -1).alias("file")
    orders = with_source_file(table(spark, sf, "orders")).select(F.col("o_custkey").alias("k"), file_name)
    events = with_source_file(table(spark, sf, "events")).select(F.col("user_id").alias("k"), file_name)
    empty = empty_frame(spark, "customer_key bigint")
    new = hub_new_rows(
        orders.unionByName(events), empty, {"customer_key": F.col("k")}, LoadContext(LOAD_TS, "unknown"), hash_form="hex",
        lineage="file",
    )
    return new.select("hk", "customer_key", _ts("load_ts"), "record_source")


HUB_RANGED_SPEC = TableSpec(
    "hub_by_range",
    (ColumnSpec("hk", T.StringType()), ColumnSpec("customer_key", T.LongType()), ColumnSpec("load_ts", T.TimestampType()),
     ColumnSpec("record_source", T.StringType())),
)


def hub_in_ranges(spark: SparkSession, sf: str, path: str, ranges: int = 8) -> RangeTable:
    """The orders hub after two loads, in files of disjoint key ranges."""
    existing, new = _orders_hub(spark, sf)
    hub = RangeTable.open(spark, HUB_RANGED_SPEC, path, "customer_key", existing, ranges)
    hub.upsert(existing)
    hub.upsert(new)
    return hub


def q_hub_ranged(spark: SparkSession, sf: str) -> DataFrame:
    hub = hub_in_ranges(spark, sf, scratch_table(spark, "hub"))
    return hub.read(spark).select("hk", "customer_key", _ts("load_ts"), "record_source")


def q_hub_selective(spark: SparkSession, sf: str) -> DataFrame:
    """The stored hub probed for the keys of the newest orders only."""
    orders = table(spark, sf, "orders")
    existing, _ = _orders_hub(spark, sf)
    stored = TableSpec("hub", HUB_RANGED_SPEC.columns, cluster_by=("customer_key",), bloom=("customer_key",))
    path = scratch_table(spark, "hub")
    append_rows(existing, stored, path)
    after = orders.filter(F.col("o_orderdate") >= F.to_timestamp(F.lit(ORDERS_SPLIT)))
    new = hub_new_rows(
        after, read_table(spark, stored, path), {"customer_key": F.col("o_custkey")}, LoadContext(LOAD_TS, "orders"),
        hash_form="hex", selective=True,
    )
    return new.select("hk", "customer_key", _ts("load_ts"), "record_source")


def q_snapshot_by_folder(spark: SparkSession, sf: str) -> DataFrame:
    """Events in day folders; the snapshot is chosen by folder names, other files stay closed."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    path = scratch_table(spark, "events")
    day = F.col("ts").cast("date")
    dated = events.select("*", F.year(day).alias("año"), F.month(day).alias("mes"), F.dayofmonth(day).alias("dia"))
    dated.repartition("año", "mes", "dia").write.partitionBy("año", "mes", "dia").parquet(path)
    snap, chosen = newest_folder(spark, path, events.schema, run_window(PROCESS_DATE, LOOKBACK_DAYS))
    return snap.select("event_id", "user_id", "event_type", F.lit(chosen.isoformat() if chosen else None).alias("snapshot_date"))


def q_snapshot_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose date parts were damaged, with the reason; stored and read back."""
    e = table(spark, sf, "events")
    i, day = F.col("event_id"), F.col("ts").cast("date")
    damaged = e.select(
        "event_id",
        F.year(day).cast("string").alias("año"),
        F.when(i % 77 == 0, F.lit("13")).when(i % 91 == 0, F.lit("x")).otherwise(F.month(day).cast("string")).alias("mes"),
        F.when(i % 50 == 0, F.lit("32")).when(i % 83 == 0, F.lit(None)).otherwise(F.dayofmonth(day).cast("string")).alias("dia"),
    )
    path = scratch_table(spark, "rejects")
    store_rejects(damaged, path, F.to_timestamp(F.lit(LOAD_TS)))
    return spark.read.parquet(path).select("event_id", "snapshot_text", "reason", _ts("load_ts"))


# --- incremental gold, stored by key ----------------------------------------------------------------


def q_dimension_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The same two daily runs; gold reads and writes only what each run changed."""
    bronze = customer_bronze_two_days(spark, sf)
    dim = cust.replay_runs(spark, bronze, PIPELINE_RUNS, PIPELINE_LOOKBACK, "bronze/customers", gold="changes")
    return dim.select(*[c for c in dim.columns if c != cust.LOAD], _ts(cust.LOAD))


def q_dimension_pit(spark: SparkSession, sf: str) -> DataFrame:
    """The same two daily runs; gold reads the point-in-time table."""
    bronze = customer_bronze_two_days(spark, sf)
    dim = cust.replay_runs(spark, bronze, PIPELINE_RUNS, PIPELINE_LOOKBACK, "bronze/customers", gold="pit")
    return dim.select(*[c for c in dim.columns if c != cust.LOAD], _ts(cust.LOAD))


PIT_TEST_LAYOUT = PitLayout(
    "pit", ColumnSpec("hk", T.StringType()), (ColumnSpec("customer_key", T.LongType()),),
    {
        "orders": (ColumnSpec("order_status", T.StringType()), ColumnSpec("order_priority", T.StringType())),
        "events": (ColumnSpec("event_type", T.StringType()), ColumnSpec("value_bucket", T.LongType())),
    },
    "load_ts", ColumnSpec("hd", T.StringType()),
)


def pit_in_two_loads(spark: SparkSession, sf: str, path: str, parts: int = 16) -> KeyedTable:
    """The customers' point-in-time table after two loads: rows before a date, then the rest.

    Order dates and event times are the satellites' load times.
    """
    pit = KeyedTable(PIT_TEST_LAYOUT.spec, path, ("hk",), parts)
    hub, orders, events = _entity_tables(spark, sf)
    day = F.to_timestamp(F.lit(PROCESS_DATE + " 00:00:00"))
    old_orders, old_events = F.col("load_ts") < F.to_timestamp(F.lit(ORDERS_SPLIT)), F.col("load_ts") < day
    for hub_new, o, e in (
        (hub, orders.filter(old_orders), events.filter(old_events)),
        (hub.limit(0), orders.filter(~old_orders), events.filter(~old_events)),
    ):
        keys = materialize(hub_new.select("hk").union(o.select("hk")).union(e.select("hk")).distinct(), "pit-keys")
        pit.upsert(pit_rows(pit.rows_of(spark, keys), hub_new, {"orders": o, "events": e}, keys, PIT_TEST_LAYOUT))
    return pit


def q_pit_view(spark: SparkSession, sf: str) -> DataFrame:
    pit = pit_in_two_loads(spark, sf, scratch_table(spark, "pit"))
    columns = {
        "last_order_status": F.col("orders_order_status"), "last_order_priority": F.col("orders_order_priority"),
        "last_event_type": F.col("events_event_type"), "last_value_bucket": F.col("events_value_bucket"),
    }
    return pit_view(pit.read(spark), PIT_TEST_LAYOUT, columns, ("orders", "events"), keep_hk=True)


KEYED_DIM_SPEC = TableSpec(
    "dim_by_key",
    (ColumnSpec("dim_id", T.LongType()), ColumnSpec("customer_key", T.LongType()), ColumnSpec("name", T.StringType()),
     ColumnSpec("segment", T.StringType()), ColumnSpec("nation", T.StringType()), ColumnSpec("load_ts", T.TimestampType())),
)


def q_scd1_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension stored by key hash; changed and new rows are put over it."""
    dim, source, ctx = _dim_inputs(spark, sf)
    table_ = KeyedTable(KEYED_DIM_SPEC, scratch_table(spark, "dim"), ("customer_key",), 16)
    table_.upsert(dim)
    table_.upsert(scd1_delta(table_.read(spark), source, DIM_TEST_SPEC, ctx))
    return _dim_out(table_.read(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "snapshot_latest": q_snapshot_latest,
    "snapshot_empty_window": q_snapshot_empty_window,
    "hub_new_keys": q_hub_new_keys,
    "hub_merged": q_hub_merged,
    "hash_key_256": q_hash_key_256,
    "hash_diff_256": q_hash_diff_256,
    "hash_diff_compat": q_hash_diff_compat,
    "clean_attributes": q_clean_attributes,
    "split_phone": q_split_phone,
    "null_tokens_and": q_null_tokens_and,
    "null_tokens_or": q_null_tokens_or,
    "latest_per_key": q_latest_per_key,
    "satellite_new_ever_seen": q_satellite_new_ever_seen,
    "satellite_new_latest": q_satellite_new_latest,
    "general_stage": q_general_stage,
    "phone_stage": q_phone_stage,
    "email_stage": q_email_stage,
    "current_entity_view": q_current_entity_view,
    "scd1_changed": q_scd1_changed,
    "scd1_new": q_scd1_new,
    "scd1_delta": q_scd1_delta,
    "scd1_merged": q_scd1_merged,
    "unknown_member": q_unknown_member,
    "surrogate_keys": q_surrogate_keys,
    "max_surrogate_key": q_max_surrogate_key,
    "param_lookup": q_param_lookup,
    "pipeline_dimension": q_pipeline_dimension,
    "dimension_incremental": q_dimension_incremental,
    "dimension_pit": q_dimension_pit,
    "pit_view": q_pit_view,
    "pipeline_sat_phone": q_pipeline_sat_phone,
    "pipeline_sat_email": q_pipeline_sat_email,
    "hub_lineage": q_hub_lineage,
    "hub_ranged": q_hub_ranged,
    "hub_selective": q_hub_selective,
    "snapshot_by_folder": q_snapshot_by_folder,
    "snapshot_rejects": q_snapshot_rejects,
    "scd1_partitioned": q_scd1_partitioned,
}
