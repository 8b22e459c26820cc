"""Gold of the customer entity from what changed since its last version.

Every load's new silver rows are tracked (``sources/changes.py``).  The
dimension is stored by key hash and remembers the last load it has seen; a run
takes the hash keys added since, builds the current view of only these
customers, compares it with only their dimension rows, and rewrites only the
partitions that these fall into.

Two ways to the view: ``changes`` reads the silver tables through a semi join
below the windows; ``pit`` reads a point-in-time table that every run brings
up to date, so no satellite history is read at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.functions.columns import default_if_blank
from lakevault.operators.context import LoadContext
from lakevault.operators.dimension import classify_once, delta_of, unknown_member
from lakevault.operators.pit import PitLayout, pit_rows, pit_view
from lakevault.plans import customer as cust
from lakevault.sources.changes import ChangeLog, TrackedTable
from lakevault.sources.keyed import KeyedTable
from lakevault.sources.tables import ColumnSpec, empty_frame, materialize

MODES = ("changes", "pit")
TRACKED = ("hub", "general", "phone")  # what the dimension is made of
DIM_PARTS, PIT_PARTS = 64, 64

_PAYLOAD = {s: tuple(c for c in spec.columns if c.name in names) for s, spec, names in (
    ("general", cust.GENERAL_SPEC, cust.GENERAL_ATTRS), ("phone", cust.PHONE_SPEC, (cust.PHONE_CODE, cust.PHONE_NUMBER)))}
PIT_LAYOUT = PitLayout(
    "Pit_Clientes", ColumnSpec(cust.HK, cust.BINARY), (ColumnSpec(cust.BK, cust.INT),), _PAYLOAD, cust.LOAD,
    ColumnSpec(cust.HD, cust.BINARY),
)


def dimension_table(paths: cust.LakePaths, parts: int = DIM_PARTS) -> KeyedTable:
    return KeyedTable(cust.DIM_SPEC_TABLE, f"{paths.dim.rstrip('/')}/keyed", (cust.DIM_BK,), parts)


def pit_table(paths: cust.LakePaths, parts: int = PIT_PARTS) -> KeyedTable:
    return KeyedTable(PIT_LAYOUT.spec, f"{paths.dim.rstrip('/')}/pit", (cust.HK,), parts)


def change_log(spark: SparkSession, paths: cust.LakePaths, silver: cust.SilverTables) -> ChangeLog:
    identity = {"hub": (cust.BK,), "general": (cust.HK, cust.HD, cust.LOAD), "phone": (cust.HK, cust.HD, cust.LOAD)}
    tables = tuple(
        TrackedTable(n, silver.layout[n][0], identity[n], lambda n=n: silver.read(n), lambda rows, n=n: silver.append(n, rows))
        for n in TRACKED
    )
    return ChangeLog(f"{paths.dim.rstrip('/')}/changes", tables)


def update_pit(spark: SparkSession, paths: cust.LakePaths, log: ChangeLog, upto: int) -> KeyedTable:
    """Bring the point-in-time table up to load ``upto``."""
    pit = pit_table(paths)
    after = int(pit.state(spark).get("upto", 0))
    if after < upto:
        keys = materialize(log.keys_since(spark, cust.HK, after, upto, TRACKED), "pit-keys")
        new = {s: log.since(spark, s, after, upto) for s in PIT_LAYOUT.satellites}
        rows = pit_rows(pit.rows_of(spark, keys), log.since(spark, "hub", after, upto), new, keys, PIT_LAYOUT)
        pit.upsert(rows, {"upto": upto})
    return pit


def current_of_pit(pit: DataFrame, phone_how: str = "inner") -> DataFrame:
    """The customers' current view as a projection of point-in-time rows."""
    code = F.col(f"phone_{cust.PHONE_CODE}")
    columns = {a: F.col(f"general_{a}") for a in cust.GENERAL_ATTRS}
    columns[cust.PHONE_CODE] = F.coalesce(default_if_blank(code, cust.CODE_NOT_AVAILABLE), F.lit(cust.CODE_NOT_AVAILABLE))
    return pit_view(pit, PIT_LAYOUT, columns, ("general", "phone") if phone_how == "inner" else ("general",))


def changed_view(
    spark: SparkSession, paths: cust.LakePaths, silver: cust.SilverTables, log: ChangeLog, keys: DataFrame, upto: int,
    gold: str, phone_how: str = "inner",
) -> DataFrame:
    """The current view of the customers in ``keys`` (a stored change set)."""
    if gold == "changes":
        return cust.current_view(silver.read("hub"), silver.read("general"), silver.read("phone"), phone_how, only=keys)
    if gold == "pit":
        return current_of_pit(update_pit(spark, paths, log, upto).rows_of(spark, keys), phone_how)
    raise ValueError(f"unknown gold mode {gold!r}; use 'full' or one of {MODES}")


def load_incremental(
    spark: SparkSession, silver: cust.SilverTables, paths: cust.LakePaths, ctx: LoadContext, new_rows: dict, gold: str,
    phone_how: str = "inner", view_name: str | None = None,
) -> dict:
    """Silver appends through the change log, then the dimension's changed rows.

    ``view_name`` is the dimension's name in the catalog, if it is to have one.
    """
    log = change_log(spark, paths, silver)
    upto = log.load(spark, {n: new_rows[n] for n in TRACKED}, cust.run_concurrently)
    out = update_dimension(spark, silver, paths, ctx, log, upto, gold, phone_how)
    if view_name:
        dimension_table(paths).register_view(spark, view_name)
    return out


def update_dimension(
    spark: SparkSession, silver: cust.SilverTables, paths: cust.LakePaths, ctx: LoadContext, log: ChangeLog, upto: int,
    gold: str, phone_how: str = "inner",
) -> dict:
    """Apply the loads that the dimension hasn't seen; returns its state and the partitions written."""
    dim = dimension_table(paths)
    state = dim.state(spark)
    after = int(state.get("upto", 0))
    facts = {"upto": upto}
    keys = materialize(log.keys_since(spark, cust.HK, after, upto, TRACKED), "gold-keys")
    view = materialize(changed_view(spark, paths, silver, log, keys, upto, gold, phone_how), "gold-view")
    stored = dim.rows_of(spark, view.select(F.col(cust.BK).alias(cust.DIM_BK)))
    found = classify_once(stored, view, cust.DIM_SPEC, differences_only=True)
    rows = delta_of(found, cust.DIM_SPEC, ctx, start_after=int(state.get(cust.DIM_ID, 0)))
    if not state:  # the first version brings the unknown member
        rows = rows.unionByName(unknown_member(spark, empty_frame(spark, cust.DIM_SPEC_TABLE), cust.DIM_SPEC, ctx))
        facts[cust.DIM_ID] = 0
    if state and not found.differs:
        dim.upsert(empty_frame(spark, cust.DIM_SPEC_TABLE), facts)
        written: list[int] = []
    else:
        written = dim.upsert(rows, facts, greatest=cust.DIM_ID)
    return {"dim_upto": upto, "dim_parts_written": written}
