"""The customer entity: bronze snapshot -> hub + 3 satellites -> Type-1 dimension.

The generic operators parameterised for the customer tables.  Names and
defaults are the ones of the existing lake so the tables stay drop-in
compatible with data loaded before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.functions.columns import (
    clean_positive_int,
    clean_text,
    default_if_blank,
    default_if_null,
    drop_null_tokens,
    split_phone,
)
from lakevault.operators.context import LoadContext
from lakevault.operators.dimension import (
    Classified,
    DimensionSpec,
    classify_once,
    ensure_unknown_member,
    scd1_merge,
)
from lakevault.operators.entity import SatelliteView, current_entity_view
from lakevault.operators.hub import hub_new_rows
from lakevault.operators.satellite import satellite_new_rows, satellite_stage
from lakevault.sources.params import load_params
from lakevault.sources.snapshots import (
    SOURCE_FILE,
    latest_snapshot,
    newest_folder,
    read_snapshots,
    run_window,
    snapshot_date_from_parts,
    store_rejects,
    with_source_file,
)
from lakevault.sources.tables import (
    OPTIMIZE_WRITE,
    Bucketing,
    ColumnSpec,
    TableSpec,
    append_bucketed,
    append_rows,
    ensure_bucketed_table,
    ensure_table,
    read_bucketed,
    read_state,
    read_table,
    register_current,
    scratch_scope,
    scratch_table,
    write_state,
)

# ---------------------------------------------------------------------------
# Table names, column names, defaults and tokens of the
# existing customer lake.  They must stay exactly as written for the tables
# to remain compatible.
HUB_TABLE = "Hub_Clientes"
SAT_GENERAL_TABLE = "Sat_Clientes_General"
SAT_PHONE_TABLE = "Sat_Clientes_Telefonos"
SAT_EMAIL_TABLE = "Sat_Clientes_CorreosElectronicos"
DIM_TABLE = "Dim_Cliente"
HK = "Hk_Clientes"
BK = "Bk_IdCliente"
HD = "Hk_Diff"
LOAD = "FechaRegistro"
SOURCE = "FuenteDatos"
GENERAL_ATTRS = (
    "Nombre",
    "Apellido",
    "CalleUbicacion",
    "CiudadUbicacion",
    "CodigoEstadoUbicacion",
    "CodigoPostalUbicacion",
)
PHONE_CODE = "CodigoPais"
PHONE_NUMBER = "NumeroTelefono"
EMAIL = "CorreoElectronico"
DIM_ID = "DimClienteId"
DIM_BK = "LlaveNegocioIdCliente"
DIM_PHONE_CODE = "CodigoPaisTelefono"
NOT_RECORDED = "No Registra"
STATE_NOT_RECORDED = "N/R"
NOT_DEFINED = "No Definido"
CODE_NOT_AVAILABLE = "(N/D)"
NULL_TOKEN = "NULL"
MISSING_NUMBER = -1
PARAM_KEY_COL = "Clave"
PARAM_VALUE_COL = "Valor"
# Stored tables hash their fields without a separator; another one would make every stored row look new.
STORED_SEPARATOR = ""
# The columns of the daily extract that the loads read.
EXTRACT_COLUMNS = ("customer_id", "first_name", "last_name", "street", "city", "state", "zip_code", "phone", "email")
PARAM_PROCESS_DATE = "FechaProceso"
PARAM_LOOKBACK_DAYS = "DiasCargarBorrar"
PARAM_LAKE = "LagoDatos"
PARAM_BRONZE = "MedallaBronce"
PARAM_SCHEMA = "ContenedorLagoDatosReg"
PARAM_VAULT_CATALOG = "DatabricksCatalogoDataVault"
PARAM_DWH_CATALOG = "DatabricksCatalogoDwh"
# ---------------------------------------------------------------------------

BINARY, INT, STRING, TS = T.BinaryType(), T.IntegerType(), T.StringType(), T.TimestampType()

TABLE_PROPERTIES = {OPTIMIZE_WRITE: "true"}
# The declared schema of the extract; partition columns are added by the reader.
BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, INT if c in ("customer_id", "zip_code") else STRING) for c in EXTRACT_COLUMNS]
)

HUB_SPEC = TableSpec(
    HUB_TABLE,
    (
        ColumnSpec(HK, BINARY, comment="hash of the business key"),
        ColumnSpec(BK, INT, comment="customer business key"),
        ColumnSpec(LOAD, TS, comment="load time"),
        ColumnSpec(SOURCE, STRING, comment="bronze source"),
    ),
    comment="customer hub: every business key once",
    cluster_by=(BK,),
    properties=TABLE_PROPERTIES,
    bloom=(BK,),
)
GENERAL_SPEC = TableSpec(
    SAT_GENERAL_TABLE,
    (
        ColumnSpec(HK, BINARY),
        ColumnSpec(LOAD, TS),
        ColumnSpec(HD, BINARY, comment="change hash"),
        *[ColumnSpec(a, INT if a == "CodigoPostalUbicacion" else STRING) for a in GENERAL_ATTRS],
        ColumnSpec(SOURCE, STRING),
    ),
    comment="customer satellite: name and address",
    cluster_by=(LOAD,),
    properties=TABLE_PROPERTIES,
)
PHONE_SPEC = TableSpec(
    SAT_PHONE_TABLE,
    (
        ColumnSpec(HK, BINARY),
        ColumnSpec(LOAD, TS),
        ColumnSpec(HD, BINARY),
        ColumnSpec(PHONE_CODE, STRING),
        ColumnSpec(PHONE_NUMBER, INT),
        ColumnSpec(SOURCE, STRING),
    ),
    comment="customer satellite: phone",
    cluster_by=(LOAD,),
    properties=TABLE_PROPERTIES,
)
EMAIL_SPEC = TableSpec(
    SAT_EMAIL_TABLE,
    (
        ColumnSpec(HK, BINARY),
        ColumnSpec(LOAD, TS),
        ColumnSpec(HD, BINARY),
        ColumnSpec(EMAIL, STRING),
        ColumnSpec(SOURCE, STRING),
    ),
    comment="customer satellite: e-mail",
    cluster_by=(LOAD,),
    properties=TABLE_PROPERTIES,
)
DIM_SPEC_TABLE = TableSpec(
    DIM_TABLE,
    (
        ColumnSpec(DIM_ID, INT, comment="surrogate key, -1 = unknown"),
        ColumnSpec(DIM_BK, INT),
        *[ColumnSpec(a, INT if a == "CodigoPostalUbicacion" else STRING) for a in GENERAL_ATTRS],
        ColumnSpec(DIM_PHONE_CODE, STRING),
        ColumnSpec(LOAD, TS),
    ),
    comment="customer dimension, Type 1",
    cluster_by=(DIM_ID,),
    properties=TABLE_PROPERTIES,
)
DIM_SPEC = DimensionSpec(
    id_col=DIM_ID,
    bk_cols=(DIM_BK,),
    source_bk_cols=(BK,),
    attrs={**{a: a for a in GENERAL_ATTRS}, DIM_PHONE_CODE: PHONE_CODE},
    load_col=LOAD,
    unknown={
        DIM_BK: -1,
        "Nombre": NOT_DEFINED,
        "Apellido": NOT_DEFINED,
        "CalleUbicacion": NOT_DEFINED,
        "CiudadUbicacion": NOT_DEFINED,
        "CodigoEstadoUbicacion": CODE_NOT_AVAILABLE,
        "CodigoPostalUbicacion": -1,
        DIM_PHONE_CODE: CODE_NOT_AVAILABLE,
    },
)


def _lineage(snapshot: DataFrame) -> str | None:
    """The column with each row's file, if the snapshot has one."""
    return SOURCE_FILE if SOURCE_FILE in snapshot.columns else None


def hub_rows(snapshot: DataFrame, hub: DataFrame, ctx: LoadContext, selective: bool = False) -> DataFrame:
    """New hub rows: non-null ``customer_id`` values not in the hub yet."""
    return hub_new_rows(
        snapshot, hub, {BK: F.col("customer_id")}, ctx, hk_col=HK, load_col=LOAD, source_col=SOURCE, lineage=_lineage(snapshot),
        selective=selective,
    )


def general_stage(snapshot: DataFrame, sep: str = STORED_SEPARATOR, diff_bits: int = 512) -> DataFrame:
    payload = {
        "Nombre": clean_text("first_name", NOT_RECORDED),
        "Apellido": clean_text("last_name", NOT_RECORDED),
        "CalleUbicacion": clean_text("street", NOT_RECORDED),
        "CiudadUbicacion": clean_text("city", NOT_RECORDED),
        "CodigoEstadoUbicacion": clean_text("state", STATE_NOT_RECORDED),
        "CodigoPostalUbicacion": clean_positive_int("zip_code", -1),
    }
    return satellite_stage(
        snapshot, "customer_id", payload, null_key="drop", hk_col=HK, hd_col=HD, sep=sep, diff_bits=diff_bits,
        lineage=_lineage(snapshot),
    )


def general_rows(
    snapshot: DataFrame, sat: DataFrame, ctx: LoadContext, mode: str = "ever_seen", sep: str = STORED_SEPARATOR
) -> DataFrame:
    """New name/address states.  Compared with every stored state by default
    (a return to an earlier state is not stored again)."""
    return satellite_new_rows(
        general_stage(snapshot, sep), sat, ctx, mode, hk_col=HK, hd_col=HD, load_col=LOAD, source_col=SOURCE
    )


def phone_stage(snapshot: DataFrame, sep: str = STORED_SEPARATOR, diff_bits: int = 512) -> DataFrame:
    area, rest, number = split_phone("phone")
    return satellite_stage(
        snapshot,
        "customer_id",
        {PHONE_CODE: area, PHONE_NUMBER: number},
        diff_cols=[area, rest],  # the raw digits text, not the parsed number
        row_filter=drop_null_tokens("phone", (NULL_TOKEN,)),
        null_key=MISSING_NUMBER,
        hk_col=HK,
        hd_col=HD,
        sep=sep,
        diff_bits=diff_bits,
        lineage=_lineage(snapshot),
    )


def phone_rows(
    snapshot: DataFrame, sat: DataFrame, ctx: LoadContext, mode: str = "ever_seen", sep: str = STORED_SEPARATOR
) -> DataFrame:
    """New phone states; load time truncated to the day."""
    return satellite_new_rows(
        phone_stage(snapshot, sep), sat, ctx, mode, hk_col=HK, hd_col=HD, load_col=LOAD, source_col=SOURCE,
        granularity="day",
    )


def email_stage(snapshot: DataFrame, sep: str = STORED_SEPARATOR, diff_bits: int = 512) -> DataFrame:
    email = default_if_null("email", NOT_DEFINED)
    return satellite_stage(
        snapshot,
        "customer_id",
        {EMAIL: email},
        row_filter=drop_null_tokens("email", ()),  # the text 'NULL' is kept
        null_key=MISSING_NUMBER,
        hk_col=HK,
        hd_col=HD,
        sep=sep,
        diff_bits=diff_bits,
        lineage=_lineage(snapshot),
    )


def email_rows(
    snapshot: DataFrame, sat: DataFrame, ctx: LoadContext, mode: str = "ever_seen", sep: str = STORED_SEPARATOR
) -> DataFrame:
    return satellite_new_rows(
        email_stage(snapshot, sep), sat, ctx, mode, hk_col=HK, hd_col=HD, load_col=LOAD, source_col=SOURCE,
        granularity="day",
    )


def current_view(
    hub: DataFrame, general: DataFrame, phone: DataFrame, phone_how: str = "inner", only: DataFrame | None = None
) -> DataFrame:
    """Hub with the newest name/address and phone rows (e-mail unused), of the hash keys in ``only`` if given."""
    view = current_entity_view(
        hub,
        [
            SatelliteView(general, {a: a for a in GENERAL_ATTRS}),
            SatelliteView(
                phone,
                {PHONE_CODE: F.coalesce(default_if_blank(PHONE_CODE, CODE_NOT_AVAILABLE), F.lit(CODE_NOT_AVAILABLE))},
                how=phone_how,
            ),
        ],
        bk_cols=[BK],
        hk_col=HK,
        load_col=LOAD,
        hd_col=HD,
        only=only,
    )
    # a customer without a phone row (phone_how="left") has no code either
    return view.withColumn(PHONE_CODE, F.coalesce(PHONE_CODE, F.lit(CODE_NOT_AVAILABLE)))


def dimension_state(dim: DataFrame, view: DataFrame, ctx: LoadContext, classified: Classified | None = None) -> DataFrame:
    """New full dimension state: unknown member ensured, Type-1 upsert."""
    with_unknown = ensure_unknown_member(dim, DIM_SPEC, ctx)
    # max id and new-key count come from the classification in one job
    return scd1_merge(with_unknown, view, DIM_SPEC, ctx, classified=classified)


# --- concurrent jobs ----------------------------------------------------------------


def run_concurrently(jobs: dict) -> dict:
    """Run independent Spark actions from driver threads (the scheduler
    interleaves their tasks); re-raises the first failure."""
    from concurrent.futures import ThreadPoolExecutor
    from contextvars import copy_context

    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {name: pool.submit(copy_context().run, fn) for name, fn in jobs.items()}
        return {name: fut.result() for name, fut in futures.items()}


# --- storage-backed run ---------------------------------------------------------------


@dataclass(frozen=True)
class LakePaths:
    bronze: str
    hub: str
    general: str
    phone: str
    email: str
    dim: str


def paths_from_params(
    params: DataFrame, bronze: str = "{LagoDatos}/{MedallaBronce}/customers", silver: str = "{LagoDatos}/{DatabricksCatalogoDataVault}",
    gold: str = "{LagoDatos}/{DatabricksCatalogoDwh}",
) -> tuple[LakePaths, dict[str, str]]:
    """Folders and names of a lake, all from the parameter table (one job).

    The templates name parameters in braces.  Also returns the parameters, among them the
    schema in which the tables are registered.
    """
    keys = [PARAM_PROCESS_DATE, PARAM_LOOKBACK_DAYS, PARAM_LAKE, PARAM_BRONZE, PARAM_SCHEMA, PARAM_VAULT_CATALOG, PARAM_DWH_CATALOG]
    found = load_params(params, keys, PARAM_KEY_COL, PARAM_VALUE_COL)
    silver, gold = silver.format(**found), gold.format(**found)
    tables = [f"{silver}/{t}" for t in (HUB_TABLE, SAT_GENERAL_TABLE, SAT_PHONE_TABLE, SAT_EMAIL_TABLE)]
    return LakePaths(bronze.format(**found), *tables, f"{gold}/{DIM_TABLE}"), found


def run_from_params(spark: SparkSession, params: DataFrame, load_ts: str, templates: dict | None = None, **options) -> dict:
    """One load whose date, window, folders, schema and record source all come from the parameter table.

    The tables are registered in the schema that the parameters name; the
    session's current schema is that one during the load, and the former one afterwards.
    """
    paths, found = paths_from_params(params, **(templates or {}))
    before = spark.catalog.currentDatabase()
    spark.sql("USE IDENTIFIER(:name)", args={"name": found[PARAM_SCHEMA]})
    try:
        return run_customer_load(
            spark, paths, load_ts, paths.bronze, found[PARAM_PROCESS_DATE], int(found[PARAM_LOOKBACK_DAYS]),
            register_tables=True, **options,
        )
    finally:
        spark.sql("USE IDENTIFIER(:name)", args={"name": before})


class SilverTables:
    """Reads and appends of the four silver tables, plain or bucketed.

    With ``buckets`` the tables are catalog tables (``table_prefix`` + name)
    bucketed by the keys their loads join on -- the hub by business key, the
    satellites by (hk, hd) -- so a daily load shuffles only its own rows.
    The dimension's versions are then bucketed by business key as well, so
    the Type-1 full outer join does not shuffle the stored dimension.
    """

    def __init__(
        self,
        spark: SparkSession,
        paths: LakePaths,
        buckets: int | None,
        table_prefix: str = "",
        register: bool = False,
    ):
        self.spark = spark
        self.layout = {
            "hub": (HUB_SPEC, paths.hub, (BK,)),
            "general": (GENERAL_SPEC, paths.general, (HK, HD)),
            "phone": (PHONE_SPEC, paths.phone, (HK, HD)),
            "email": (EMAIL_SPEC, paths.email, (HK, HD)),
        }
        self.bucketing: dict[str, Bucketing] = {}
        if register and not buckets:
            for spec, path, _ in self.layout.values():
                ensure_table(spark, spec, path, f"{table_prefix}{spec.name}")
        if buckets:
            for name, (spec, path, cols) in self.layout.items():
                b = Bucketing(f"{table_prefix}{spec.name}", cols, buckets)
                ensure_bucketed_table(spark, spec, path, b)
                self.bucketing[name] = b

    def read(self, name: str) -> DataFrame:
        spec, path, _ = self.layout[name]
        if name in self.bucketing:
            return read_bucketed(self.spark, self.bucketing[name])
        return read_table(self.spark, spec, path)

    def append(self, name: str, rows: DataFrame) -> None:
        spec, path, _ = self.layout[name]
        if name in self.bucketing:
            append_bucketed(rows, spec, self.bucketing[name])
        else:
            append_rows(rows, spec, path)


def replay_runs(
    spark: SparkSession,
    bronze: DataFrame,
    runs,
    lookback_days: int,
    record_source: str,
    sep: str = STORED_SEPARATOR,
    gold: str = "full",
) -> DataFrame:
    """The final dimension after ``replay_lake``."""
    return read_dimension(spark, replay_lake(spark, bronze, runs, lookback_days, record_source, sep, gold), gold)


def replay_lake(
    spark: SparkSession,
    bronze: DataFrame,
    runs,
    lookback_days: int,
    record_source: str,
    sep: str = STORED_SEPARATOR,
    gold: str = "full",
) -> LakePaths:
    """Replay daily runs ``[(process_date, load_ts), ...]`` over a bronze
    DataFrame with the production loads (appends + dimension versions) into a
    fresh folder under the session's checkpoint directory.  Each run reads the
    previous runs' stored tables, so no plan ever replays earlier days."""
    base = scratch_table(spark, "replay")
    paths = LakePaths(f"{base}/bronze", *[f"{base}/{n}" for n in ("hub", "general", "phone", "email", "dim")])
    for process_date, load_ts in runs:
        snapshot, chosen = latest_snapshot(bronze, run_window(process_date, lookback_days))
        if chosen is not None:
            load_snapshot(spark, snapshot, paths, LoadContext(load_ts, record_source), sep=sep, gold=gold)
    return paths


def read_dimension(spark: SparkSession, paths: LakePaths, gold: str = "full") -> DataFrame:
    """The dimension's current rows, as the loads with that ``gold`` mode store it."""
    if gold == "full":
        return read_state(spark, DIM_SPEC_TABLE, paths.dim)[0]
    from lakevault.plans.incremental import dimension_table

    return dimension_table(paths).read(spark)


def run_customer_load(
    spark: SparkSession,
    paths: LakePaths,
    load_ts: str,
    record_source: str,
    process_date: str | None = None,
    lookback_days: int | None = None,
    params: DataFrame | None = None,
    sep: str = STORED_SEPARATOR,
    buckets: int | None = None,
    table_prefix: str = "",
    register_tables: bool = False,
    mode: str = "ever_seen",
    phone_how: str = "inner",
    gold: str = "full",
    selective: bool = False,
    bronze_schema: T.StructType | None = None,
    lineage: bool = False,
    rejects: str | None = None,
) -> dict:
    """Bronze -> silver -> gold for one process date.

    Parameters come either directly or from a key/value table (one job for
    all keys).  Each silver load appends only new rows; the dimension is
    written as a new version.  Gold reads the silver tables back from
    storage, which cuts the lineage between the layers.

    With ``bronze_schema`` (``BRONZE_SCHEMA``, say) the snapshot is chosen by
    folder names and no other day's file is opened.  ``lineage`` stores each
    row's file as its record source.  ``rejects`` is a folder for the rows of
    bronze whose date parts give no date; their number is in the summary.
    """
    if params is not None:
        found = load_params(params, [PARAM_PROCESS_DATE, PARAM_LOOKBACK_DAYS], PARAM_KEY_COL, PARAM_VALUE_COL)
        process_date = process_date or found[PARAM_PROCESS_DATE]
        lookback_days = lookback_days if lookback_days is not None else int(found[PARAM_LOOKBACK_DAYS])
    if process_date is None or lookback_days is None:
        raise ValueError("process_date and lookback_days are required (directly or via params)")
    ctx = LoadContext(load_ts, record_source)
    window = run_window(process_date, lookback_days)
    summary: dict = {}
    if rejects is not None:
        summary["rejected_rows"] = store_rejects(read_snapshots(spark, paths.bronze), rejects, ctx.load_ts_col())
    if bronze_schema is not None:
        snapshot, chosen = newest_folder(spark, paths.bronze, bronze_schema, window)
    else:
        snapshot, chosen = latest_snapshot(read_snapshots(spark, paths.bronze), window, snapshot_date_from_parts())
    summary["snapshot_date"] = chosen
    if chosen is None:
        return summary  # nothing in the window: every load is a no-op
    if lineage:
        snapshot = with_source_file(snapshot)

    summary.update(
        load_snapshot(
            spark, snapshot, paths, ctx, sep=sep, buckets=buckets, table_prefix=table_prefix,
            register_tables=register_tables, mode=mode, phone_how=phone_how, gold=gold, selective=selective,
        )
    )
    return summary


def load_snapshot(
    spark: SparkSession,
    snapshot: DataFrame,
    paths: LakePaths,
    ctx: LoadContext,
    sep: str = STORED_SEPARATOR,
    buckets: int | None = None,
    table_prefix: str = "",
    register_tables: bool = False,
    mode: str = "ever_seen",
    phone_how: str = "inner",
    gold: str = "full",
    selective: bool = False,
) -> dict:
    """All five loads for one chosen snapshot (silver appends, gold version).

    Idempotent: re-running it for the same snapshot appends nothing to the
    hub and satellites and writes no dimension version, so a retried batch
    (e.g. a re-executed streaming micro-batch) is safe.  ``mode`` is the
    satellites' comparison, ``phone_how`` the dimension's join with phones.
    ``gold`` is ``full`` (the whole dimension, a new version), ``changes`` or
    ``pit`` (only customers with new rows, see ``plans/incremental.py``); a
    lake stays with the mode it began with.  ``selective`` probes the hub for
    the extract's keys only: for extracts that hold few customers.
    """
    with scratch_scope(spark):
        return _load_snapshot(
            spark, snapshot, paths, ctx, sep, buckets, table_prefix, register_tables, mode, phone_how, gold, selective)


def _load_snapshot(
    spark: SparkSession, snapshot: DataFrame, paths: LakePaths, ctx: LoadContext, sep: str, buckets: int | None,
    table_prefix: str, register_tables: bool, mode: str, phone_how: str, gold: str, selective: bool,
) -> dict:
    silver = SilverTables(spark, paths, buckets, table_prefix, register_tables)
    # one day's extract feeds four loads: keep it instead of re-reading it
    snapshot = snapshot.select(*EXTRACT_COLUMNS, *filter(None, [_lineage(snapshot)])).persist(StorageLevel.MEMORY_AND_DISK)
    new_rows = {
        "hub": lambda: hub_rows(snapshot, silver.read("hub"), ctx, selective),
        "general": lambda: general_rows(snapshot, silver.read("general"), ctx, mode, sep),
        "phone": lambda: phone_rows(snapshot, silver.read("phone"), ctx, mode, sep),
        "email": lambda: email_rows(snapshot, silver.read("email"), ctx, mode, sep),
    }
    try:
        if gold != "full":
            from lakevault.plans.incremental import load_incremental

            run_concurrently({"email": lambda: silver.append("email", new_rows["email"]())})
            view_name = f"{table_prefix}{DIM_TABLE}" if register_tables else None
            return load_incremental(spark, silver, paths, ctx, new_rows, gold, phone_how, view_name)
        # the four silver loads are independent jobs: submit them together
        run_concurrently({name: (lambda name=name: silver.append(name, new_rows[name]())) for name in new_rows})
    finally:
        snapshot.unpersist()

    view = current_view(silver.read("hub"), silver.read("general"), silver.read("phone"), phone_how)
    dim_bucketing = Bucketing(f"{table_prefix}{DIM_TABLE}", (DIM_BK,), buckets) if buckets else None
    dim, version = read_state(spark, DIM_SPEC_TABLE, paths.dim, dim_bucketing)
    with_unknown = ensure_unknown_member(dim, DIM_SPEC, ctx)
    classified = classify_once(with_unknown, view, DIM_SPEC)
    if version is None or classified.differs:  # else there is nothing to write
        state = dimension_state(dim, view, ctx, classified=classified)
        version = write_state(state, DIM_SPEC_TABLE, paths.dim, version, dim_bucketing)
    if register_tables:
        register_current(spark, DIM_SPEC_TABLE, paths.dim, version, f"{table_prefix}{DIM_TABLE}")
    return {"dim_version": version}
