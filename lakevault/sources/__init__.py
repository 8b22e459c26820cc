from lakevault.sources.params import AmbiguousParameterError, MissingParameterError, load_params
from lakevault.sources.snapshots import (
    RunWindow,
    latest_snapshot,
    read_snapshots,
    run_window,
    snapshot_date_from_parts,
    with_snapshot_date,
)
from lakevault.sources.tables import (
    Bucketing,
    ColumnSpec,
    TableSpec,
    append_bucketed,
    append_rows,
    conform,
    current_version,
    empty_frame,
    ensure_bucketed_table,
    ensure_table,
    materialize,
    merge_insert_only,
    merge_upsert,
    read_bucketed,
    read_state,
    read_table,
    write_state,
)

__all__ = [
    "Bucketing",
    "ColumnSpec",
    "MissingParameterError",
    "RunWindow",
    "TableSpec",
    "append_bucketed",
    "append_rows",
    "conform",
    "current_version",
    "empty_frame",
    "ensure_bucketed_table",
    "ensure_table",
    "latest_snapshot",
    "load_params",
    "materialize",
    "merge_insert_only",
    "merge_upsert",
    "AmbiguousParameterError",
    "read_bucketed",
    "read_snapshots",
    "read_state",
    "read_table",
    "run_window",
    "snapshot_date_from_parts",
    "with_snapshot_date",
    "write_state",
]
