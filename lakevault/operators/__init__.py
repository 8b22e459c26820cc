from lakevault.operators.context import LoadContext
from lakevault.operators.dimension import (
    DimensionSpec,
    ensure_unknown_member,
    max_surrogate_key,
    max_surrogate_value,
    scd1_changed,
    scd1_classify,
    scd1_delta,
    scd1_merge,
    scd1_new,
    unknown_member,
)
from lakevault.operators.entity import SatelliteView, current_entity_view
from lakevault.operators.hub import hub_new_rows, insert_only_merge
from lakevault.operators.latest import latest_per_key
from lakevault.operators.satellite import satellite_history_keys, satellite_new_rows, satellite_stage
from lakevault.operators.surrogate import assign_surrogate_keys

__all__ = [
    "DimensionSpec",
    "LoadContext",
    "SatelliteView",
    "assign_surrogate_keys",
    "current_entity_view",
    "ensure_unknown_member",
    "hub_new_rows",
    "insert_only_merge",
    "latest_per_key",
    "max_surrogate_key",
    "max_surrogate_value",
    "satellite_history_keys",
    "satellite_new_rows",
    "satellite_stage",
    "scd1_changed",
    "scd1_classify",
    "scd1_delta",
    "scd1_merge",
    "scd1_new",
    "unknown_member",
]
