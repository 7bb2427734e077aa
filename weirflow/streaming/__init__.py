from .counts import CountTable, Judged, count_deltas
from .flows import (
    EntityFlow,
    FlowResult,
    LandingSource,
    entity_flow_from_config,
    log_events,
    run_entity_flow,
    run_union_flow,
    source_settings,
    union_sources_from_config,
)
from .tables import CheckedStream, StreamResult, StreamTables, settle

__all__ = [
    "CheckedStream",
    "CountTable",
    "EntityFlow",
    "FlowResult",
    "Judged",
    "LandingSource",
    "StreamResult",
    "StreamTables",
    "count_deltas",
    "entity_flow_from_config",
    "log_events",
    "run_entity_flow",
    "run_union_flow",
    "settle",
    "source_settings",
    "union_sources_from_config",
]
