from .controls import (
    control_of_counts,
    file_counts,
    file_reconciliation,
    loaded_vs_rejected,
    reconciliation_of_labelled,
)
from .eventlog import (
    append_new_events,
    detail,
    exploded_detail,
    json_dataset,
    parse_details,
    rule_metric_rows,
    rule_metrics_to_events,
    variant_details,
    variant_rule_metrics,
)
from .expectations import (
    alerts,
    expect_drop,
    expect_fail,
    expect_keep,
    failed_rules,
    label,
    passes,
    quarantine,
    rule_metrics,
    rule_metrics_by,
    rules_hold,
)
from .transforms import (
    malformed,
    strip_provenance,
    union_all,
    where_sql,
    with_entity,
    with_ingestion,
    with_provenance,
)

__all__ = [
    "alerts",
    "append_new_events",
    "control_of_counts",
    "detail",
    "expect_drop",
    "expect_fail",
    "expect_keep",
    "exploded_detail",
    "failed_rules",
    "file_counts",
    "file_reconciliation",
    "json_dataset",
    "label",
    "loaded_vs_rejected",
    "malformed",
    "parse_details",
    "passes",
    "quarantine",
    "reconciliation_of_labelled",
    "rule_metric_rows",
    "rule_metrics",
    "rule_metrics_by",
    "rule_metrics_to_events",
    "rules_hold",
    "strip_provenance",
    "union_all",
    "variant_details",
    "variant_rule_metrics",
    "where_sql",
    "with_entity",
    "with_ingestion",
    "with_provenance",
]
