from .contracts import Contract, load_contract, save_contract
from .rules import (
    Rules,
    publish_rules,
    rules_from_constraints,
    rules_from_control_table,
    rules_from_csv,
    validate_rules,
)

__all__ = [
    "Contract",
    "Rules",
    "load_contract",
    "publish_rules",
    "rules_from_constraints",
    "rules_from_control_table",
    "rules_from_csv",
    "save_contract",
    "validate_rules",
]
