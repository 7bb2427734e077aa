from .checks import (
    has_length,
    has_precision_and_scale,
    register_checks,
    register_python_check,
    register_sql_check,
    register_vector_check,
)
from .json_schema import infer_json_schema

__all__ = [
    "has_length",
    "has_precision_and_scale",
    "infer_json_schema",
    "register_checks",
    "register_python_check",
    "register_sql_check",
    "register_vector_check",
]
