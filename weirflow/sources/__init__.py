from .catalog import (
    create_control_table,
    create_database,
    publish_stream_table,
    register_external,
    replace_control_rows,
    save_table,
)
from .complete import CompleteTable
from .files import read_csv_strings, read_json, read_landing, read_merged
from .writers import append_json, append_merge, append_once, read_complete, write_complete, write_landing

__all__ = [
    "CompleteTable",
    "append_json",
    "append_merge",
    "append_once",
    "create_control_table",
    "create_database",
    "publish_stream_table",
    "read_complete",
    "read_csv_strings",
    "read_json",
    "read_landing",
    "read_merged",
    "register_external",
    "replace_control_rows",
    "save_table",
    "write_complete",
    "write_landing",
]
