from .runs import (
    AUDIT_SCHEMA,
    MARKED_AUDIT_SCHEMA,
    export_run,
    last_mark,
    merge_partitions,
    read_partitions,
    read_runs,
    record_run,
    replace_run,
    write_partitions,
    write_run,
)
from .scratch import scratch_path, stage
from .tables import read_table, session_options, write_table
from .tree import read_tree, write_tree

__all__ = [
    "AUDIT_SCHEMA",
    "MARKED_AUDIT_SCHEMA",
    "export_run",
    "last_mark",
    "merge_partitions",
    "read_partitions",
    "read_runs",
    "read_table",
    "read_tree",
    "record_run",
    "replace_run",
    "scratch_path",
    "session_options",
    "stage",
    "write_partitions",
    "write_run",
    "write_table",
    "write_tree",
]
