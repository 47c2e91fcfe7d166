from .changes import changed_rows, changed_rows_by_range, differing_ranges, pick_rows, range_digests
from .incremental import between_marks, high_water, run_audit, run_date, stamp_run
from .keyed import (
    keep_keys,
    key_list,
    latest_per_key,
    measured_bytes,
    membership_keys,
    sort_for_load,
    upsert,
)
from .keyfilter import KeyFilter, key_filter, rows_with_keys, rows_without_keys
from .quality import defaults, null_audit, null_rows, require
from .shape import conform, flatten_struct, project, union_all

__all__ = [
    "KeyFilter",
    "between_marks",
    "changed_rows",
    "changed_rows_by_range",
    "conform",
    "defaults",
    "differing_ranges",
    "flatten_struct",
    "high_water",
    "keep_keys",
    "key_filter",
    "key_list",
    "latest_per_key",
    "measured_bytes",
    "membership_keys",
    "null_audit",
    "null_rows",
    "pick_rows",
    "project",
    "range_digests",
    "require",
    "rows_with_keys",
    "rows_without_keys",
    "run_audit",
    "run_date",
    "sort_for_load",
    "stamp_run",
    "union_all",
    "upsert",
]
