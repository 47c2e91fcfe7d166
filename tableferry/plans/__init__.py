from .audit import audit_events
from .cohorts import cohort_changes, cohort_rows, disabled_cohorts
from .machines import machine_snapshot
from .marks import audit_mark, machine_mark, mark_value, newest_audit, newest_machines
from .series import current_values, daily_series, hourly_series, raw_series, readings_audit, staged_series

__all__ = [
    "audit_events",
    "audit_mark",
    "cohort_changes",
    "cohort_rows",
    "current_values",
    "daily_series",
    "disabled_cohorts",
    "hourly_series",
    "machine_mark",
    "machine_snapshot",
    "mark_value",
    "newest_audit",
    "newest_machines",
    "raw_series",
    "readings_audit",
    "staged_series",
]
