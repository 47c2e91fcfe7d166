"""Export of audit events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ..functions.timecols import format_ms
from ..operators.incremental import SETTLING_DELAY, between_marks, stamp_run
from ..operators.shape import project

# Output, source, and the value a null becomes.
AUDIT_COLUMNS = [
    ("suid", "suid"),
    ("event_time", "event_time"),
    ("event_type", "eventtype", ""),
    ("gid", "cartid", ""),
    ("gtoken", "gtoken", ""),
    ("city", "city", 0),
    ("state", "region", 0),
    ("country", "country", 0),
    ("notifiedleid", "activeleid", ""),
    ("notifurl", "notifurl", ""),
    ("notifauditid", "notif_audit_id", ""),
]


def audit_events(
    events: DataFrame,
    insert_date: str | dt.date,
    run_sequence: str | int = "1",
    low=None,
    as_of=None,
    lag: str = SETTLING_DELAY,
) -> DataFrame:
    """Audit events in export shape; with ``as_of`` given, only those between mark and cut-off.

    The window is tested on the source's timestamp, before it becomes text, so
    the scan can use it.
    """
    if as_of is not None:
        events = between_marks(events, "eventtime", low, as_of, lag)
    elif low is not None:
        raise ValueError("a low mark needs as_of")
    shaped = project(events.withColumn("event_time", format_ms("eventtime")), AUDIT_COLUMNS)
    return stamp_run(shaped, insert_date, run_sequence)
