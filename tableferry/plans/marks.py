"""High-water marks of earlier exports: where the next run starts.

A run's write observes its newest time (``newest_audit``, ``newest_machines``)
and commits it with the run, and ``sources.last_mark`` reads it there. The marks
over exported rows are for exports that were not written that way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import MS_FORMAT
from ..operators.incremental import high_water
from .machines import ACTIVITY_TIMES


def audit_mark(exported: DataFrame) -> DataFrame:
    """Newest event time of exported audit events, which hold it as text."""
    return high_water(exported, "event_time", MS_FORMAT)


def machine_mark(exported: DataFrame) -> DataFrame:
    """Newest activity over all exported machines."""
    return high_water(exported, ACTIVITY_TIMES)


def mark_value(mark: DataFrame):
    """The mark as epoch milliseconds, or None: a single row by construction."""
    return mark.first()["max_time_ms"]


def newest_audit() -> Column:
    """For the write of an audit export: the newest event time, in epoch milliseconds."""
    time = F.try_to_timestamp(F.col("event_time"), F.lit(MS_FORMAT))
    return F.unix_millis(F.max(time).cast("timestamp"))


def newest_machines() -> Column:
    """For the write of a machine export: the newest of all activity times, in epoch milliseconds.

    A missing time counts as the epoch, as it does in the window: a run of rows
    without any leaves that as its mark, and they are not exported again.
    """
    times = [F.coalesce(F.unix_millis(F.col(c).cast("timestamp")), F.lit(0)) for c in ACTIVITY_TIMES]
    return F.max(F.greatest(*times))
