"""Time columns: buckets and text forms.

Year and month buckets follow the session time zone while the epoch day is a
UTC day, so run with ``spark.sql.session.timeZone=UTC`` to keep them in step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

# Text form of event times and the bucket width of a day.
MS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
SECONDS_PER_DAY = 86400


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_month(c: Column | str) -> Column:
    """``yyyymm`` text with a zero-padded month; null in, null out."""
    c = _col(c)
    return F.concat(F.year(c).cast("string"), F.lpad(F.month(c).cast("string"), 2, "0"))


def epoch_day(c: Column | str) -> Column:
    """Whole days since 1970-01-01 as bigint."""
    return F.floor(F.unix_timestamp(_col(c)) / SECONDS_PER_DAY)


def year_of(c: Column | str) -> Column:
    return F.year(_col(c))


def format_ms(c: Column | str) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss.SSS``, cut (not rounded) to milliseconds."""
    return F.date_format(_col(c), MS_FORMAT)


def time_literal(value, data_type: DataType) -> Column:
    """A timestamp literal in the type of the column it is compared with.

    A literal of the other timestamp flavour would make Spark cast the column
    instead, and a cast column is not pushed down to the file scan. ``value``
    is a datetime, text, or epoch milliseconds.
    """
    if not isinstance(data_type, (TimestampType, TimestampNTZType)):
        raise TypeError(f"expected a timestamp column, got {data_type.simpleString()}")
    if isinstance(value, bool) or value is None:
        raise TypeError(f"not a point in time: {value!r}")
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        value = value.isoformat(sep=" ")  # read in the session zone, not the driver machine's
    literal = F.timestamp_millis(F.lit(value)) if isinstance(value, int) else F.lit(value)
    return literal.cast(data_type)


def newest_of(cols: list[Column | str], floor: Column | None = None) -> Column:
    """Row-wise newest of several timestamps, nulls counted as ``floor``.

    The default floor is the epoch as ``timestamp``; pass a ``timestamp_ntz``
    floor for zone-less columns.
    """
    floor = F.timestamp_millis(F.lit(0)) if floor is None else floor
    filled = [F.coalesce(_col(c), floor) for c in cols]
    return F.greatest(*filled) if len(filled) > 1 else filled[0]
