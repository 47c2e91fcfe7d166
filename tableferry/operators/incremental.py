"""Incremental runs: high-water mark, time window, run columns and run audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.timecols import time_literal

# Fixed value: settling delay before a row may be exported.
SETTLING_DELAY = "24 hours"

RUN_COLUMNS = ("insert_date", "run_sequence")


def high_water(df: DataFrame, cols: str | Sequence[str], fmt: str | None = None) -> DataFrame:
    """Newest time over the whole table and all of ``cols``: one row (max_time, max_time_ms).

    ``fmt`` parses text columns; text that does not fit counts as null. Both
    outputs are null on an empty or unparsable table: start from the beginning
    then.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    maxima = [F.max(F.try_to_timestamp(F.col(c), F.lit(fmt)) if fmt else F.col(c)) for c in cols]
    newest = F.greatest(*maxima) if len(maxima) > 1 else maxima[0]
    return df.agg(newest.alias("max_time")).select(
        "max_time", F.unix_millis(F.col("max_time").cast("timestamp")).alias("max_time_ms")
    )


def between_marks(
    df: DataFrame, cols: str | Sequence[str], low, as_of, lag: str = SETTLING_DELAY
) -> DataFrame:
    """Rows with ``low < time < as_of - lag``, both ends open; ``low=None`` means from the beginning.

    With several columns the time is their newest, nulls counted as the epoch.
    That test is spelled out per column (one of them after ``low``, none of them
    at or after the cut-off) instead of over ``greatest``, so that the file scan
    can skip row groups by it. A null in a single column drops the row.

    A ``low`` in epoch milliseconds, as ``high_water`` gives it, covers its whole
    millisecond: the row the mark was taken from is not found again. For the same
    reason the cut-off is the start of its millisecond.
    """
    single = isinstance(cols, str) or len(cols) == 1
    names = [cols] if isinstance(cols, str) else list(cols)

    def is_after(c: Column, kind: DataType) -> Column:
        if low is None:
            return F.lit(True)
        if isinstance(low, int):
            return c >= time_literal(low + 1, kind)
        return c > time_literal(low, kind)

    after, before = F.lit(False), F.lit(True)
    for name in names:
        c, kind = F.col(name), df.schema[name].dataType
        epoch = time_literal(0, kind)
        # a mark covers its whole millisecond, so a run must not stop inside one
        cutoff = F.date_trunc("millisecond", time_literal(as_of, kind) - F.expr(f"INTERVAL {lag}")).cast(kind)
        if single:
            after, before = is_after(c, kind), c < cutoff
        else:
            after |= is_after(c, kind) | (c.isNull() & is_after(epoch, kind))
            before &= (c < cutoff) | (c.isNull() & (epoch < cutoff))
    return df.filter(after & before)


def run_date(value: str | dt.date) -> str:
    """Run date as ``yyyy-MM-dd`` text."""
    if isinstance(value, dt.datetime):
        value = value.date()
    text = value.isoformat() if isinstance(value, dt.date) else value
    return dt.datetime.strptime(text, "%Y-%m-%d").strftime("%Y-%m-%d")


def stamp_run(df: DataFrame, insert_date: str | dt.date, run_sequence: str | int = "1") -> DataFrame:
    """Add the run columns, both text."""
    return df.withColumns(
        {"insert_date": F.lit(run_date(insert_date)), "run_sequence": F.lit(str(run_sequence))}
    )


def run_audit(df: DataFrame, table: str, database: str) -> DataFrame:
    """One row per run found in a stamped table: (table_name, database_name, run columns, n_rows)."""
    return (
        df.groupBy(*RUN_COLUMNS)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            F.lit(table).alias("table_name"),
            F.lit(database).alias("database_name"),
            *RUN_COLUMNS,
            "n_rows",
        )
    )
