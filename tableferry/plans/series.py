"""Time-series moves: raw load, current values, and copies restricted to a tag list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nested import prefix
from ..functions.timecols import epoch_day, time_literal, year_month, year_of
from ..operators.keyed import keep_keys, key_list, latest_per_key, sort_for_load
from ..operators.keyfilter import rows_with_keys
from ..operators.quality import null_audit, require
from ..sources.scratch import stored

# Load order of raw readings, and the first day copied.
LOAD_ORDER = (("tag_id", "asc"), ("data_quality", "asc"), ("event_time", "desc"))
SINCE = "2013-01-01 00:00"


def readings_audit(readings: DataFrame) -> DataFrame:
    """Null counts of every column, in one pass over the readings."""
    return null_audit(readings, readings.columns)


def raw_series(
    readings: DataFrame, sort: str | None = "global", tie_break: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """Readings with tag and quality present, in load order, with their month bucket.

    ``sort`` is ``global`` (one order over the whole load), ``within`` (order
    inside each write task, no shuffle) or None. A null event time stays, with
    a null bucket.
    """
    if sort not in ("global", "within", None):
        raise ValueError(f"sort must be 'global', 'within' or None, got {sort!r}")
    kept = require(readings, ["tag_id", "data_quality"])
    if sort:
        kept = sort_for_load(kept, [*LOAD_ORDER, *tie_break], global_=sort == "global")
    return kept.withColumn("yyyymm", year_month("event_time"))


def staged_series(readings: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """The readings after one scan of their source, their null audit, and the scratch folder that holds both.

    The audit counts the stored rows column by column, so it is exact whatever
    tasks ran again while they were written, and a global order samples the
    stored rows for its ranges instead of reading the source once more. All rows
    are stored, those without keys too: the audit is about them.
    """
    rows, path = stored(readings, "load")
    return rows, readings_audit(rows), path


def current_values(
    readings: DataFrame, tie_break: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """Newest reading per tag and quality, quality 0 left out, with the asset the tag belongs to."""
    kept = require(readings, ["tag_id", "data_quality"])
    newest = latest_per_key(kept, ["tag_id", "data_quality"], [("event_time", "desc"), *tie_break])
    return (
        newest.filter(F.col("data_quality") != 0)
        .withColumn("asset_id", prefix("tag_id"))
        .drop("data_quality")
    )


def tagged_since(series: DataFrame, tags: DataFrame, since, time_col: str, long_list: bool = False) -> DataFrame:
    """Rows from ``since`` on (inclusive) whose tag is listed; nulls and copies in the list don't matter.

    A ``long_list`` is stored without its copies, and a filter made of it takes the
    rows of other tags out of the scan, so that about the rows kept are shuffled.
    """
    recent = series.filter(F.col(time_col) >= time_literal(since, series.schema[time_col].dataType))
    if long_list:
        listed, _ = stored(key_list(tags, "tag_id"), "tags")
        return rows_with_keys(recent, [F.col("tag_id")], listed)
    return keep_keys(recent, tags, "tag_id")


def daily_series(
    series: DataFrame, tags: DataFrame, since=SINCE, time_col: str = "latest_time", long_list: bool = False
) -> DataFrame:
    """Listed tags since a date, with epoch day and year."""
    return tagged_since(series, tags, since, time_col, long_list).withColumns(
        {"event_day": epoch_day(time_col), "yyyy": year_of(time_col)}
    )


def hourly_series(
    series: DataFrame, tags: DataFrame, since=SINCE, time_col: str = "latest_time", long_list: bool = False
) -> DataFrame:
    """Listed tags since a date, with the month bucket."""
    return tagged_since(series, tags, since, time_col, long_list).withColumn("yyyymm", year_month(time_col))
