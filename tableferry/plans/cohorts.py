"""Cohort moves: checksum sync into the keyed target, and the export of disabled cohorts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checksum import row_checksum
from ..operators.changes import changed_rows, changed_rows_by_range, pick_rows
from ..operators.incremental import stamp_run
from ..operators.shape import conform
from ..sources.scratch import stored
from .schemas import COHORT_TARGET, DISABLED_COHORTS, schema

# The columns a cohort checksum covers, in order.
CHECKSUM_COLUMNS = [
    "suid", "serial_number", "cohort_id", "country_code", "country_name", "exploit_id",
    "product_leid", "is_binary_modified", "non_genuine_leids", "is_hostfile_modified",
    "is_deleted", "update_date", "external_campaign", "targeting_process", "launch_date",
    "target_category", "target_detarget_reason", "inapp_checkout_enabled",
]

# Target column and the source column it is taken from.
TARGET_SOURCES = {
    "binarymod": "is_binary_modified",
    "cohortid": "cohort_id",
    "exploitid": "exploit_id",
    "externalcampaign": "external_campaign",
    "hostfilemod": "is_hostfile_modified",
    "isdeleted": "is_deleted",
    "lastupdatetime": "update_date",
    "launchdate": "launch_date",
    "leids": "product_leid",
    "serialnumber": "serial_number",
    "target_family": "target_category",
}

# Target flags that are false on every synced row.
FALSE_FLAGS = ("disabled", "syncedtosophia", "target_for_patching")


def cohort_rows(source: DataFrame, exclude: Sequence[str] = (), sep: str = "") -> DataFrame:
    """Active cohort rows in the target's shape, with their checksum.

    ``exclude`` lists ids to leave out; with a list given, a null id is left
    out too.
    """
    active = source.filter(F.col("is_active_flag"))
    if exclude:
        active = active.filter(~F.col("suid").isin(list(exclude)))
    return conform(
        active,
        schema(COHORT_TARGET),
        sources=TARGET_SOURCES,
        computed={
            "checksum": row_checksum(active, CHECKSUM_COLUMNS, sep),
            **{flag: F.lit(False) for flag in FALSE_FLAGS},
        },
    )


def cohort_changes(
    source: DataFrame, target: DataFrame, exclude: Sequence[str] = (), sep: str = "", ranges: int = 0
) -> DataFrame:
    """Cohort rows that are new to the target or differ from it, ready to be upserted.

    The checksum covers the whole row, so a keyed target holds each (id,
    checksum) pair once. The pairs are compared by themselves, the differing
    ones are stored, and their rows are picked from a second scan: wide rows
    are shuffled only where the changes are too many for Spark to broadcast. A
    row that changes between the two scans is left to the next run. With
    ``ranges`` given, digests of that many hash ranges of the id are compared first
    and only the pairs of ranges that differ.
    """
    rows, on = cohort_rows(source, exclude, sep), ["suid", "checksum"]
    if ranges:
        pairs = changed_rows_by_range(rows.select(*on), target, on, ["suid"], ranges, target_unique=True)
    else:
        pairs = changed_rows(rows.select(*on), target, on, target_unique=True)
    pairs, _ = stored(pairs, "changed")
    return pick_rows(rows, pairs, on)


def disabled_cohorts(
    cohorts: DataFrame, insert_date: str | dt.date, run_sequence: str | int = "1"
) -> DataFrame:
    """Disabled cohorts for export; null flags read as false, null arrays stay null."""
    disabled = cohorts.filter(F.col("disabled"))
    return stamp_run(conform(disabled, schema(DISABLED_COHORTS)), insert_date, run_sequence)
