"""Export of machine snapshots: nested reshaping and a window over several activity times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nested import filter_elements, map_to_array, non_empty, struct_defaults
from ..operators.incremental import SETTLING_DELAY, between_marks, stamp_run
from ..operators.quality import require
from ..operators.shape import conform
from .schemas import MACHINES, schema

# The times whose newest decides whether a machine is exported.
ACTIVITY_TIMES = ["lastrulefetched", "lastruleprocessed", "lastupdatecheck", "lastdispatchfetched"]

# Output columns that have another name, or sit in a struct, in the source.
MACHINE_SOURCES = {
    "allocatedgids": "cartids",
    "agsservicestatus": "clientupdateinfo.agsservicestatus",
    "updatesuppressed": "clientupdateinfo.updatesuppressed",
    "lastupdaterequeststatus": "clientupdateinfo.lastupdaterequeststatus",
    "lastupdateattempted": "clientupdateinfo.lastupdateattempted",
}


def products_in_use(products: Column | str) -> Column:
    """Map of products to an array of those with files or licenses; a missing app flag reads false."""
    used = filter_elements(
        map_to_array(products), lambda p: non_empty(p["files"]) | non_empty(p["licenses"])
    )
    return F.transform(used, lambda p: struct_defaults(p, {"nglapp": False}))


def machine_snapshot(
    machines: DataFrame,
    insert_date: str | dt.date,
    run_sequence: str | int = "1",
    low=None,
    as_of=None,
    lag: str = SETTLING_DELAY,
) -> DataFrame:
    """Machines with an id in export shape; with ``as_of`` given, only those active between mark and cut-off.

    Every output comes from its own row, so the plan is one scan without a
    shuffle; both filters sit directly on the scan.
    """
    kept = require(machines, ["machineid"])
    if as_of is not None:
        kept = between_marks(kept, ACTIVITY_TIMES, low, as_of, lag)
    elif low is not None:
        raise ValueError("a low mark needs as_of")
    shaped = conform(
        kept,
        schema(MACHINES),
        sources=MACHINE_SOURCES,
        computed={"leids": products_in_use("leids")},
    )
    return stamp_run(shaped, insert_date, run_sequence)
