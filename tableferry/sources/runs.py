"""Run-partitioned parquet: rerunnable writes, run audit, keyed merge."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..operators.incremental import RUN_COLUMNS, run_date
from ..operators.keyed import Order, order_columns, upsert
from .scratch import discard, stored
from .versions import commit, committed, new_version, read_committed

AUDIT_SCHEMA = (
    "table_name string, database_name string, insert_date string, run_sequence string, n_rows bigint"
)
# an audit line with the newest time of the run's rows
MARKED_AUDIT_SCHEMA = f"{AUDIT_SCHEMA}, max_time_ms bigint"


@dataclass(frozen=True)
class Run:
    """What a run's own write has counted; ``max_time_ms`` is None for a run without rows or times."""

    n_rows: int
    max_time_ms: int | None = None


def _sized(df: DataFrame, by: Sequence[str], max_files: int | None) -> DataFrame:
    """Spread rows over write tasks.

    By default Spark rebalances at run time: small partitions are joined, and
    a partition value that holds a large share of the rows is split over
    several tasks. ``max_files`` bounds the files per partition value instead;
    unlike ``coalesce`` it leaves the work before it at full width.
    """
    if max_files is not None:
        return df.repartition(max_files)
    return df.hint("rebalance", *[F.col(c) for c in by])


def _spread_column(df: DataFrame) -> list[str]:
    """A plain column to rebalance a single run by.

    Hashing a column needs no sort and sends a retried row to the same task,
    where a round-robin spread has to sort all rows for that. Uneven values do
    no harm: a rebalance splits large partitions.
    """
    nested = (ArrayType, MapType, StructType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)][:1]


def read_partitions(
    spark: SparkSession, path: str, schema: StructType | str, base_path: str | None = None
) -> DataFrame:
    """A partitioned tree whose schema declares the partition columns too.

    Declared, their values keep their type (a date-like text is not guessed to
    be a date) and filters on them skip directories.
    """
    reader = spark.read.schema(schema)
    return (reader.option("basePath", base_path) if base_path else reader).parquet(path)


def write_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str] = RUN_COLUMNS,
    max_files: int | None = None,
    order: Order = (),
) -> None:
    """Replace exactly those partitions of ``path`` that ``df`` has rows for.

    ``order`` sorts the rows of each file, on top of the sort by partition that
    the write needs anyway: readers then skip row groups by the leading columns.
    """
    rows = _sized(df, by, max_files)
    if order:
        rows = rows.sortWithinPartitions(*[F.col(c) for c in by], *order_columns(order))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*by)
        .parquet(path)
    )


def write_run(
    df: DataFrame,
    path: str,
    insert_date: str | dt.date,
    run_sequence: str | int = "1",
    max_files: int | None = None,
    newest: Column | None = None,
) -> Run:
    """Replace one run's rows with ``df``; what the write counted.

    The run gets a new version of its folder, so a rerun that yields no rows
    empties it, where a dynamic overwrite would leave the old rows. Rows are
    counted while they are written, and so is ``newest``, an aggregate that
    gives epoch milliseconds. Run columns ``df`` may carry are dropped: the
    folder states them. The version is valid once complete and committed; until
    then, and if the job stops anywhere, :func:`read_runs` gives the old rows.
    """
    df = df.drop(*RUN_COLUMNS)
    sequence = str(run_sequence)
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", sequence):
        raise ValueError(f"run_sequence is used as a directory name: {sequence!r}")
    place = f"insert_date={run_date(insert_date)}/run_sequence={sequence}"
    version, folder = new_version(path, place)
    counted = Observation()
    counts = [F.count(F.lit(1)).alias("n_rows"), *([] if newest is None else [newest.alias("max_time_ms")])]
    (
        _sized(df, _spread_column(df), max_files)
        # counted after the exchange: a write task counts once, a retried map task might not
        .observe(counted, *counts)
        .write.option("compression", "snappy")
        .parquet(folder)
    )
    run = Run(counted.get["n_rows"], counted.get.get("max_time_ms"))
    commit(df.sparkSession, path, place, version, run.n_rows, run.max_time_ms)
    return run


def replace_run(
    df: DataFrame,
    path: str,
    insert_date: str | dt.date,
    run_sequence: str | int = "1",
    max_files: int | None = None,
) -> int:
    """As :func:`write_run`, giving the row count alone."""
    return write_run(df, path, insert_date, run_sequence, max_files).n_rows


def read_runs(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of every committed run; filters on the run columns skip folders."""
    return read_committed(spark, path, schema)


def _run_order(insert_date: str, run_sequence: str) -> tuple:
    """Runs in time order; numbers in a sequence count as numbers."""
    parts = re.findall(r"\d+|\D+", run_sequence)
    return insert_date, [(0, int(p), "") if p.isdigit() else (1, 0, p) for p in parts]


def last_mark(
    spark: SparkSession, path: str, insert_date: str | dt.date | None = None, run_sequence: str | int = "1"
) -> int | None:
    """The newest time committed runs have written, in epoch milliseconds; None if there is none.

    It was observed in the runs' own writes and committed with them, so this is
    a listing: no row of an earlier run is read again. A run without rows leaves
    the mark where it was. With a run given, only runs before it count, so that
    a rerun starts where the run did.
    """
    marks = []
    for place, run in committed(spark, path).items():
        day, sequence = (unquote(part.split("=", 1)[1]) for part in place.split("/"))
        before = insert_date is None or _run_order(day, sequence) < _run_order(run_date(insert_date), str(run_sequence))
        if before and run.max_time_ms is not None:
            marks.append(run.max_time_ms)
    return max(marks, default=None)


def record_run(
    spark: SparkSession,
    path: str,
    table: str,
    database: str,
    insert_date: str | dt.date,
    run_sequence: str | int,
    n_rows: int,
    max_time_ms: int | None = None,
) -> None:
    """Put a run's line into the run audit table at ``path``; a rerun replaces its line.

    Each run has a directory of its own, and its file holds all columns too.
    """
    line = (table, database, run_date(insert_date), str(run_sequence), n_rows, max_time_ms)
    names = [field.split()[0] for field in AUDIT_SCHEMA.split(",")][:4]
    place = "/".join(f"{name}={quote(value, safe='')}" for name, value in zip(names, line))
    spark.createDataFrame([line], MARKED_AUDIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/{place}")


def export_run(
    df: DataFrame,
    path: str,
    table: str,
    database: str,
    insert_date: str | dt.date,
    run_sequence: str | int = "1",
    audit_path: str | None = None,
    max_files: int | None = None,
    newest: Column | None = None,
) -> int:
    """Write one run and its audit line; count and newest time come from the write itself."""
    run = write_run(df, path, insert_date, run_sequence, max_files, newest)
    if audit_path:
        record_run(
            df.sparkSession, audit_path, table, database, insert_date, run_sequence, run.n_rows, run.max_time_ms
        )
    return run.n_rows


def touched_values(new: DataFrame, by: Sequence[str]) -> DataFrame:
    """The partition values ``new`` has rows in, with their bounds stated as a filter.

    The bounds are two values per column. They let a join with the values skip
    directories: pruning at run time needs a comparison on the side that prunes.
    """
    bounds = new.agg(*[f(c).alias(f"{n}_{c}") for c in by for n, f in (("min", F.min), ("max", F.max))]).first()
    values = new.select(*by).distinct()
    for c in by:
        values = values.filter(F.col(c).between(F.lit(bounds[f"min_{c}"]), F.lit(bounds[f"max_{c}"])))
    return values


def merge_partitions(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    schema: StructType,
    keys: Sequence[str],
    by: Sequence[str],
    order_by: Order | None = None,
    ignore_nulls: bool = True,
    new_unique: bool = False,
    order_within: Order = (),
    new_is_stored: bool = False,
) -> None:
    """Upsert ``new`` into a partitioned parquet table, rewriting only partitions it touches.

    The partition columns must be part of the key, so that a row never moves
    between partitions. ``new`` is staged first, so that the partitions picked
    and the rows merged are the same even if its source goes on changing. The
    old side is cut to those partitions by a join with their values, however
    many there are. A first load goes straight to the write. ``new_is_stored``
    says that ``new`` reads rows the caller has stored, which saves that copy.

    The merged partitions are complete in the shared scratch folder before any
    old file is replaced. If the replacement stops midway, the error names that
    folder: :func:`write_partitions` of its rows finishes the merge. Staged
    folders are deleted after success.
    """
    if not set(by) <= set(keys):
        raise ValueError("the partition columns must be part of the key")
    try:
        old = read_partitions(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        first = upsert(spark.createDataFrame([], schema), new, keys, order_by, ignore_nulls, new_unique)
        write_partitions(first, path, by, order=order_within)
        return
    new_path = None
    if not new_is_stored:
        new, new_path = stored(new, "merge")
    if not new.isEmpty():
        old = old.join(touched_values(new, by), list(by), "left_semi").select(*schema.names)
        merged = upsert(old, new, keys, order_by, ignore_nulls, new_unique)
        merged, merged_path = stored(merged, "merged")
        try:
            write_partitions(merged, path, by, order=order_within)
        except Exception as e:
            e.add_note(f"the merged partitions are complete in {merged_path}; write them over {path} to finish")
            raise
        discard(spark, merged_path)
    if new_path:
        discard(spark, new_path)
