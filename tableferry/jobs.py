"""The table moves as jobs for ``spark-submit``: ``jobs.py <job> --help``.

Tables are named by connector format and ``key=value`` options, times and run
ids are arguments, and nothing reads the clock, so a job can be rerun.
"""

from __future__ import annotations

import argparse
import json
import sys
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import require
from .operators.keyed import Order
from .plans import (
    audit_events,
    audit_mark,
    cohort_changes,
    current_values,
    daily_series,
    disabled_cohorts,
    hourly_series,
    machine_mark,
    machine_snapshot,
    mark_value,
    newest_audit,
    newest_machines,
    raw_series,
    staged_series,
)
from .plans.schemas import READINGS, TAGS
from .plans.series import LOAD_ORDER, SINCE
from .session import build_session, shuffle_width
from .sources import (
    export_run,
    last_mark,
    merge_partitions,
    read_table,
    read_tree,
    write_table,
)
from .sources.scratch import discard, stored


# File formats: an append to one of them repeats rows when a job is rerun.
FILES = ("parquet", "orc", "avro", "json", "csv", "text")


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs or [])


def _names(text: str | None) -> list[str]:
    return [name for name in (text or "").split(",") if name]


def _source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return read_table(spark, args.source_format, _options(args.source_option))


def _deliver(
    spark: SparkSession, df: DataFrame, args: argparse.Namespace, order_within: Order = (), is_stored: bool = False
) -> None:
    """Append to a keyed store, or merge into a partitioned parquet table when keys are given.

    Rows dropped for a null key are counted on stored rows, so that no task
    that ran again counts twice.
    """
    options = _options(args.target_option)
    if args.keys:
        order = [tuple(entry.split(":", 1)) for entry in _names(args.order)]
        # rows of a key are never taken for unique: without an order the largest values win
        comparable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        order = order or [(c, "desc") for c in comparable if c not in _names(args.keys)]
        order = order or [(_names(args.keys)[0], "desc")]
        staged, kind = None, df.schema
        if args.drop_null_keys:
            if not is_stored:
                df, staged = stored(df, "deliver")
            null_key = reduce(or_, [F.col(k).isNull() for k in _names(args.keys)])
            dropped = df.filter(null_key).count()
            df = require(df, _names(args.keys))
        merge_partitions(
            spark,
            df,
            options["path"],
            kind,
            keys=_names(args.keys),
            by=_names(args.partition_by),
            order_by=order,
            order_within=order_within,
            new_is_stored=is_stored or staged is not None,
        )
        if args.drop_null_keys:
            print(json.dumps({"dropped_null_keys": dropped}))
        if staged:
            discard(spark, staged)
    else:
        if args.target_format in FILES:
            raise SystemExit(f"{args.target_format} has no keys, so a rerun would repeat its rows: give --keys and --partition-by")
        write_table(df, args.target_format, options)


def load_series(spark: SparkSession, args: argparse.Namespace) -> None:
    readings, audit, staged = staged_series(read_tree(spark, args.path, READINGS))
    sort = None if args.keys else args.sort  # a merge orders its files when it writes them
    lines = [line.asDict() for line in audit.collect()]  # one line per column
    _deliver(spark, raw_series(readings, sort), args, order_within=LOAD_ORDER, is_stored=True)
    discard(spark, staged)
    for line in lines:
        print(json.dumps(line))


def load_current(spark: SparkSession, args: argparse.Namespace) -> None:
    readings = read_tree(spark, args.path, READINGS)
    _deliver(spark, current_values(readings, tie_break=[("event_value", "desc")]), args)


def copy_daily(spark: SparkSession, args: argparse.Namespace) -> None:
    tags = read_tree(spark, args.tags, TAGS)
    _deliver(spark, daily_series(_source(spark, args), tags, args.since, args.time_column), args)


def copy_hourly(spark: SparkSession, args: argparse.Namespace) -> None:
    tags = read_tree(spark, args.tags, TAGS)
    _deliver(spark, hourly_series(_source(spark, args), tags, args.since, args.time_column), args)


def _low(text: str | None):
    return int(text) if text and text.lstrip("-").isdigit() else text


def _start(spark: SparkSession, args: argparse.Namespace):
    """Where the window opens: as given, or with ``--resume`` at the mark the runs before have left in the export's folder."""
    if args.resume and args.low:
        raise SystemExit("give --low or --resume, not both")
    return last_mark(spark, args.path, args.insert_date, args.run_sequence) if args.resume else _low(args.low)


def _export(spark: SparkSession, df: DataFrame, args: argparse.Namespace, newest: Column | None = None) -> None:
    n_rows = export_run(
        df,
        args.path,
        args.table,
        args.database,
        args.insert_date,
        args.run_sequence,
        args.audit_path,
        args.max_files,
        newest,
    )
    print(json.dumps({"table": args.table, "n_rows": n_rows}))


def export_audit(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = audit_events(
        _source(spark, args), args.insert_date, args.run_sequence, _start(spark, args), args.as_of, args.lag
    )
    _export(spark, rows, args, newest_audit())


def export_machines(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = machine_snapshot(
        _source(spark, args), args.insert_date, args.run_sequence, _start(spark, args), args.as_of, args.lag
    )
    _export(spark, rows, args, newest_machines())


def export_cohorts(spark: SparkSession, args: argparse.Namespace) -> None:
    _export(spark, disabled_cohorts(_source(spark, args), args.insert_date, args.run_sequence), args)


def sync_cohorts(spark: SparkSession, args: argparse.Namespace) -> None:
    target = read_table(spark, args.target_format, _options(args.target_option))
    _deliver(spark, cohort_changes(_source(spark, args), target, _names(args.exclude), ranges=args.ranges), args)


def mark_audit(spark: SparkSession, args: argparse.Namespace) -> None:
    print(json.dumps({"max_time_ms": mark_value(audit_mark(_source(spark, args)))}))


def mark_machines(spark: SparkSession, args: argparse.Namespace) -> None:
    print(json.dumps({"max_time_ms": mark_value(machine_mark(_source(spark, args)))}))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tableferry.jobs")
    parser.add_argument("--master", help="left to the launcher unless given")
    parser.add_argument("--largest-shuffle-gb", type=float, help="sizes the shuffles of the job")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(run, *groups):
        sub = jobs.add_parser(run.__name__.replace("_", "-"))
        sub.set_defaults(run=run)
        for group in groups:
            group(sub)

    def tree(sub):
        sub.add_argument("--path", required=True, help="parquet tree of readings")

    def source(sub):
        sub.add_argument("--source-format", default="parquet")
        sub.add_argument("--source-option", action="append", metavar="KEY=VALUE")

    def target(sub):
        sub.add_argument("--target-format", default="parquet")
        sub.add_argument("--target-option", action="append", metavar="KEY=VALUE")
        sub.add_argument("--keys", help="merge into parquet by these columns (comma list)")
        sub.add_argument("--partition-by", help="partition columns of the merge, part of the keys")
        sub.add_argument("--drop-null-keys", action="store_true", help="null keys fail the merge otherwise")
        sub.add_argument("--order", help="which of several new rows of a key wins: column:asc|desc,...")

    def sort(sub):
        sub.add_argument("--sort", choices=["global", "within"], default="within")

    def tags(sub):
        sub.add_argument("--tags", required=True, help="parquet tree with a tag_id column")
        sub.add_argument("--since", default=SINCE)
        sub.add_argument("--time-column", default="latest_time")

    def exclude(sub):
        sub.add_argument("--exclude", help="ids to leave out (comma list)")

    def ranges(sub):
        sub.add_argument("--ranges", type=int, default=0, help="compare digests of that many hash ranges of the id first")

    def run(sub):
        sub.add_argument("--path", required=True, help="folder of the export")
        sub.add_argument("--table", required=True)
        sub.add_argument("--database", required=True)
        sub.add_argument("--insert-date", required=True, metavar="YYYY-MM-DD")
        sub.add_argument("--run-sequence", default="1")
        sub.add_argument("--audit-path")
        sub.add_argument("--max-files", type=int, help="files of the run; the write is that many tasks wide")

    def window(sub):
        sub.add_argument("--low", help="mark of the last run: epoch milliseconds or a time")
        sub.add_argument("--resume", action="store_true", help="start at the mark that earlier runs have left in --path")
        sub.add_argument("--as-of", help="time of this run; without it there is no window")
        sub.add_argument("--lag", default="24 hours")

    job(load_series, tree, target, sort)
    job(load_current, tree, target)
    job(copy_daily, source, target, tags)
    job(copy_hourly, source, target, tags)
    job(export_audit, source, run, window)
    job(export_machines, source, run, window)
    job(export_cohorts, source, run)
    job(sync_cohorts, source, target, exclude, ranges)
    job(mark_audit, source)
    job(mark_machines, source)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    width = args.largest_shuffle_gb and shuffle_width(args.largest_shuffle_gb)
    args.run(build_session(f"tableferry {args.job}", args.master, width), args)


if __name__ == "__main__":
    main(sys.argv[1:])
