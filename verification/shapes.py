"""Time an operator against the same work in the plan shape it replaces.

``python -m verification.shapes [sf_dir]``. The older shape is the literal one:
a count per check and per stage, an inner join with a distinct list, an outer
join with a filter on its null side. Both shapes write to the ``noop`` sink.
"""

from __future__ import annotations

import statistics
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.functions import epoch_day, year_of
from tableferry.operators import changed_rows, null_audit, require
from tableferry.plans import audit_events, cohort_rows, daily_series
from tableferry.session import build_session
from tableferry.sources import export_run, scratch_path

from . import adapters as A


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def shapes(spark, sf_dir):
    readings = A.derive(spark, sf_dir, "events", A.READINGS)
    keys = ["tag_id", "data_quality"]

    def audit_by_counts():
        for key in keys:
            readings.filter(F.col(key).isNull()).count()
        drain(require(readings, keys))

    def audit_in_one_pass():
        null_audit(readings, keys).collect()
        drain(require(readings, keys))

    daily = A.derive(spark, sf_dir, "lineitem", A.DAILY)
    tags = A.derive(spark, sf_dir, "orders", A.DAILY_TAGS)
    since = "1997-01-01 00:00"

    def inner_with_distinct():
        wanted = tags.filter("tag_id IS NOT NULL").select("tag_id").distinct()
        recent = daily.filter(F.col("latest_time") >= F.lit(since))
        drain(
            recent.join(wanted, "tag_id")
            .withColumn("event_day", epoch_day("latest_time"))
            .withColumn("yyyy", year_of("latest_time"))
        )

    def semi():
        drain(daily_series(daily, tags, since=since))

    source = cohort_rows(A.derive(spark, sf_dir, "orders", A.cohort_source("spark")))
    target = cohort_rows(A.derive(spark, sf_dir, "orders", A.cohort_target_source("spark")))
    on = ["suid", "checksum"]

    def outer_then_filter():
        known = target.select(*on, F.lit(True).alias("hit"))
        drain(source.join(known, on, "left_outer").filter("hit IS NULL").drop("hit"))

    def anti():
        drain(changed_rows(source, target, on, target_unique=True))

    events = A.derive(spark, sf_dir, "events", A.AUDIT)

    def export_with_counts():
        events.count()
        audit_events(events, "2024-02-01").filter("event_time IS NOT NULL").count()
        rows = audit_events(events, "2024-02-01", low="2024-01-05", as_of="2024-01-28")
        rows.count()
        rows.coalesce(100).write.partitionBy("insert_date", "run_sequence").parquet(
            scratch_path(spark, "counted")
        )

    def export_counted_while_written():
        rows = audit_events(events, "2024-02-01", low="2024-01-05", as_of="2024-01-28")
        export_run(rows, scratch_path(spark, "observed"), "audit", "raw", "2024-02-01")

    return {
        "null audit and load": (audit_by_counts, audit_in_one_pass),
        "copy of listed tags": (inner_with_distinct, semi),
        "change detection": (outer_then_filter, anti),
        "audit export with counts": (export_with_counts, export_counted_while_written),
    }


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session("shapes", "local[8]", extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(fn) -> float:
        def once():
            start = time.perf_counter()
            fn()
            return time.perf_counter() - start

        once()
        return statistics.median(once() for _ in range(3))

    for name, (older, ours) in shapes(spark, sf_dir).items():
        print(f"| {name} | {seconds(older):.2f} | {seconds(ours):.2f} |", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
