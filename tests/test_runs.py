"""Committed run versions, marks kept with them, loads counted on stored rows, settings of the session."""

import datetime as dt
import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tableferry.jobs import main
from tableferry.operators import stamp_run
from tableferry.plans import audit_events, newest_audit, newest_machines
from tableferry.plans.machines import ACTIVITY_TIMES
from tableferry.sources import (
    export_run,
    last_mark,
    merge_partitions,
    read_runs,
    read_table,
    record_run,
    replace_run,
    runs,
    session_options,
    versions,
    write_run,
    write_table,
)

RUNS = "id bigint, insert_date string, run_sequence string"


def ids(spark, path, schema=RUNS):
    return sorted(r["id"] for r in read_runs(spark, path, schema).collect())


class Lost(Exception):
    """The driver is gone."""


def test_a_driver_lost_before_the_commit_leaves_the_old_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    write_run(spark.range(5), path, "2024-01-01", newest=F.max("id"))

    def lost(*args, **kwargs):
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(runs, "commit", lost)
        with pytest.raises(Lost):
            write_run(spark.range(10, 20), path, "2024-01-01", newest=F.max("id"))
    assert ids(spark, path) == list(range(5)) and last_mark(spark, path) == 4
    # the next attempt takes over
    assert write_run(spark.range(3), path, "2024-01-01", newest=F.max("id")).n_rows == 3
    assert ids(spark, path) == [0, 1, 2] and last_mark(spark, path) == 2
    assert (versions.sweep(spark, path), versions.sweep(spark, path)) == (1, 0)
    assert ids(spark, path) == [0, 1, 2]
    assert len(list((tmp_path / "runs/insert_date=2024-01-01/run_sequence=1").iterdir())) == 1


def test_a_driver_lost_after_the_commit_leaves_the_new_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    replace_run(spark.range(5), path, "2024-01-01")

    def lost(*args):
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_delete", lost)
        with pytest.raises(Lost):
            replace_run(spark.range(10, 12), path, "2024-01-01")
    # both versions and both markers are there
    assert len(list((tmp_path / "runs/insert_date=2024-01-01/run_sequence=1").iterdir())) == 2
    assert ids(spark, path) == [10, 11]
    replace_run(spark.range(7, 8), path, "2024-01-01")
    assert ids(spark, path) == [7]
    assert len(list((tmp_path / "runs/insert_date=2024-01-01/run_sequence=1").iterdir())) == 1


def test_files_of_a_run_without_versions_go_with_the_first_commit(spark, tmp_path):
    path = str(tmp_path / "runs")
    spark.range(5).write.parquet(f"{path}/insert_date=2024-01-01/run_sequence=1")
    replace_run(spark.range(2), path, "2024-01-01")
    assert ids(spark, path) == [0, 1] and spark.read.parquet(path).count() == 2


def test_a_write_that_fails_is_never_read(spark, tmp_path):
    path = str(tmp_path / "runs")
    replace_run(spark.range(5), path, "2024-01-01")
    with pytest.raises(Exception, match="stop"):
        replace_run(spark.range(100).selectExpr("if(id > 50, raise_error('stop'), id) AS id"), path, "2024-01-01")
    assert ids(spark, path) == list(range(5))


def test_of_two_attempts_the_later_marker_counts(spark, tmp_path):
    path, place = str(tmp_path / "runs"), "insert_date=2024-01-01/run_sequence=1"
    folders = [versions.new_version(path, place) for _ in range(2)]
    for n, (_, folder) in enumerate(folders):
        spark.range(n + 1).write.parquet(folder)
    for n, (version, _) in enumerate(folders):
        versions.commit(spark, path, place, version, n + 1)
    assert ids(spark, path) == [0, 1]


def test_runs_keep_apart_and_filters_skip_folders(spark, tmp_path):
    path = str(tmp_path / "runs")
    for day in ("2024-01-01", "2024-01-02"):
        for sequence in ("1", "2.b"):
            replace_run(stamp_run(spark.range(4), day, sequence), path, day, sequence)
    replace_run(spark.range(0), path, "2024-01-02", "1")
    back = read_runs(spark, path, RUNS)
    assert back.dtypes == [("id", "bigint"), ("insert_date", "string"), ("run_sequence", "string")]
    assert back.count() == 12
    one = back.filter("insert_date = '2024-01-01' AND run_sequence = '2.b'")
    assert one.count() == 4 and len(one.inputFiles()) <= len(back.inputFiles())
    assert "PartitionFilters: [isnotnull(insert_date" in one._jdf.queryExecution().executedPlan().toString()
    assert read_runs(spark, str(tmp_path / "none"), RUNS).count() == 0 and last_mark(spark, str(tmp_path / "none")) is None


def test_marks(spark, tmp_path):
    path = str(tmp_path / "runs")
    for day, sequence, n in (("2024-01-01", "1", 5), ("2024-01-01", "9", 0), ("2024-01-01", "10", 9), ("2024-01-02", "1", 0)):
        write_run(spark.range(n), path, day, sequence, newest=F.max("id"))
    assert last_mark(spark, path) == 8
    # runs without rows leave it where it was, and a rerun starts where the run did: 9 comes before 10
    assert [last_mark(spark, path, *run) for run in (("2024-01-01", 1), ("2024-01-01", 10), ("2024-01-02", 1), ("2024-02-01", 1))] == [
        None, 4, 8, 8,
    ]
    write_run(spark.range(-9, -3), str(tmp_path / "early"), "2024-01-01", newest=F.max("id"))
    assert last_mark(spark, str(tmp_path / "early")) == -4


def test_marks_are_observed_in_the_write(spark, tmp_path):
    """Milliseconds of a text time and of the newest of several times, nulls as the epoch."""
    kind = """suid string, eventtime timestamp, eventtype string, cartid string, gtoken string, city int,
        region int, country int, activeleid string, notifurl string, notif_audit_id string"""
    at = dt.datetime(2024, 1, 3, 4, 5, 6, 789_654)
    rows = audit_events(spark.createDataFrame([("s", at, *[None] * 9), ("t", None, *[None] * 9)], kind), "2024-01-04")
    run = write_run(rows, str(tmp_path / "a"), "2024-01-04", newest=newest_audit())
    assert run.max_time_ms == int(dt.datetime(2024, 1, 3, 4, 5, 6, tzinfo=dt.timezone.utc).timestamp()) * 1000 + 789
    machines = ", ".join(f"{c} timestamp" for c in ACTIVITY_TIMES)
    for values, want in (([None] * 4, 0), ([None, dt.datetime(1970, 1, 2), None, None], 86_400_000)):
        run = write_run(spark.createDataFrame([values], machines), str(tmp_path / "m"), "2024-01-04", newest=newest_machines())
        assert run.max_time_ms == want
    empty = write_run(spark.createDataFrame([], machines), str(tmp_path / "m"), "2024-01-04", newest=newest_machines())
    assert (empty.n_rows, empty.max_time_ms) == (0, None)


def test_audit_lines_carry_the_mark(spark, tmp_path):
    path, audit = str(tmp_path / "runs"), str(tmp_path / "audit")
    export_run(spark.range(5), path, "t", "d", "2024-01-01", audit_path=audit, newest=F.max("id"))
    record_run(spark, audit, "t", "d", "2024-01-02", "1", 0)
    lines = spark.read.option("recursiveFileLookup", "true").parquet(audit)
    assert sorted((r["insert_date"], r["n_rows"], r["max_time_ms"]) for r in lines.collect()) == [
        ("2024-01-01", 5, 4),
        ("2024-01-02", 0, None),
    ]


def test_export_jobs_resume_where_the_runs_before_have_stopped(spark, tmp_path, capsys):
    kind = """suid string, eventtime timestamp, eventtype string, cartid string, gtoken string, city int,
        region int, country int, activeleid string, notifurl string, notif_audit_id string"""
    data = [(f"s{d:02d}", dt.datetime(2024, 1, d), *[None] * 9) for d in range(1, 21)]
    spark.createDataFrame(data, kind).write.parquet(str(tmp_path / "src"))

    def export(day, as_of):
        main([
            "export-audit", "--source-option", f"path={tmp_path}/src", "--path", str(tmp_path / "out"), "--table", "audit",
            "--database", "raw", "--insert-date", day, "--as-of", as_of, "--resume",
        ])
        return json.loads(capsys.readouterr().out.splitlines()[-1])["n_rows"]

    assert [export(d, d) for d in ("2024-01-06", "2024-01-11", "2024-01-16")] == [4, 5, 5]
    # a rerun of an earlier run starts at its own beginning, whatever came later
    assert export("2024-01-11", "2024-01-11") == 5
    assert export("2024-01-17", "2024-01-16") == 0 and export("2024-01-18", "2024-01-18") == 2
    shape = "suid string, insert_date string, run_sequence string"
    assert sorted(r["suid"] for r in read_runs(spark, str(tmp_path / "out"), shape).collect()) == [f"s{d:02d}" for d in range(1, 17)]


RETRY = """
import sys, json, os
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from tableferry.session import build_session
from tableferry.plans import staged_series
spark = build_session("retry", "local[2,4]", 4, {{"spark.checkpoint.dir": {tmp!r}}})
spark.sparkContext.setLogLevel("OFF")
rows = spark.range(0, 1000, 1, 4).selectExpr("if(id % 10 = 0, null, concat('t', id)) AS tag_id", "id")

def fails_once(batches):
    import os, pyarrow
    from pyspark import TaskContext
    held = list(batches)
    task = TaskContext.get()
    if task.partitionId() == 2 and task.attemptNumber() == 0:
        raise RuntimeError("lost after its rows were read")
    yield from held

staged, audit, _ = staged_series(rows.mapInArrow(fails_once, rows.schema))
print("FOUND", json.dumps([[r[0], r[1], r[2]] for r in audit.collect()]), staged.count())
spark.stop()
"""


def test_counts_are_exact_when_a_task_runs_again(tmp_path):
    code = RETRY.format(repo=str(Path(__file__).resolve().parents[1]), tmp=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180).stdout
    found = next(line for line in out.splitlines() if line.startswith("FOUND"))
    assert found == 'FOUND [["tag_id", 1000, 100], ["id", 1000, 0]] 1000'


def test_a_staged_load_reads_its_source_once(spark, tmp_path):
    """The order is sampled from the stored rows: nothing but the store reads the source."""
    from tableferry.plans import raw_series, staged_series

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kind = "tag_id string, data_quality int, event_time timestamp, event_value double"
    at = dt.datetime(2021, 3, 4)
    data = [(f"t{i % 7}" if i % 5 else None, i % 3, at, float(i)) for i in range(500)]
    source = spark.createDataFrame(data, kind).mapInArrow(count, kind)
    staged, audit, path = staged_series(source)
    ordered = raw_series(staged, "global", [("event_value", "asc")])
    values = [(r["tag_id"], r["data_quality"], r["event_value"]) for r in ordered.collect()]
    assert values == sorted(values) and len(values) == 400
    assert {r["column_name"]: r["n_null"] for r in audit.collect()}["tag_id"] == 100
    assert seen.value == 500
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and all(path in f for f in staged.inputFiles())


def test_a_merge_of_stored_rows_makes_no_other_copy(spark, tmp_path, monkeypatch):
    kind = spark.createDataFrame([], "k int, v int, p int").schema
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 1, 1)], kind).write.partitionBy("p").parquet(path)
    names = []
    stored = runs.stored
    monkeypatch.setattr(runs, "stored", lambda df, name: names.append(name) or stored(df, name))
    for new_is_stored in (True, False):
        merge_partitions(
            spark, spark.createDataFrame([(1, 2, 1)], kind), path, kind, ["k", "p"], ["p"], new_unique=True, new_is_stored=new_is_stored
        )
    assert names == ["merged", "merge", "merged"]
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, 2, 1)]


def test_settings_of_the_session_alone(spark, conf, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "one"))
    spark.range(7).write.option("header", "true").csv(str(tmp_path / "two"))
    conf({
        "spark.datasource.parquet.path": str(tmp_path / "one"),
        "spark.datasource.csv.path": str(tmp_path / "two"),
        "spark.datasource.csv.header": "true",
    })
    assert read_table(spark, "parquet").count() == 5
    assert read_table(spark, "csv", schema="id long").agg(F.max("id")).first()[0] == 6
    # what is given goes before what the session says
    assert read_table(spark, "csv", {"header": "false"}).count() > 7
    assert session_options(spark, "csv") == {"path": str(tmp_path / "two"), "header": "true"}
    assert session_options(spark, "orc") == {}
    conf({"spark.datasource.orc.path": str(tmp_path / "three")})
    for _ in range(2):
        write_table(spark.range(3), "orc")
    assert read_table(spark, "orc").count() == 6
