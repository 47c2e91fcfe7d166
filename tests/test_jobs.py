"""The jobs from their command lines, with parquet standing in for a keyed store."""

import datetime as dt
import json

import pytest

from tableferry.jobs import main
from tableferry.plans.schemas import READINGS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_load_series_twice_keeps_one_copy(spark, tmp_path, capsys):
    at = dt.datetime(2021, 3, 4)
    data = [("a.1", 1, at, 1.0), ("a.1", 0, at, 2.0), (None, 1, at, 3.0)]
    spark.createDataFrame(data, READINGS).write.parquet(str(tmp_path / "in/deep/er"))
    command = [
        "load-series", "--path", str(tmp_path / "in"), "--target-option", f"path={tmp_path}/out",
        "--keys", "tag_id,data_quality,event_time,yyyymm", "--partition-by", "yyyymm",
    ]
    main(command)
    main(command)
    lines = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert {"column_name": "tag_id", "n_rows": 3, "n_null": 1} in lines
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back.select("tag_id", "data_quality", "event_value")) == [("a.1", 0, 2.0), ("a.1", 1, 1.0)]


def test_load_current(spark, tmp_path):
    data = [("a.1", 1, dt.datetime(2021, 3, d), float(d)) for d in (1, 2)]
    spark.createDataFrame(data, READINGS).write.parquet(str(tmp_path / "in"))
    command = ["load-current", "--path", str(tmp_path / "in"), "--target-option", f"path={tmp_path}/out"]
    with pytest.raises(SystemExit, match="no keys"):
        main(command)
    for _ in range(2):
        main([*command, "--keys", "tag_id,asset_id", "--partition-by", "asset_id"])
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("tag_id", "event_value", "asset_id")) == [
        ("a.1", 2.0, "a")
    ]


def test_copies(spark, tmp_path):
    spark.createDataFrame([("a",), (None,)], "tag_id string").write.parquet(str(tmp_path / "tags"))
    data = [("a", dt.datetime(2014, 1, 1)), ("b", dt.datetime(2014, 1, 1)), ("a", dt.datetime(2010, 1, 1))]
    spark.createDataFrame(data, "tag_id string, latest_time timestamp").write.parquet(str(tmp_path / "src"))
    for job, by, column, value in (
        ("copy-daily", "yyyy", "event_day", 16071), ("copy-hourly", "yyyymm", "yyyymm", 201401),
    ):
        for _ in range(2):
            main([
                job, "--tags", str(tmp_path / "tags"), "--source-option", f"path={tmp_path}/src",
                "--target-option", f"path={tmp_path}/{job}", "--keys", f"tag_id,latest_time,{by}", "--partition-by", by,
            ])
        back = spark.read.parquet(str(tmp_path / job))
        assert rows(back.select("tag_id", column)) == [("a", value)]


def test_export_mark_export(spark, tmp_path, capsys):
    kind = """suid string, eventtime timestamp, eventtype string, cartid string, gtoken string, city int,
        region int, country int, activeleid string, notifurl string, notif_audit_id string"""
    data = [(f"s{d}", dt.datetime(2024, 1, d), *[None] * 9) for d in range(1, 11)]
    spark.createDataFrame(data, kind).write.parquet(str(tmp_path / "src"))

    def export(date, as_of, low=None):
        main([
            "export-audit", "--source-option", f"path={tmp_path}/src", "--path", str(tmp_path / "out"),
            "--table", "audit", "--database", "raw", "--insert-date", date, "--as-of", as_of,
            "--audit-path", str(tmp_path / "runs"), "--max-files", "4", *(["--low", str(low)] if low else []),
        ])
        return json.loads(capsys.readouterr().out.splitlines()[-1])["n_rows"]

    assert export("2024-01-06", "2024-01-06") == 4
    main(["mark-audit", "--source-option", f"path={tmp_path}/out"])
    mark = json.loads(capsys.readouterr().out.splitlines()[-1])["max_time_ms"]
    assert export("2024-01-09", "2024-01-09", mark) == 3
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.suid for r in back.collect()) == [f"s{d}" for d in range(1, 8)]
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2


def test_sync_cohorts_into_parquet(spark, tmp_path):
    from tableferry.plans import cohort_rows

    row = """SELECT concat('s', id) AS suid, 'n' AS serial_number, 'c' AS cohort_id, 'US' AS country_code,
        'Us' AS country_name, array('e') AS exploit_id, array('l') AS product_leid,
        map('b', true) AS is_binary_modified, array('g') AS non_genuine_leids, true AS is_hostfile_modified,
        false AS is_deleted, timestamp'2024-01-01' AS update_date, 'x' AS external_campaign,
        'p' AS targeting_process, '{launch}' AS launch_date, 'f' AS target_category,
        'r' AS target_detarget_reason, true AS inapp_checkout_enabled, true AS is_active_flag FROM range({n})"""
    spark.sql(row.format(launch="2024-01-01", n=3)).write.parquet(str(tmp_path / "one"))
    spark.sql(row.format(launch="2024-02-02", n=4)).write.parquet(str(tmp_path / "two"))
    cohort_rows(spark.read.parquet(str(tmp_path / "one"))).write.partitionBy("target_family").parquet(
        str(tmp_path / "target")
    )
    main([
        "sync-cohorts", "--source-option", f"path={tmp_path}/two", "--exclude", "s1",
        "--target-option", f"path={tmp_path}/target",
        "--keys", "suid,cohortid,target_family", "--partition-by", "target_family",
    ])
    back = spark.read.parquet(str(tmp_path / "target"))
    assert rows(back.select("suid", "launchdate")) == [
        ("s0", "2024-02-02"),
        ("s1", "2024-01-01"),
        ("s2", "2024-02-02"),
        ("s3", "2024-02-02"),
    ]


def test_load_of_nothing(spark, tmp_path, capsys):
    spark.createDataFrame([], READINGS).write.parquet(str(tmp_path / "in"))
    main([
        "load-series", "--path", str(tmp_path / "in"), "--target-option", f"path={tmp_path}/out",
        "--keys", "tag_id,data_quality,event_time,yyyymm", "--partition-by", "yyyymm", "--drop-null-keys",
    ])
    assert '{"dropped_null_keys": 0}' in capsys.readouterr().out


def test_null_keys_fail_the_merge_unless_dropped(spark, tmp_path, capsys):
    from pyspark.errors import PySparkException

    data = [("a.1", 1, None, 1.0), ("a.2", 1, dt.datetime(2021, 3, 4), 1.0)]
    spark.createDataFrame(data, READINGS).write.parquet(str(tmp_path / "in"))
    command = [
        "load-series", "--path", str(tmp_path / "in"), "--target-option", f"path={tmp_path}/out",
        "--keys", "tag_id,data_quality,event_time,yyyymm", "--partition-by", "yyyymm",
    ]
    with pytest.raises(PySparkException, match="null in key column"):
        main(command)
    main([*command, "--drop-null-keys"])
    assert '{"dropped_null_keys": 1}' in capsys.readouterr().out
    assert [r.tag_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["a.2"]


def test_shuffle_width():
    from tableferry.session import shuffle_width

    assert [shuffle_width(gb) for gb in (0.1, 5000, 100_000, 1_000_000)] == [200, 5000, 100_000, 1_000_000]
