"""The plans on small fixtures with answers worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tableferry.plans import (
    audit_events,
    audit_mark,
    cohort_changes,
    cohort_rows,
    current_values,
    daily_series,
    disabled_cohorts,
    hourly_series,
    machine_mark,
    machine_snapshot,
    mark_value,
    raw_series,
    readings_audit,
)
from tableferry.plans.cohorts import CHECKSUM_COLUMNS
from tableferry.plans.machines import MACHINE_SOURCES
from tableferry.plans.schemas import (
    AUDIT_EVENTS,
    COHORT_TARGET,
    DISABLED_COHORTS,
    FILE,
    HARDENING,
    LICENSE,
    MACHINES,
    OPERATING_CONFIG,
    PRODUCT,
    READINGS,
    column_types,
    schema,
)


def names(ddl):
    return list(column_types(ddl))


def test_column_types_agree_with_the_parser(spark):
    for ddl in (READINGS, AUDIT_EVENTS, DISABLED_COHORTS, COHORT_TARGET, MACHINES, PRODUCT):
        assert names(ddl) == schema(ddl).names
    assert len(names(MACHINES)) == 54 and len(CHECKSUM_COLUMNS) == 18


@pytest.fixture
def readings(spark):
    data = [
        ("kiln/4.heat", 2, dt.datetime(2021, 3, 4, 6, 30), 71.5),
        ("kiln/4.heat", 2, dt.datetime(2021, 3, 4, 18, 0), 68.25),
        ("kiln/4.heat", 0, dt.datetime(2021, 3, 5), 12.0),
        ("fan", 1, dt.datetime(2021, 4, 1), 9.0),
        ("fan", 1, dt.datetime(2021, 3, 31, 23, 59, 59), 8.0),
        (None, 1, dt.datetime(2021, 3, 4), 1.0),
        ("belt", None, dt.datetime(2021, 3, 4), 1.0),
        ("oven", 1, None, 1.0),
    ]
    return spark.createDataFrame(data, READINGS)


def test_raw_series(readings):
    rows = raw_series(readings).collect()
    assert [(r.tag_id, r.data_quality, r.event_value, r.yyyymm) for r in rows] == [
        ("fan", 1, 9.0, "202104"),
        ("fan", 1, 8.0, "202103"),
        ("kiln/4.heat", 0, 12.0, "202103"),
        ("kiln/4.heat", 2, 68.25, "202103"),
        ("kiln/4.heat", 2, 71.5, "202103"),
        ("oven", 1, 1.0, None),
    ]
    assert sorted(raw_series(readings, sort=None).collect()) == sorted(
        raw_series(readings, sort="within").collect()
    )
    with pytest.raises(ValueError):
        raw_series(readings, sort="some")


def test_readings_audit(readings):
    found = {r.column_name: r.n_null for r in readings_audit(readings).collect()}
    assert found == {"tag_id": 1, "data_quality": 1, "event_time": 1, "event_value": 0}


def test_current_values(readings):
    out = current_values(readings.filter("tag_id <> 'oven'"))
    assert out.columns == ["tag_id", "event_time", "event_value", "asset_id"]
    rows = sorted((r.tag_id, r.event_value, r.asset_id) for r in out.collect())
    assert rows == [("fan", 9.0, "fan"), ("kiln/4.heat", 68.25, "kiln/4")]


def test_series_copies(spark):
    times = [
        "2012-12-31 23:59:59", "2013-01-01 00:00:00", "2015-12-31 23:59:59", "2016-01-01 00:00:00", None,
    ]
    series = spark.createDataFrame(
        [(tag, t, 1.0) for tag in ("a", "b", None) for t in times], "tag_id string, t string, v double"
    ).select("tag_id", F.col("t").cast("timestamp").alias("latest_time"), "v")
    tags = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "tag_id string")
    daily = daily_series(series, tags)
    assert daily.dtypes[-2:] == [("event_day", "bigint"), ("yyyy", "int")]
    assert sorted((r.tag_id, r.event_day, r.yyyy) for r in daily.collect()) == [
        ("a", 15706, 2013),
        ("a", 16800, 2015),
        ("a", 16801, 2016),
    ]
    hourly = hourly_series(series, tags, since="2016-01-01")
    assert [(r.tag_id, r.yyyymm) for r in hourly.collect()] == [("a", "201601")]


AUDIT_SOURCE = """suid string, eventtime timestamp, eventtype string, cartid string, gtoken string, city int,
    region int, country int, activeleid string, notifurl string, notif_audit_id string"""


def test_audit_events(spark):
    at = dt.datetime(2024, 1, 5, 1, 2, 3, 456789)
    source = spark.createDataFrame(
        [
            ("s1", at, "t", "c", "g", 1, 2, 3, "l", "u", "n"),
            ("s2", at, *[None] * 9),
            ("s3", None, *[None] * 9),
        ],
        AUDIT_SOURCE,
    )
    out = audit_events(source, "2024-02-01", 3)
    assert out.columns == [*names(AUDIT_EVENTS), "insert_date", "run_sequence"]
    assert [f.dataType for f in out.schema][:11] == [f.dataType for f in schema(AUDIT_EVENTS)]
    text = "2024-01-05 01:02:03.456"
    run = ("2024-02-01", "3")
    assert sorted(map(tuple, out.collect())) == [
        ("s1", text, "t", "c", "g", 1, 2, 3, "l", "u", "n", *run),
        ("s2", text, "", "", "", 0, 0, 0, "", "", "", *run),
        ("s3", None, "", "", "", 0, 0, 0, "", "", "", *run),
    ]
    inside = audit_events(source, "2024-02-01", low="2024-01-01", as_of="2024-01-10")
    assert sorted(r.suid for r in inside.collect()) == ["s1", "s2"]
    mark = mark_value(audit_mark(out))
    assert mark == 1704416523456
    assert audit_events(source, "2024-02-02", low=mark, as_of="2024-01-10").count() == 0
    assert mark_value(audit_mark(out.filter("suid = 's3'"))) is None
    with pytest.raises(ValueError):
        audit_events(source, "2024-02-01", low=mark)


COHORT_SOURCE = """suid string, serial_number string, cohort_id string, country_code string,
    country_name string, exploit_id array<string>, product_leid array<string>,
    is_binary_modified map<string,boolean>, non_genuine_leids array<string>,
    is_hostfile_modified boolean, is_deleted boolean, update_date timestamp,
    external_campaign string, targeting_process string, launch_date string, target_category string,
    target_detarget_reason string, inapp_checkout_enabled boolean, is_active_flag boolean"""


@pytest.fixture
def cohorts(spark):
    at = dt.datetime(2024, 1, 5)

    def row(suid, active=True, launch="2024-01-01"):
        return (suid, "n", "c1", "US", "Us", ["e"], None, {"b": True}, ["l"], None, True, at, None,
                "p", launch, "f", None, None, active)

    return spark.createDataFrame(
        [row("a"), row("b"), row("off", False), row("unset", None), row("test"), row(None)], COHORT_SOURCE
    )


def test_cohort_rows(cohorts):
    out = cohort_rows(cohorts, exclude=["test"])
    assert out.schema.simpleString() == schema(COHORT_TARGET).simpleString()
    found = {r.suid: r for r in out.collect()}
    assert set(found) == {"a", "b"}
    a = found["a"]
    assert (a.cohortid, a.exploitid, a.leids, a.binarymod) == ("c1", ["e"], None, {"b": True})
    assert (a.hostfilemod, a.isdeleted, a.inapp_checkout_enabled) == (False, True, False)
    assert (a.disabled, a.syncedtosophia, a.target_for_patching) == (False, False, False)
    assert (a.lastupdatetime, a.target_family) == (dt.datetime(2024, 1, 5), "f")
    assert a.checksum != found["b"].checksum and len(a.checksum) == 32
    assert {r.suid for r in cohort_rows(cohorts).collect()} == {"a", "b", "test", None}


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_cohort_changes(cohorts, conf, threshold):
    conf({"spark.sql.autoBroadcastJoinThreshold": threshold})

    def changes(source, target, exclude=()):
        return cohort_changes(source, target, exclude)

    target = cohort_rows(cohorts)
    assert [r.suid for r in changes(cohorts, target).collect()] == [None]
    moved = cohorts.withColumn(
        "launch_date", F.when(F.col("suid") == "b", "2030-01-01").otherwise(F.col("launch_date"))
    )
    assert {r.suid for r in changes(moved, target, ["test"]).collect()} == {"b"}
    both = changes(cohorts.unionAll(cohorts), target.limit(0), ["test"])
    assert both.columns == target.columns
    assert sorted(r.suid for r in both.collect()) == ["a", "a", "b", "b"]


def test_disabled_cohorts(spark):
    at = dt.datetime(2024, 1, 5)
    source = spark.createDataFrame(
        [
            ("a", "n", "c", None, ["l"], None, None, True, None, None, at),
            ("b", "n", "c", None, None, None, True, False, None, None, at),
            ("c", "n", "c", None, None, None, True, None, None, None, at),
        ],
        DISABLED_COHORTS,
    )
    out = disabled_cohorts(source, "2024-02-01")
    assert out.columns == [*names(DISABLED_COHORTS), "insert_date", "run_sequence"]
    assert list(map(tuple, out.collect())) == [
        ("a", "n", "c", None, ["l"], None, False, True, False, None, at, "2024-02-01", "1")
    ]


def machine_source_ddl():
    kinds = column_types(MACHINES)
    for name, part in (
        ("licenses", LICENSE), ("producthardeningappinfo", HARDENING), ("leids", PRODUCT), ("files", FILE),
        ("operatingconfigs", OPERATING_CONFIG),
    ):
        kinds[name] = f"map<string,struct<{part}>>"
    for out, source in MACHINE_SOURCES.items():
        kind = kinds.pop(out)
        if "." not in source:
            kinds[source] = kind
    kinds["clientupdateinfo"] = (
        "struct<agsservicestatus string, updatesuppressed boolean, "
        "lastupdaterequeststatus string, lastupdateattempted timestamp>"
    )
    return ", ".join(f"{name} {kind}" for name, kind in kinds.items())


@pytest.fixture
def machines(spark):
    kind = schema(machine_source_ddl())
    at = dt.datetime(2024, 1, 5)

    def nested(ddl, **values):
        return tuple(values.get(c) for c in names(ddl))

    file = nested(FILE, name="f")
    leids = {
        "with files": nested(PRODUCT, leid="1", files={"x": file}, nglapp=True),
        "with licenses": nested(PRODUCT, leid="2", files={}, licenses=["l"]),
        "empty": nested(PRODUCT, leid="3", files={}, licenses=[]),
        "null": nested(PRODUCT, leid="4"),
    }
    full = {
        "suid": "full", "machineid": "m", "leids": leids, "files": {"a": file}, "lastupdatecheck": at,
        "licenses": {"k": nested(LICENSE, serialnumber="n")}, "cartids": {"c": "g"}, "country": 4,
        "clientupdateinfo": ("up", None, "ok", at), "thorinstalled": True,
    }
    data = [
        full,
        {"suid": "idle", "machineid": "m"},
        {"suid": "no id", "lastupdatecheck": at},
        {"suid": "late", "machineid": "m", "lastrulefetched": dt.datetime(2024, 1, 9), "lastupdatecheck": at},
        {"suid": "early", "machineid": "m", "lastruleprocessed": dt.datetime(2023, 1, 9)},
    ]
    return spark.createDataFrame([tuple(d.get(c) for c in kind.names) for d in data], kind)


def test_machine_snapshot_shape(machines):
    out = machine_snapshot(machines, "2024-02-01")
    assert out.columns == [*names(MACHINES), "insert_date", "run_sequence"] and len(out.columns) == 56
    assert [f.dataType.simpleString() for f in out.schema][:54] == [
        f.dataType.simpleString() for f in schema(MACHINES)
    ]
    found = {r.suid: r for r in out.collect()}
    assert set(found) == {"full", "idle", "late", "early"}
    full, idle = found["full"], found["idle"]
    assert [(p.leid, p.nglapp) for p in full.leids] == [("1", True), ("2", False)]
    assert [f.name for f in full.files] == ["f"]
    assert [x.serialnumber for x in full.licenses] == ["n"]
    assert (full.allocatedgids, full.country, full.region, full.thorinstalled) == ({"c": "g"}, 4, 0, True)
    assert (full.agsservicestatus, full.updatesuppressed, full.lastupdaterequeststatus) == ("up", False, "ok")
    assert (idle.leids, idle.files, idle.licenses, idle.nglprofiles) == (None, None, None, None)
    assert (idle.agsservicestatus, idle.updatesuppressed, idle.country, idle.thorinstalled) == (
        None, False, 0, False,
    )


def test_machine_window_and_mark(machines):
    def exported(low, as_of):
        out = machine_snapshot(machines, "2024-02-01", low=low, as_of=as_of)
        return {r.suid for r in out.select("suid").collect()}

    assert exported("2024-01-01", "2024-01-10") == {"full"}
    assert exported(None, "2024-01-11") == {"full", "idle", "late", "early"}
    assert exported("1970-01-01", "2024-01-11") == {"full", "late", "early"}
    mark = mark_value(machine_mark(machine_snapshot(machines, "2024-02-01")))
    assert mark == 1704758400000
    assert exported(mark, "2024-02-01") == set()
