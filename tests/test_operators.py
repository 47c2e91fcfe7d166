import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tableferry.operators import (
    between_marks,
    changed_rows,
    conform,
    defaults,
    flatten_struct,
    high_water,
    keep_keys,
    key_list,
    latest_per_key,
    measured_bytes,
    membership_keys,
    null_audit,
    null_rows,
    project,
    require,
    run_audit,
    run_date,
    sort_for_load,
    stamp_run,
    union_all,
    upsert,
)
from tableferry.plans.schemas import schema


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


READINGS = "tag_id string, data_quality int, event_time timestamp, event_value double"


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
        ("oven", 1, None, float("nan")),
    ]
    return spark.createDataFrame(data, READINGS)


def test_null_audit(readings):
    assert rows(null_audit(readings, readings.columns)) == [
        ("data_quality", 8, 1),
        ("event_time", 8, 1),
        ("event_value", 8, 0),
        ("tag_id", 8, 1),
    ]


def test_null_audit_of_nothing(readings):
    assert rows(null_audit(readings.limit(0), ["tag_id"])) == [("tag_id", 0, 0)]


def test_null_rows_and_require(readings):
    assert [r.data_quality for r in null_rows(readings, "tag_id").collect()] == [1]
    assert require(readings, ["tag_id", "data_quality"]).count() == 6
    assert require(readings, ["event_value"]).count() == 8  # NaN is a value


def test_defaults_keep_types(spark):
    df = spark.sql("SELECT CAST(NULL AS string) s, CAST(NULL AS bigint) n, CAST(NULL AS boolean) b")
    out = defaults(df, {"s": "", "n": 0, "b": False})
    assert out.dtypes == df.dtypes
    assert rows(out) == [("", 0, False)]


def test_project(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS string) AS b, CAST(NULL AS int) AS c")
    out = project(df, [("x", "b", ""), ("y", F.col("a") + 1), ("z", "c"), ("w", "c", 0)])
    assert out.columns == ["x", "y", "z", "w"]
    assert rows(out) == [("", 2, None, 0)]


def test_conform(spark):
    df = spark.sql("""
        SELECT 'k' AS id, CAST(NULL AS int) AS n, CAST(NULL AS boolean) AS flag, CAST(NULL AS string) AS t,
          CAST(NULL AS bigint) AS big, map('p', named_struct('b', true, 'a', 1)) AS parts,
          CAST(NULL AS map<string,struct<b boolean, a int>>) AS none, named_struct('x', 'in') AS s, 1 AS unused""")
    target = schema(
        "flag boolean, id string, n int, t string, big bigint, parts array<struct<a int, b boolean>>, "
        "none array<struct<a int, b boolean>>, lifted string, renamed string, made string"
    )
    out = conform(
        df, target, sources={"lifted": "s.x", "renamed": "id"}, computed={"made": F.upper("id")}
    )
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        (f.name, f.dataType.simpleString()) for f in target
    ]
    row = out.first()
    assert (row.flag, row.id, row.n, row.t, row.big) == (False, "k", 0, None, None)
    assert [e.asDict() for e in row.parts] == [{"a": 1, "b": True}]
    assert (row.none, row.lifted, row.renamed, row.made) == (None, "in", "k", "K")


def test_flatten_struct(spark):
    df = spark.sql("""SELECT 1 AS id, named_struct('a', 'x', 'b', CAST(NULL AS boolean)) AS s
        UNION ALL SELECT 2, NULL UNION ALL SELECT 3, named_struct('a', NULL, 'b', true)""")
    out = flatten_struct(df, "s", ["a", "b"], {"b": False})
    assert out.columns == ["id", "a", "b"]
    assert rows(out) == [(1, "x", False), (2, None, False), (3, None, True)]


def test_union_all(spark):
    a, b = spark.sql("SELECT 1 AS x, 'p' AS y"), spark.sql("SELECT 'p' AS y, 1 AS x")
    assert rows(union_all([a, b, a])) == [(1, "p")] * 3
    assert rows(union_all([a, a], by_name=False)) == [(1, "p")] * 2


def test_latest_per_key(readings):
    kept = require(readings, ["tag_id", "data_quality", "event_time"])
    latest = latest_per_key(kept, ["tag_id", "data_quality"], [("event_time", "desc")])
    assert latest.columns == readings.columns
    assert [(r[0], r[1], r[3]) for r in rows(latest)] == [
        ("fan", 1, 9.0),
        ("kiln/4.heat", 0, 12.0),
        ("kiln/4.heat", 2, 68.25),
    ]


def test_latest_per_key_tie_break_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 3), ("a", 5, 2), (None, 1, 9), (None, 2, 8)], "k string, t int, id int"
    )
    latest = latest_per_key(df, ["k"], [("t", "desc"), ("id", "asc")])
    assert rows(latest) == [("a", 5, 2), (None, 2, 8)]
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], [("t", "down")])


def test_key_list_and_keep_keys(spark):
    tags = spark.createDataFrame([("a",), ("a",), (None,), ("c",), ("z",)], "tag_id string")
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (4, "c")], "v int, tag_id string")
    assert rows(key_list(tags, "tag_id")) == [("a",), ("c",), ("z",)]
    kept = keep_keys(df, tags, "tag_id")
    assert kept.columns == df.columns
    assert rows(kept) == [(1, "a"), (1, "a"), (4, "c")]
    assert rows(keep_keys(df, key_list(tags, "tag_id"), ["tag_id"], keys_unique=True)) == rows(kept)


def test_membership_keys_bound_copies(spark):
    df = spark.range(0, 30000, 1, 40).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")
    )
    counts = {r.k: r["count"] for r in membership_keys(df, ["k"]).groupBy("k").count().collect()}
    assert len(counts) == df.distinct().count()
    assert max(counts.values()) <= 8


CHANGES = [("a", 1), ("a", 1), ("b", 2), ("c", 3), (None, 4), ("d", 5)]
KNOWN = [("a", 1), ("a", 1), ("b", 9), ("c", None), (None, 4)]


@pytest.mark.parametrize("unique", [False, True])
def test_changed_rows(spark, unique):
    src = spark.createDataFrame(CHANGES, "suid string, checksum int").withColumn("v", F.lit(1))
    tgt = spark.createDataFrame(KNOWN, "suid string, checksum int").withColumn("w", F.lit(2))
    changed = changed_rows(src, tgt, ["suid", "checksum"], target_unique=unique)
    assert changed.columns == ["suid", "checksum", "v"]
    assert rows(changed) == [("b", 2, 1), ("c", 3, 1), ("d", 5, 1), (None, 4, 1)]


def test_changed_rows_equals_outer_join_form(spark):
    src = spark.createDataFrame(CHANGES, "suid string, checksum int")
    tgt = spark.createDataFrame(KNOWN, "suid string, checksum int")
    outer = src.join(tgt.withColumn("hit", F.lit(1)), ["suid", "checksum"], "left_outer")
    assert rows(changed_rows(src, tgt, ["suid", "checksum"])) == rows(
        outer.filter("hit IS NULL").drop("hit")
    )


OLD = [("a", 1, "x"), ("b", 2, "y"), ("c", None, None)]
NEW = [("a", None, "new"), ("c", 3, None), ("d", None, "d")]
KV = "k string, n int, s string"


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_upsert_checks_a_declared_uniqueness(spark, conf, threshold):
    conf({"spark.sql.autoBroadcastJoinThreshold": threshold})
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="repeat a key"):
        upsert(old, new, ["k"], new_unique=True).collect()


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_upsert_by_hand(spark, conf, threshold):
    conf({"spark.sql.autoBroadcastJoinThreshold": threshold})
    old, new = spark.createDataFrame(OLD, KV), spark.createDataFrame(NEW, KV)
    state = upsert(old, new, ["k"], new_unique=True)
    assert state.columns == ["k", "n", "s"]
    assert rows(state) == [("a", 1, "new"), ("b", 2, "y"), ("c", 3, None), ("d", None, "d")]
    whole = upsert(old, new, ["k"], new_unique=True, ignore_nulls=False)
    assert rows(whole) == [("a", None, "new"), ("b", 2, "y"), ("c", 3, None), ("d", None, "d")]


def test_upsert_takes_the_newest_value_of_each_column(spark):
    old = spark.createDataFrame(OLD, KV)
    new = spark.createDataFrame([("a", 5, "first", 1), ("a", None, "last", 2)], KV + ", batch int")
    state = upsert(old, new, ["k"], order_by=[("batch", "desc")])
    assert rows(state)[0] == ("a", 5, "last")
    with pytest.raises(ValueError):
        upsert(old, new, ["k"])


def test_upsert_missing_column_counts_as_null(spark):
    old, new = spark.createDataFrame(OLD, KV), spark.createDataFrame([("a", 9)], "k string, n bigint")
    state = upsert(old, new, ["k"], new_unique=True)
    assert state.dtypes == old.dtypes
    assert rows(state)[0] == ("a", 9, "x")


def test_upsert_refuses_null_keys(spark, conf):
    old, new = spark.createDataFrame(OLD, KV), spark.createDataFrame([(None, 9, "x")], KV)
    for threshold in ("-1", "10m"):
        conf({"spark.sql.autoBroadcastJoinThreshold": threshold})
        # a failure inside a broadcast comes wrapped
        with pytest.raises(Exception, match="null in key column k"):
            upsert(old, new, ["k"], new_unique=True).collect()


def test_upsert_is_idempotent_and_matches_brute_force(spark, conf):
    rng = random.Random(5)

    def some(n, batches):
        return [
            (
                rng.randrange(60),
                rng.choice(["p", "q"]),
                rng.choice([None, rng.randrange(9)]),
                rng.choice([None, "s", "t"]),
                i if batches else 0,
            )
            for i in range(n)
        ]

    ddl = "a int, b string, n int, s string, batch int"
    old_rows = list({(r[0], r[1]): r for r in some(80, False)}.values())
    new_rows = some(150, True)
    state = {(a, b): [n, s] for a, b, n, s, _ in old_rows}
    for a, b, n, s, _ in new_rows:
        have = state.setdefault((a, b), [None, None])
        state[a, b] = [have[0] if n is None else n, have[1] if s is None else s]
    expected = sorted([(a, b, n, s) for (a, b), (n, s) in state.items()], key=repr)

    old = spark.createDataFrame(old_rows, ddl).drop("batch")
    new = spark.createDataFrame(new_rows, ddl).repartition(5, "n")
    order = [("batch", "desc")]
    for threshold in ("-1", "10m"):
        conf({"spark.sql.autoBroadcastJoinThreshold": threshold})
        once = upsert(old, new, ["a", "b"], order_by=order)
        assert rows(once) == expected
        assert rows(upsert(once, new, ["a", "b"], order_by=order)) == expected


def test_measured_bytes(spark):
    df = spark.sql("SELECT 'abc' AS s, 1 AS n, array('x') AS a UNION ALL SELECT NULL, NULL, NULL")
    assert measured_bytes(df) == (3 + 8) + 8 + (5 + 8) + 3 * 8
    assert measured_bytes(df.limit(0)) == 0


def test_sort_for_load_order(spark, tmp_path):
    df = spark.range(0, 5000, 1, 7).select(
        (F.col("id") % 3).alias("k"), (F.col("id") * 37 % 1000).alias("t"), "id"
    )
    order = [("k", "asc"), ("t", "desc"), ("id", "asc")]
    got = [tuple(r) for r in sort_for_load(df, order).collect()]
    assert got == sorted(got, key=lambda r: (r[0], -r[1], r[2])) and len(got) == 5000
    within = sort_for_load(df, order, global_=False)
    parts = within.withColumn("p", F.spark_partition_id()).collect()
    for p in {r.p for r in parts}:
        mine = [(r.k, r.t, r.id) for r in parts if r.p == p]
        assert mine == sorted(mine, key=lambda r: (r[0], -r[1], r[2]))


def test_high_water(spark):
    texts = spark.createDataFrame(
        [("2024-01-02 03:04:05.678",), ("2024-01-01 00:00:00.000",), ("junk",), (None,)], "t string"
    )
    mark = high_water(texts, "t", "yyyy-MM-dd HH:mm:ss.SSS").first()
    assert mark.max_time_ms == 1704164645678
    assert tuple(high_water(texts.limit(0), "t", "yyyy-MM-dd").first()) == (None, None)
    assert tuple(high_water(texts.filter("t = 'junk'"), "t", "yyyy-MM-dd").first()) == (None, None)


def test_high_water_over_columns(spark):
    df = spark.sql("""SELECT timestamp'2024-01-01' AS a, CAST(NULL AS timestamp) AS b, timestamp'2023-01-01' AS c
        UNION ALL SELECT timestamp'2022-01-01', NULL, timestamp'2024-06-01'""")
    assert high_water(df, ["a", "b", "c"]).first().max_time_ms == 1717200000000
    assert high_water(df, ["b", "b"]).first().max_time_ms is None


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_window_ends_are_open(spark, kind):
    times = ["2024-01-01 00:00:00", "2024-01-01 00:00:00.001", "2024-01-08 23:59:59.999", "2024-01-09 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast(kind))
    kept = between_marks(df, "t", "2024-01-01", "2024-01-10").select(F.col("t").cast("string"))
    assert [r[0] for r in kept.collect()] == times[1:3]
    assert between_marks(df, "t", None, "2024-01-10").count() == 3
    assert between_marks(df, "t", None, "2024-01-10", lag="0 hours").count() == 4


def test_millisecond_mark_covers_its_millisecond(spark):
    df = spark.sql("""SELECT * FROM VALUES (timestamp'2024-01-01 00:00:00.123456'),
        (timestamp'2024-01-01 00:00:00.124') AS t(t)""")
    mark = high_water(df.limit(1), "t").first().max_time_ms
    assert between_marks(df, "t", mark, "2024-02-01").count() == 1


def test_window_over_newest_matches_brute_force(spark):
    rng = random.Random(3)
    epoch = dt.datetime(1970, 1, 1)
    day = dt.timedelta(days=1)

    def some():
        return rng.choice([None, epoch + rng.randrange(-4, 9) * day])

    data = [(i, some(), some(), some()) for i in range(400)]
    df = spark.createDataFrame(data, "id int, a timestamp_ntz, b timestamp_ntz, c timestamp_ntz")
    for low in (None, epoch - 2 * day, epoch, epoch + 3 * day):
        for as_of in (epoch, epoch + 2 * day, epoch + 6 * day):
            newest = {r[0]: max(x or epoch for x in r[1:]) for r in data}
            expected = [
                i for i, t in newest.items() if (low is None or low < t) and t < as_of - day
            ]
            got = between_marks(df, ["a", "b", "c"], low, as_of).select("id").collect()
            assert sorted(r[0] for r in got) == expected


def test_run_columns(spark):
    df = stamp_run(spark.range(3), dt.date(2024, 2, 1), 2)
    assert df.dtypes[1:] == [("insert_date", "string"), ("run_sequence", "string")]
    assert rows(run_audit(df, "t", "d")) == [("t", "d", "2024-02-01", "2", 3)]
    assert run_date(dt.datetime(2024, 2, 1, 5)) == "2024-02-01"
    with pytest.raises(ValueError):
        run_date("01.02.2024")


def test_window_leaves_no_row_inside_the_cut_offs_millisecond(spark):
    """Three runs over rows microseconds apart give every row once."""
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    times = [at + dt.timedelta(microseconds=m) for m in (123456, 123756, 124056, 125001)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, t timestamp_ntz")
    low, seen = None, []
    for cut in (123500, 124900, 900000):
        found = between_marks(df, "t", low, at + dt.timedelta(days=1, microseconds=cut))
        seen += [r["id"] for r in found.collect()]
        low = high_water(found, "t").first()["max_time_ms"] or low
    assert sorted(seen) == [0, 1, 2, 3]


def test_flatten_struct_refuses_a_clash(spark):
    df = spark.sql("SELECT 1 AS a, struct(2 AS a, 3 AS b) AS s")
    with pytest.raises(ValueError, match="named like columns"):
        flatten_struct(df, "s", ["a", "b"])
