"""Change detection by range digests, and key filters in scans."""

import random

import pytest
from pyspark.sql import functions as F

from tableferry.operators import changed_rows, changed_rows_by_range, differing_ranges, key_filter, rows_with_keys, rows_without_keys
from tableferry.plans import daily_series

KV = "suid string, checksum string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some(seed, n=400):
    rng = random.Random(seed)
    src = [(rng.choice([None, *(f"s{i}" for i in range(150))]), rng.choice([None, "1", "2"])) for _ in range(n)]
    # most of it is equal; copies on either side, changed, missing and additional rows
    tgt = [r for r in src if rng.random() < 0.95] + src[:5] + [("only", "1")]
    return src, [(a, "9") if rng.random() < 0.02 else (a, b) for a, b in tgt]


@pytest.mark.parametrize("ranges", [1, 7, 1 << 14])
def test_same_rows_as_the_whole_join(spark, ranges):
    for seed in range(3):
        src, tgt = (spark.createDataFrame(part, KV) for part in some(seed))
        on = ["suid", "checksum"]
        assert rows(changed_rows_by_range(src, tgt, on, ["suid"], ranges)) == rows(changed_rows(src, tgt, on))


def test_copies_do_not_cancel_out(spark):
    """Two rows more, or two for two others, leave the xor as it was."""
    on = ["suid", "checksum"]
    src = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "2")], KV)
    for tgt, want in (
        ([("a", "1")], [("b", "2")] * 2),
        ([("a", "1"), ("c", "3"), ("c", "3")], [("b", "2")] * 2),
        ([("a", "1"), ("b", "2"), ("b", "2")], []),
        ([], [("a", "1"), ("b", "2"), ("b", "2")]),
    ):
        assert rows(changed_rows_by_range(src, spark.createDataFrame(tgt, KV), on, ["suid"], 1)) == want
    assert changed_rows_by_range(spark.createDataFrame([], KV), src, on, ["suid"]).count() == 0
    with pytest.raises(ValueError):
        changed_rows_by_range(src, src, ["suid"], ["checksum"])


def test_equal_tables_shuffle_digests_only(spark, conf, tmp_path):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    spark.range(20000).selectExpr("concat('s', id) AS suid", "md5(cast(id AS string)) AS checksum").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    on = ["suid", "checksum"]
    assert differing_ranges(table, table.orderBy("checksum"), on, ["suid"], 64).count() == 0
    plan = differing_ranges(table, table, on, ["suid"], 64)._jdf.queryExecution().executedPlan().toString()
    # every exchange is behind an aggregate by range, none is by id
    assert "hashpartitioning(suid" not in plan and "partial_bit_xor" in plan
    changed = table.withColumn("checksum", F.when(F.col("suid") == "s77", "x").otherwise(F.col("checksum")))
    assert differing_ranges(changed, table, on, ["suid"], 64).count() == 1
    assert rows(changed_rows_by_range(changed, table, on, ["suid"], 64)) == [("s77", "x")]


def test_key_filter_never_loses_a_key(spark):
    rng = random.Random(2)
    wanted = [(rng.choice([None, f"k{i}"]), rng.choice([None, i % 5])) for i in range(300)]
    data = wanted + [(f"o{i}", i % 7) for i in range(3000)]
    keys, df = spark.createDataFrame(wanted, "a string, b int"), spark.createDataFrame(data, "a string, b int")
    cols = [F.col("a"), F.col("b")]
    for bits in (1 << 24, 1 << 12, 64):
        kept = df.where(key_filter(keys, ["a", "b"], bits).may_hold(*cols))
        assert set(map(tuple, kept.collect())) >= set(wanted)
    # the last filter was full and let all pass; with room, few others do
    assert df.where(key_filter(keys, ["a", "b"]).may_hold(*cols)).count() <= len(wanted) + 30
    assert rows(rows_with_keys(df, cols, keys)) == sorted(wanted, key=repr)
    assert rows(rows_without_keys(df, cols, keys)) == rows(df.where(F.col("a").startswith("o")))


def test_key_filter_of_nothing(spark):
    keys, df = spark.createDataFrame([], "a string"), spark.createDataFrame([("x",), (None,)], "a string")
    assert rows_with_keys(df, [F.col("a")], keys).count() == 0
    assert rows(rows_without_keys(df, [F.col("a")], keys)) == [("x",), (None,)]
    assert rows_without_keys(df.limit(0), [F.col("a")], keys).count() == 0


def test_a_long_list_filters_the_scan(spark, conf, tmp_path, final_plan):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark.range(60000).selectExpr("concat('t', id % 20000) AS tag_id", "timestamp_seconds(1700000000 + id) AS latest_time").write.parquet(
        str(tmp_path / "s")
    )
    tags = spark.range(0, 40000, 40).selectExpr("concat('t', id) AS tag_id").union(spark.createDataFrame([(None,), ("t40",)], "tag_id string"))
    series = spark.read.parquet(str(tmp_path / "s"))
    plain, filtered = daily_series(series, tags), daily_series(series, tags, long_list=True)
    assert rows(plain) == rows(filtered) and filtered.count() == 1500
    # the join's left side gets about the rows it keeps
    kept = final_plan(filtered)
    scan = kept[: kept.index("BatchScan")] if "BatchScan" in kept else kept
    assert "getbit" in scan and "LeftSemi" in scan
