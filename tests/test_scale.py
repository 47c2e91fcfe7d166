"""What the plans must look like to hold at scale: scans, shuffles and hot keys."""

import pytest
from pyspark.sql import functions as F

from tableferry.operators import (
    between_marks,
    changed_rows,
    high_water,
    keep_keys,
    latest_per_key,
    membership_keys,
    null_audit,
    pick_rows,
    require,
    upsert,
)
from tableferry.plans import current_values, daily_series, raw_series
from tableferry.plans.machines import ACTIVITY_TIMES
from tableferry.sources import read_partitions, read_tree, write_partitions
from tableferry.sources.scratch import stored

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
SMALL_SKEW = {
    **NO_BROADCAST,
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A third of the rows of each table share one key."""
    root = tmp_path_factory.mktemp("tables")
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    facts = spark.range(300000).select(
        hot.alias("tag_id"),
        F.sha1(F.col("id").cast("string")).alias("payload"),
        (F.col("id") % 4).cast("int").alias("data_quality"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id")).alias("event_time"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id")).alias("latest_time"),
        F.col("id").cast("double").alias("event_value"),
        "id",
    )
    facts.repartition(10).write.parquet(f"{root}/facts")
    keys = spark.range(0, 90000).select(hot.alias("tag_id"), F.lit(1).alias("other"))
    keys.repartition(10).write.parquet(f"{root}/keys")
    return str(root)


@pytest.fixture
def facts(spark, tables):
    return spark.read.parquet(f"{tables}/facts")


@pytest.fixture
def keys(spark, tables):
    return spark.read.parquet(f"{tables}/keys")


def test_required_keys_reach_the_scan(facts, first_plan):
    plan = first_plan(require(facts.select("tag_id", "id"), ["tag_id"]))
    assert "IsNotNull(tag_id)" in plan and "ReadSchema: struct<tag_id:string,id:bigint>" in plan


def test_load_without_global_sort_has_no_shuffle(facts, first_plan):
    assert "Exchange" not in first_plan(raw_series(facts, sort=None))
    assert "Exchange" not in first_plan(raw_series(facts, sort="within"))
    assert first_plan(raw_series(facts, sort="global")).count("Exchange rangepartitioning") == 1


def test_null_audit_is_one_scan(facts, first_plan):
    plan = first_plan(null_audit(facts, facts.columns))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange SinglePartition") == 1


def test_window_reaches_the_scan(facts, first_plan):
    plan = first_plan(between_marks(facts, "event_time", "2023-11-20", "2023-11-30"))
    assert "GreaterThan(event_time" in plan and "LessThan(event_time" in plan and "cast(" not in plan


def test_window_over_several_times_reaches_the_scan(spark, tmp_path, conf, first_plan):
    conf({"spark.sql.maxMetadataStringLength": "10000"})
    cols = ", ".join(f"timestamp_seconds(id) AS {c}" for c in ACTIVITY_TIMES)
    spark.sql(f"SELECT id, {cols} FROM range(100)").write.parquet(str(tmp_path / "m"))
    machines = spark.read.parquet(str(tmp_path / "m"))
    plan = first_plan(between_marks(machines, ACTIVITY_TIMES, "2023-11-20", "2023-11-30"))
    pushed = plan[plan.index("PushedFilters") :]
    assert pushed.count("GreaterThan(") == 4 and pushed.count("LessThan(") == 4


def test_run_filter_skips_directories(spark, facts, tmp_path, first_plan):
    path = str(tmp_path / "p")
    write_partitions(facts.limit(50), path, ["data_quality"])
    back = read_partitions(spark, path, "id bigint, data_quality int")
    plan = first_plan(back.filter("data_quality = 2"))
    assert "PartitionFilters: [isnotnull(data_quality" in plan


def test_declared_columns_are_all_that_is_read(spark, tables, first_plan):
    plan = first_plan(read_tree(spark, f"{tables}/facts", "tag_id string"))
    assert "ReadSchema: struct<tag_id:string>" in plan


def test_latest_row_is_cut_before_the_shuffle(facts, first_plan):
    plan = first_plan(latest_per_key(facts, ["tag_id"], [("id", "desc")]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert plan.count("Exchange") == 1


def test_quality_filter_moves_below_the_window(facts, first_plan):
    plan = first_plan(current_values(facts, [("id", "asc")]))
    assert "Not(EqualTo(data_quality,0))" in plan


@pytest.mark.parametrize("unique", [True, False])
def test_hot_key_is_split_in_membership(spark, facts, keys, tmp_path, conf, final_plan, unique):
    conf(SMALL_SKEW)
    if unique:
        keys.dropDuplicates(["tag_id"]).write.parquet(str(tmp_path / "unique"))
        keys = spark.read.parquet(str(tmp_path / "unique"))
    kept = keep_keys(facts, keys, "tag_id", keys_unique=unique)
    assert "SortMergeJoin(skew=true)" in final_plan(kept)
    listed = {r.tag_id for r in keys.select("tag_id").distinct().collect()}
    assert kept.count() == facts.filter(F.col("tag_id").isin("hot")).count() + len(listed) - 1


def test_a_distinct_list_would_keep_the_hot_key_whole(facts, keys, conf, final_plan):
    conf(SMALL_SKEW)
    plan = final_plan(facts.join(keys.select("tag_id").distinct(), "tag_id", "left_semi"))
    assert "SortMergeJoin" in plan and "skew=true" not in plan


def test_hot_key_is_split_in_change_detection(facts, keys, conf, final_plan):
    conf(SMALL_SKEW)
    target = keys.filter("tag_id <> 'hot'")
    changed = changed_rows(facts, target, ["tag_id"])
    assert "SortMergeJoin(skew=true)" in final_plan(changed)
    assert changed.filter("tag_id = 'hot'").count() == 100000


def test_few_changes_move_no_wide_rows(facts, first_plan):
    few, _ = stored(facts.filter("id < 30").select("tag_id", "id"), "few")
    plan = first_plan(pick_rows(facts, few, ["tag_id", "id"]))
    assert "BroadcastHashJoin" in plan and "Exchange" not in plan.replace("BroadcastExchange", "")


def test_rows_without_a_key_are_split_in_change_detection(facts, keys, conf, final_plan):
    conf(SMALL_SKEW)
    unset = facts.withColumn("tag_id", F.expr("CASE WHEN tag_id <> 'hot' THEN tag_id END"))
    changed = changed_rows(unset, keys, ["tag_id"])
    assert "SortMergeJoin(skew=true)" in final_plan(changed)
    assert changed.filter("tag_id IS NULL").count() == 100000


def test_copies_of_a_key_do_not_cross_the_join(keys, conf):
    conf(NO_BROADCAST)
    assert membership_keys(keys, ["tag_id"]).filter("tag_id = 'hot'").count() <= 8


def test_small_key_list_moves_no_rows(facts, keys, first_plan):
    plan = first_plan(daily_series(facts, keys, since="2023-01-01"))
    assert "BroadcastHashJoin" in plan and "GreaterThanOrEqual(latest_time" in plan
    assert "Exchange" not in plan[: plan.index("BroadcastExchange")].replace("BroadcastExchange", "")


def test_upsert_of_a_large_batch_shuffles_the_rows_once(facts, conf, first_plan):
    conf(NO_BROADCAST)
    old = facts.select("id", "payload")
    new = facts.select("id", F.lit("x").alias("payload"), "event_time")
    plan = first_plan(upsert(old, new, ["id"], order_by=[("event_time", "desc")]))
    parts = [line for line in plan.split("\n") if "Exchange hashpartitioning(id" in line]
    # the table's rows, its keys, and the batch for each of the three joins (Spark reuses equal ones)
    assert len(parts) <= 5 and plan.count("ReadSchema: struct<id:bigint,payload:string>") <= 1 + plan.count("__new_payload")


def test_upsert_of_a_small_batch_does_not_shuffle_the_table(spark, facts, first_plan):
    old = facts.select("id", "payload")
    new = spark.createDataFrame([(i * 100000, "x") for i in range(50)], "id bigint, payload string")
    new, _ = stored(new, "batch")
    state = upsert(old, new, ["id"], new_unique=True)
    kept = first_plan(state).split("Union")[1]
    kept = kept[: kept.index("LeftAnti")]
    assert "BroadcastHashJoin" in kept and "SortMergeJoin" not in kept
    assert state.count() == 300000 + 47


def test_marks_are_aggregated_before_the_shuffle(facts, first_plan):
    plan = first_plan(high_water(facts, "event_time"))
    assert "partial_max" in plan and "ReadSchema: struct<event_time:timestamp>" in plan
