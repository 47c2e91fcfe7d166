"""The registered queries. Each reads whole tables and carries its SQL counterpart."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, TimestampType

from tableferry.functions import (
    epoch_day,
    format_ms,
    newest_of,
    prefix,
    reshape,
    row_checksum,
    time_literal,
    year_month,
    year_of,
)
from tableferry.operators import (
    between_marks,
    changed_rows,
    changed_rows_by_range,
    defaults,
    flatten_struct,
    keep_keys,
    key_list,
    latest_per_key,
    null_rows,
    require,
    run_audit,
    sort_for_load,
    union_all,
    upsert,
)
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
    newest_audit,
    newest_machines,
    raw_series,
    readings_audit,
    staged_series,
)
from tableferry.plans.cohorts import CHECKSUM_COLUMNS, FALSE_FLAGS, TARGET_SOURCES
from tableferry.plans.machines import ACTIVITY_TIMES, MACHINE_SOURCES, products_in_use
from tableferry.plans.schemas import COHORT_TARGET, DISABLED_COHORTS, MACHINES, column_types
from tableferry.sources import (
    AUDIT_SCHEMA,
    MARKED_AUDIT_SCHEMA,
    export_run,
    last_mark,
    merge_partitions,
    read_partitions,
    read_runs,
    read_table,
    read_tree,
    scratch_path,
    stage,
    write_partitions,
    write_run,
    write_table,
    write_tree,
)

from . import adapters as A

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name or fn.__name__] = in_utc
        ORACLES[name or fn.__name__] = sql
        return fn

    return register


def cte(name: str, columns: dict[str, str], table: str) -> str:
    return f"{name} AS (\nSELECT {A.select_list(columns)}\nFROM {table})"


JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text and timestamps without zone, so that engines can be compared."""
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            c = F.to_json(c, JSON_OPTIONS)
        elif isinstance(field.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(field.name))
    return df.select(*out)


def is_nested(kind: str) -> bool:
    return kind.startswith(("array", "map", "struct"))


def flat_sql(columns: dict[str, str], texts: dict[str, str]) -> str:
    """Select list over columns: nested ones as JSON text, null where the value is null."""
    out = []
    for name, kind in columns.items():
        text = texts.get(name, name)
        if is_nested(kind):
            text = f"CASE WHEN {text} IS NOT NULL THEN CAST(to_json({text}) AS varchar) END"
        out.append(f"{text} AS {name}")
    return ",\n  ".join(out)


# --- scans and sinks -----------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, CAST(NULL AS varchar) AS absent FROM lineitem")
def tree_scan(spark, sf_dir):
    """Recursive scan, four declared columns of eleven and one the files lack."""
    declared = "l_orderkey bigint, l_linenumber int, l_shipdate timestamp_ntz, l_quantity double, absent string"
    return read_tree(spark, f"{sf_dir}/lineitem.parquet", declared)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def table_scan(spark, sf_dir):
    """A connector table by format and options."""
    orders = read_table(spark, "parquet", {"path": f"{sf_dir}/orders.parquet"})
    return orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def session_scan(spark, sf_dir):
    """A table whose place the session's settings name; the read is given nothing but the format."""
    name = "spark.datasource.parquet.path"
    spark.conf.set(name, f"{sf_dir}/orders.parquet")
    try:
        orders = read_table(spark, "parquet")
    finally:
        spark.conf.unset(name)
    return orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT c_mktsegment, count(*) AS n_rows FROM customer GROUP BY c_mktsegment")
def catalog_scan(spark, sf_dir):
    """A table by catalog name."""
    A.table(spark, sf_dir, "customer").createOrReplaceTempView("ferry_customer")
    customer = read_table(spark, "table", {"name": "ferry_customer"})
    return customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_rows"))


UNION_PARTS = f"""
SELECT {A.select_list({k: v for k, v in A.READINGS.items() if k != "event_id"})} FROM events
UNION ALL
SELECT concat('o', CAST(o_custkey AS varchar), '.price'), 1, o_orderdate, o_totalprice FROM orders
UNION ALL
SELECT concat('l', CAST(l_suppkey AS varchar), '.quantity'), 1, l_shipdate, l_quantity FROM lineitem
UNION ALL
SELECT concat('l', CAST(l_suppkey AS varchar), '.price'), 3, l_shipdate, l_extendedprice FROM lineitem
"""


def union_parts(spark, sf_dir):
    events = A.derive(spark, sf_dir, "events", A.READINGS).drop("event_id")
    orders = A.table(spark, sf_dir, "orders").select(
        F.col("o_totalprice").alias("event_value"),
        F.col("o_orderdate").alias("event_time"),
        F.concat(F.lit("o"), F.col("o_custkey").cast("string"), F.lit(".price")).alias("tag_id"),
        F.lit(1).alias("data_quality"),
    )
    lineitem = A.table(spark, sf_dir, "lineitem")

    def measure(name, column, quality):
        tag = F.concat(F.lit("l"), F.col("l_suppkey").cast("string"), F.lit(f".{name}"))
        return lineitem.select(
            tag.alias("tag_id"),
            F.lit(quality).alias("data_quality"),
            F.col("l_shipdate").alias("event_time"),
            F.col(column).alias("event_value"),
        )

    return [events, orders, measure("quantity", "l_quantity", 1), measure("price", "l_extendedprice", 3)]


@query(UNION_PARTS, name="union_all")
def union_tables(spark, sf_dir):
    """All rows of four tables, matched by name."""
    return union_all(union_parts(spark, sf_dir))


@query("SELECT o_orderkey AS key, o_orderstatus AS label FROM orders UNION ALL SELECT s_suppkey, s_name FROM supplier")
def union_by_position(spark, sf_dir):
    """Union of tables whose columns have other names: the first one's hold."""
    orders = A.table(spark, sf_dir, "orders").selectExpr("o_orderkey AS key", "o_orderstatus AS label")
    return union_all([orders, A.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")], by_name=False)


@query(UNION_PARTS, name="seed_readback")
def tree_roundtrip(spark, sf_dir):
    """The four tables united, written as a new tree, and read back with a declared schema."""
    path = scratch_path(spark, "tree")
    write_tree(union_all(union_parts(spark, sf_dir)), path)
    declared = "tag_id string, data_quality int, event_time timestamp_ntz, event_value double"
    return read_tree(spark, path, declared)


@query("SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT s_suppkey, s_name FROM supplier")
def table_append(spark, sf_dir):
    """Two appends to a connector table, read back."""
    options = {"path": scratch_path(spark, "append")}
    orders = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    suppliers = A.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    write_table(orders, "parquet", options)
    write_table(suppliers.toDF(*orders.columns), "parquet", options)
    return read_table(spark, "parquet", options)


@query(
    """
SELECT event_id, user_id, event_type,
  CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value * 2 ELSE value END AS value,
  strftime(ts, '%Y-%m-%d') AS insert_date, '1' AS run_sequence
FROM events
"""
)
def partition_rerun(spark, sf_dir):
    """A run-partitioned write; a second write replaces exactly the partitions it has rows for."""
    path = scratch_path(spark, "runs")
    events = A.table(spark, sf_dir, "events")
    stamped = events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.date_format("ts", "yyyy-MM-dd").alias("insert_date"),
        F.lit("1").alias("run_sequence"),
    )
    write_partitions(stamped, path)
    later = stamped.filter(F.col("insert_date") >= "2024-01-15")
    write_partitions(later.withColumn("value", F.col("value") * 2), path)
    return read_partitions(spark, path, stamped.schema)


@query(
    """
SELECT 'events' AS table_name, 'main' AS database_name, strftime(ts, '%Y-%m-%d') AS insert_date,
  event_type AS run_sequence, count(*) AS n_rows
FROM events GROUP BY ALL
"""
)
def audit_rows(spark, sf_dir):
    """Rows per run of a stamped table."""
    events = A.table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("insert_date"),
        F.col("event_type").alias("run_sequence"),
    )
    return run_audit(events, "events", "main")


@query(
    """
SELECT 'orders' AS table_name, 'main' AS database_name, '2024-02-01' AS insert_date,
  '1' AS run_sequence, (SELECT count(*) FROM orders) AS n_rows
UNION ALL
SELECT 'lineitem', 'main', '2024-02-01', '1', (SELECT count(*) FROM lineitem)
"""
)
def run_metadata(spark, sf_dir):
    """Two exports with their audit lines, the first one rerun; the counts are taken during the writes."""
    path, audit = scratch_path(spark, "export"), scratch_path(spark, "audit")
    orders, lineitem = (A.table(spark, sf_dir, name) for name in ("orders", "lineitem"))
    for name, df in (("orders", orders.filter("o_orderstatus <> 'P'")), ("orders", orders), ("lineitem", lineitem)):
        export_run(df, f"{path}/{name}", name, "main", "2024-02-01", "1", audit_path=audit)
    return read_tree(spark, audit, AUDIT_SCHEMA)


# --- nulls, defaults, projections ----------------------------------------------------------

READINGS_CTE = cte("readings", A.READINGS, "events")
NULL_COLUMNS = ["tag_id", "data_quality", "event_time", "event_value", "event_id"]


@query(
    f"WITH {READINGS_CTE}\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null FROM readings"
        for c in NULL_COLUMNS
    ),
    name="null_audit",
)
def null_counts(spark, sf_dir):
    """Null audit of every column in one pass."""
    return readings_audit(A.derive(spark, sf_dir, "events", A.READINGS))


@query(f"WITH {READINGS_CTE} SELECT * FROM readings WHERE data_quality IS NULL")
def null_quality_rows(spark, sf_dir):
    return null_rows(A.derive(spark, sf_dir, "events", A.READINGS), "data_quality")


@query(f"WITH {READINGS_CTE} SELECT * FROM readings WHERE tag_id IS NOT NULL AND data_quality IS NOT NULL")
def required_keys(spark, sf_dir):
    return require(A.derive(spark, sf_dir, "events", A.READINGS), ["tag_id", "data_quality"])


AUDIT_CTE = cte("audit", A.AUDIT, "events")


@query(
    f"""WITH {AUDIT_CTE}
SELECT suid, eventtime, coalesce(eventtype, '') AS eventtype, cartid, gtoken,
  coalesce(city, 0) AS city, coalesce(region, -1) AS region, country, activeleid, notifurl,
  coalesce(notif_audit_id, 'none') AS notif_audit_id
FROM audit"""
)
def null_defaults(spark, sf_dir):
    values = {"eventtype": "", "city": 0, "region": -1, "notif_audit_id": "none"}
    return defaults(A.derive(spark, sf_dir, "events", A.AUDIT), values)


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y%m') AS yyyymm,
  CAST(floor(epoch(l_shipdate) / 86400) AS bigint) AS event_day,
  CAST(year(l_shipdate) AS integer) AS yyyy,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%g') AS shipped
FROM lineitem
"""
)
def time_buckets(spark, sf_dir):
    """Month bucket, epoch day, year and text form of a time."""
    return A.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        year_month("l_shipdate").alias("yyyymm"),
        epoch_day("l_shipdate").alias("event_day"),
        year_of("l_shipdate").alias("yyyy"),
        format_ms("l_shipdate").alias("shipped"),
    )


@query(f"WITH {READINGS_CTE} SELECT event_id, tag_id, split_part(tag_id, '.', 1) AS asset_id, "
       "split_part(props, ':', 1) AS props_head FROM readings JOIN events USING (event_id)")  # fmt: skip
def tag_prefix(spark, sf_dir):
    """Prefix before the first separator; null stays null."""
    columns = {"event_id": "event_id", "tag_id": A.READINGS["tag_id"], "props": "props"}
    events = A.derive(spark, sf_dir, "events", columns)
    return events.select(
        "event_id", "tag_id", prefix("tag_id").alias("asset_id"), prefix("props", ":").alias("props_head")
    )


# --- time series ---------------------------------------------------------------------------


@query(
    f"""WITH {READINGS_CTE}
SELECT *, strftime(event_time, '%Y%m') AS yyyymm FROM readings
WHERE tag_id IS NOT NULL AND data_quality IS NOT NULL"""
)
def ts_load(spark, sf_dir):
    """Raw readings ready to load: keys present, sorted inside each write task, month bucket."""
    return raw_series(A.derive(spark, sf_dir, "events", A.READINGS), sort="within")


@query(
    f"""WITH {READINGS_CTE}
SELECT *, strftime(event_time, '%Y%m') AS yyyymm FROM readings
WHERE tag_id IS NOT NULL AND data_quality IS NOT NULL"""
)
def ts_load_sorted(spark, sf_dir):
    """The same load in one global order."""
    readings = A.derive(spark, sf_dir, "events", A.READINGS)
    return raw_series(readings, sort="global", tie_break=[("event_id", "asc")])


@query(
    f"""WITH {READINGS_CTE}
SELECT *, strftime(event_time, '%Y%m') AS yyyymm FROM readings
WHERE tag_id IS NOT NULL AND data_quality IS NOT NULL"""
)
def ts_load_staged(spark, sf_dir):
    """The same load after one scan of its source: the stored rows are sampled for the order."""
    staged, _, _ = staged_series(A.derive(spark, sf_dir, "events", A.READINGS))
    return raw_series(staged, sort="global", tie_break=[("event_id", "asc")])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem")
def sorted_load(spark, sf_dir):
    """Global sort before a load."""
    lineitem = A.table(spark, sf_dir, "lineitem")
    order = [("l_orderkey", "asc"), ("l_shipdate", "desc"), ("l_linenumber", "asc"), ("l_partkey", "asc")]
    return sort_for_load(lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"), order)


@query(
    f"""WITH {READINGS_CTE}, ranked AS (
SELECT *, row_number() OVER (PARTITION BY tag_id, data_quality ORDER BY event_time DESC, event_id) AS rn
FROM readings WHERE tag_id IS NOT NULL AND data_quality IS NOT NULL)
SELECT tag_id, event_time, event_value, event_id, split_part(tag_id, '.', 1) AS asset_id
FROM ranked WHERE rn = 1 AND data_quality <> 0"""
)
def current_value(spark, sf_dir):
    """Newest reading per tag and quality, quality 0 left out."""
    readings = A.derive(spark, sf_dir, "events", A.READINGS)
    return current_values(readings, tie_break=[("event_id", "asc")])


@query(
    """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
  FROM orders) WHERE rn = 1
"""
)
def latest_order(spark, sf_dir):
    """Latest row per key."""
    orders = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return latest_per_key(orders, ["o_custkey"], [("o_orderdate", "desc"), ("o_orderkey", "asc")])


@query(f"WITH {READINGS_CTE} SELECT DISTINCT tag_id FROM readings WHERE tag_id IS NOT NULL", name="key_list")
def tag_list(spark, sf_dir):
    return key_list(A.derive(spark, sf_dir, "events", A.READINGS), "tag_id")


@query(
    f"""WITH {cte("daily", A.DAILY, "lineitem")}, {cte("tags", A.DAILY_TAGS, "orders")}
SELECT *, CAST(floor(epoch(latest_time) / 86400) AS bigint) AS event_day,
  CAST(year(latest_time) AS integer) AS yyyy
FROM daily SEMI JOIN tags USING (tag_id) WHERE latest_time >= TIMESTAMP '1997-01-01'"""
)
def daily_by_keys(spark, sf_dir):
    """Daily series of the listed tags since a date."""
    daily = A.derive(spark, sf_dir, "lineitem", A.DAILY)
    return daily_series(daily, A.derive(spark, sf_dir, "orders", A.DAILY_TAGS), since="1997-01-01 00:00")


@query(
    f"""WITH {cte("daily", A.DAILY, "lineitem")}, {cte("tags", A.DAILY_TAGS, "orders")}
SELECT *, CAST(floor(epoch(latest_time) / 86400) AS bigint) AS event_day,
  CAST(year(latest_time) AS integer) AS yyyy
FROM daily SEMI JOIN tags USING (tag_id) WHERE latest_time >= TIMESTAMP '1997-01-01'"""
)
def daily_by_long_list(spark, sf_dir):
    """The same copy by a list too long to broadcast: a filter made of it goes into the scan of the series."""
    daily = A.derive(spark, sf_dir, "lineitem", A.DAILY)
    tags = A.derive(spark, sf_dir, "orders", A.DAILY_TAGS)
    return daily_series(daily, tags, since="1997-01-01 00:00", long_list=True)


@query(
    f"""WITH {cte("hourly", A.HOURLY, "events")}, {cte("tags", A.HOURLY_TAGS, "orders")}
SELECT *, strftime(latest_time, '%Y%m') AS yyyymm
FROM hourly SEMI JOIN tags USING (tag_id) WHERE latest_time >= TIMESTAMP '2013-01-01'"""
)
def hourly_by_keys(spark, sf_dir):
    """Hourly series of the listed tags; the list repeats tags and holds nulls."""
    hourly = A.derive(spark, sf_dir, "events", A.HOURLY)
    return hourly_series(hourly, A.derive(spark, sf_dir, "orders", A.HOURLY_TAGS))


@query(
    """
SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)
"""
)
def unique_keys_kept(spark, sf_dir):
    """Membership in a list that holds each key once."""
    suppliers = A.table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 5000)
    wanted = suppliers.select(F.col("s_suppkey").alias("l_suppkey"))
    lineitem = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    return keep_keys(lineitem, wanted, "l_suppkey", keys_unique=True)


# --- upserts -------------------------------------------------------------------------------

# Batches over customers: one gives new balances to a segment (null for negative ones), a later
# one moves rich customers to a nation and leaves the balance out, one adds suppliers as customers.
BATCHES = """
SELECT c_custkey, CAST(NULL AS varchar) AS c_name, CAST(NULL AS int) AS c_nationkey,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal + 1 END AS c_acctbal, c_mktsegment, 1 AS batch
FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT c_custkey, upper(c_name), 7, CAST(NULL AS double), CAST(NULL AS varchar), 2
FROM customer WHERE c_acctbal > 5000
UNION ALL
SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER', 1 FROM supplier
"""
NEWEST_BATCH = f"""batches AS ({BATCHES}), newest AS (
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY batch DESC) AS rn FROM batches)
WHERE rn = 1)"""

NEWEST_VALUES = f"""batches AS ({BATCHES}), newest AS (
SELECT c_custkey, arg_max(c_name, batch) FILTER (c_name IS NOT NULL) AS c_name,
  arg_max(c_nationkey, batch) FILTER (c_nationkey IS NOT NULL) AS c_nationkey,
  arg_max(c_acctbal, batch) FILTER (c_acctbal IS NOT NULL) AS c_acctbal,
  arg_max(c_mktsegment, batch) FILTER (c_mktsegment IS NOT NULL) AS c_mktsegment
FROM batches GROUP BY c_custkey)"""

UPSERT_SQL = f"""WITH {NEWEST_VALUES}
SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, coalesce(n.c_name, o.c_name) AS c_name,
  coalesce(n.c_nationkey, o.c_nationkey) AS c_nationkey, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal,
  coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment
FROM customer o FULL OUTER JOIN newest n ON o.c_custkey = n.c_custkey"""


def customer_batches(spark, sf_dir):
    customer, supplier = A.table(spark, sf_dir, "customer"), A.table(spark, sf_dir, "supplier")
    balances = customer.filter("c_mktsegment = 'BUILDING'").selectExpr(
        "c_custkey",
        "CAST(NULL AS string) AS c_name",
        "CAST(NULL AS int) AS c_nationkey",
        "CASE WHEN c_acctbal >= 0 THEN c_acctbal + 1 END AS c_acctbal",
        "c_mktsegment",
        "1 AS batch",
    )
    moves = customer.filter("c_acctbal > 5000").selectExpr(
        "c_custkey",
        "upper(c_name) AS c_name",
        "7 AS c_nationkey",
        "CAST(NULL AS double) AS c_acctbal",
        "CAST(NULL AS string) AS c_mktsegment",
        "2 AS batch",
    )
    added = supplier.selectExpr(
        "-1 - s_suppkey AS c_custkey",
        "s_name AS c_name",
        "s_nationkey AS c_nationkey",
        "s_acctbal AS c_acctbal",
        "'SUPPLIER' AS c_mktsegment",
        "1 AS batch",
    )
    return customer, union_all([balances, moves, added])


@query(UPSERT_SQL)
def upsert_ignore_nulls(spark, sf_dir):
    """Nulls of the new row leave the old value; the newest batch of a key wins."""
    old, new = customer_batches(spark, sf_dir)
    return upsert(old, new, ["c_custkey"], order_by=[("batch", "desc")])


@query(UPSERT_SQL)
def upsert_broadcast(spark, sf_dir):
    """The same upsert of a stored batch, whose size Spark knows: it decides on the broadcast."""
    old, new = customer_batches(spark, sf_dir)
    new, _ = stage(new, "batch")
    return upsert(old, new, ["c_custkey"], order_by=[("batch", "desc")])


@query(
    f"""WITH {NEWEST_BATCH}
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM newest
UNION ALL
SELECT * FROM customer ANTI JOIN newest USING (c_custkey)"""
)
def upsert_replace(spark, sf_dir):
    """The new row replaces the old one whole."""
    old, new = customer_batches(spark, sf_dir)
    return upsert(old, new, ["c_custkey"], order_by=[("batch", "desc")], ignore_nulls=False)


@query(
    f"""WITH {READINGS_CTE}, loaded AS (
SELECT *, strftime(event_time, '%Y%m') AS yyyymm FROM readings
WHERE tag_id IS NOT NULL AND data_quality IS NOT NULL)
SELECT tag_id, event_id, event_time, yyyymm,
  CASE WHEN event_value > 20 THEN 3 ELSE data_quality END AS data_quality,
  CASE WHEN event_value > 20 AND event_value <= 60 THEN -event_value ELSE event_value END AS event_value
FROM loaded
UNION ALL
SELECT concat('late.', tag_id), event_id, event_time + INTERVAL 40 DAY,
  strftime(event_time + INTERVAL 40 DAY, '%Y%m'), data_quality, event_value
FROM loaded"""
)
def ts_merge(spark, sf_dir):
    """Readings merged into a month-partitioned table: corrections (null keeps the value) and late rows."""
    path = scratch_path(spark, "series")
    columns = ["tag_id", "event_id", "event_time", "data_quality", "event_value", "yyyymm"]
    loaded = raw_series(A.derive(spark, sf_dir, "events", A.READINGS), sort=None).select(*columns)
    write_partitions(loaded, path, ["yyyymm"])
    corrections = loaded.filter("event_value > 20").withColumns(
        {
            "data_quality": F.lit(3),
            "event_value": F.expr("CASE WHEN event_value <= 60 THEN -event_value END"),
        }
    )
    late = loaded.withColumns(
        {
            "tag_id": F.concat(F.lit("late."), F.col("tag_id")),
            "event_time": F.expr("event_time + INTERVAL 40 DAYS"),
        }
    ).withColumn("yyyymm", year_month("event_time"))
    merge_partitions(
        spark,
        union_all([corrections, late]),
        path,
        loaded.schema,
        keys=["tag_id", "event_id", "event_time", "yyyymm"],
        by=["yyyymm"],
        new_unique=True,
    )
    return read_partitions(spark, path, loaded.schema)


def merged_often(spark, name, rows, keys, by, order_by, times=2):
    """A keyed table after the same rows have been merged into it several times."""
    path = scratch_path(spark, name)
    for _ in range(times):
        merge_partitions(spark, rows, path, rows.schema, keys, by, order_by=order_by)
    return read_partitions(spark, path, rows.schema)


@query(
    f"""WITH {READINGS_CTE}, kept AS (SELECT *, strftime(event_time, '%Y%m') AS yyyymm FROM readings
  WHERE tag_id IS NOT NULL AND data_quality IS NOT NULL)
SELECT tag_id, data_quality, event_time, max(event_id) AS event_id, max_by(event_value, event_id) AS event_value, yyyymm
FROM kept GROUP BY tag_id, data_quality, event_time, yyyymm"""
)
def load_rerun(spark, sf_dir):
    """Readings that each come twice, loaded three times: one row per key."""
    once = raw_series(A.derive(spark, sf_dir, "events", A.READINGS), sort=None)
    columns = ["tag_id", "data_quality", "event_time", "event_id", "event_value", "yyyymm"]
    keys = ["tag_id", "data_quality", "event_time", "yyyymm"]
    rows = once.union(once).select(*columns)
    return merged_often(spark, "load", rows, keys, ["yyyymm"], [("event_id", "desc")], times=3)


@query(
    f"""WITH {cte("daily", A.DAILY, "lineitem")}, {cte("tags", A.DAILY_TAGS, "orders")}
SELECT tag_id, latest_time, max(daily_value) AS daily_value,
  CAST(floor(epoch(latest_time) / 86400) AS bigint) AS event_day, CAST(year(latest_time) AS integer) AS yyyy
FROM daily SEMI JOIN tags USING (tag_id) WHERE latest_time >= TIMESTAMP '1997-01-01' GROUP BY tag_id, latest_time"""
)
def daily_sink(spark, sf_dir):
    """The daily copy merged twice into its keyed table, the largest value of a tag and day."""
    rows = daily_by_keys(spark, sf_dir).select("tag_id", "latest_time", "daily_value", "event_day", "yyyy")
    return merged_often(spark, "daily", rows, ["tag_id", "latest_time", "yyyy"], ["yyyy"], [("daily_value", "desc")])


@query(
    f"""WITH {cte("hourly", A.HOURLY, "events")}, {cte("tags", A.HOURLY_TAGS, "orders")}
SELECT tag_id, latest_time, max(hourly_value) AS hourly_value, strftime(latest_time, '%Y%m') AS yyyymm
FROM hourly SEMI JOIN tags USING (tag_id) WHERE latest_time >= TIMESTAMP '2013-01-01' GROUP BY tag_id, latest_time"""
)
def hourly_sink(spark, sf_dir):
    """The hourly copy merged twice into its keyed table."""
    rows = hourly_by_keys(spark, sf_dir).select("tag_id", "latest_time", "hourly_value", "yyyymm")
    return merged_often(spark, "hourly", rows, ["tag_id", "latest_time", "yyyymm"], ["yyyymm"], [("hourly_value", "desc")])


@query(
    f"""WITH {READINGS_CTE}, newest AS (SELECT *, row_number() OVER (PARTITION BY tag_id, data_quality
  ORDER BY event_time DESC, event_id) AS rn FROM readings WHERE tag_id IS NOT NULL AND data_quality <> 0)
SELECT tag_id, max(event_time) AS event_time, arg_max(event_value, (event_time, -event_id)) AS event_value,
  arg_max(event_id, (event_time, -event_id)) AS event_id
FROM newest WHERE rn = 1 GROUP BY tag_id"""
)
def current_sink(spark, sf_dir):
    """Current values upserted twice into a table keyed by tag: of a tag's qualities the newest reading stays."""
    rows = current_value(spark, sf_dir).select("tag_id", "event_time", "event_value", "event_id")
    state, order = spark.createDataFrame([], rows.schema), [("event_time", "desc"), ("event_id", "asc")]
    for _ in range(2):
        state = upsert(state, rows, ["tag_id"], order_by=order)
    return state


# --- checksums and change detection --------------------------------------------------------

EVENT_CHECKSUM_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query(
    "SELECT event_id, md5(concat("
    + ", ".join(f"coalesce(CAST({c} AS varchar), '')" for c in EVENT_CHECKSUM_COLUMNS)
    + ")) AS checksum FROM events",
    name="row_checksum",
)
def checksum_scalars(spark, sf_dir):
    """Row checksum over scalar columns."""
    events = A.table(spark, sf_dir, "events")
    return events.select("event_id", row_checksum(events, EVENT_CHECKSUM_COLUMNS).alias("checksum"))


COHORT_JSON = {"exploit_id", "product_leid", "is_binary_modified", "non_genuine_leids"}


def cohort_checksum_sql(sep: str = "") -> str:
    texts = [
        f"CASE WHEN {c} IS NULL THEN '' ELSE CAST(to_json({c}) AS varchar) END"
        if c in COHORT_JSON
        else f"coalesce(CAST({c} AS varchar), '')"
        for c in CHECKSUM_COLUMNS
    ]
    return f"md5({f' || {sep!r} || '.join(texts) if sep else 'concat(' + ', '.join(texts) + ')'})"


COHORT_CTE = cte("cohorts", A.cohort_source("duck"), "orders")


@query(f"WITH {COHORT_CTE} SELECT cohort_id, {cohort_checksum_sql()} AS checksum, "
       f"{cohort_checksum_sql('|')} AS separated FROM cohorts")  # fmt: skip
def checksum_nested(spark, sf_dir):
    """Row checksum over scalars, arrays and maps, without and with a separator."""
    source = A.derive(spark, sf_dir, "orders", A.cohort_source("spark"))
    return source.select(
        "cohort_id",
        row_checksum(source, CHECKSUM_COLUMNS).alias("checksum"),
        row_checksum(source, CHECKSUM_COLUMNS, "|").alias("separated"),
    )


EXCLUDED = ["s1", "s7", "s10"]


def cohort_target_texts() -> dict[str, str]:
    texts = dict(TARGET_SOURCES)
    texts.update({flag: "false" for flag in FALSE_FLAGS})
    for out in ("hostfilemod", "isdeleted", "inapp_checkout_enabled"):
        texts[out] = f"coalesce({texts.get(out, out)}, false)"
    return texts


def cohort_rows_cte(name: str, source: str, exclude: list[str]) -> str:
    excluded = ", ".join(f"'{s}'" for s in exclude)
    condition = f" AND suid NOT IN ({excluded})" if exclude else ""
    texts = cohort_target_texts()
    columns = ", ".join(f"{texts.get(c, c)} AS {c}" for c in column_types(COHORT_TARGET))
    return (
        f"{name} AS (SELECT {columns} FROM (SELECT *, {cohort_checksum_sql()} AS checksum FROM {source}"
        f" WHERE is_active_flag{condition}))"
    )


SYNC_CTES = ",\n".join(
    [
        COHORT_CTE,
        cte("earlier", A.cohort_target_source("duck"), "orders"),
        cohort_rows_cte("source", "cohorts", EXCLUDED),
        cohort_rows_cte("target", "earlier", []),
        "changed AS (SELECT * FROM source s WHERE NOT EXISTS "
        "(SELECT 1 FROM target t WHERE t.suid = s.suid AND t.checksum = s.checksum))",
    ]
)


def cohort_sides(spark, sf_dir):
    source = A.derive(spark, sf_dir, "orders", A.cohort_source("spark"))
    earlier = A.derive(spark, sf_dir, "orders", A.cohort_target_source("spark"))
    target = cohort_rows(earlier)
    return source, target


@query(f"WITH {SYNC_CTES} SELECT {flat_sql(column_types(COHORT_TARGET), {})} FROM changed")
def sync_changed(spark, sf_dir):
    """Cohort rows that are new to the target or changed; rows with a null id are always kept."""
    source, target = cohort_sides(spark, sf_dir)
    return flat(cohort_changes(source, target, EXCLUDED))


@query(f"WITH {SYNC_CTES} SELECT {flat_sql(column_types(COHORT_TARGET), {})} FROM changed")
def sync_changed_narrow(spark, sf_dir):
    """The same rows against a target that holds each row twice: copies neither add nor lose rows."""
    source, target = cohort_sides(spark, sf_dir)
    return flat(cohort_changes(source, target.union(target), EXCLUDED))


@query(f"WITH {SYNC_CTES} SELECT {flat_sql(column_types(COHORT_TARGET), {})} FROM changed")
def sync_by_ranges(spark, sf_dir):
    """The same rows, found by comparing digests of id ranges first."""
    source, target = cohort_sides(spark, sf_dir)
    return flat(cohort_changes(source, target, EXCLUDED, ranges=256))


@query(
    f"""WITH {SYNC_CTES}, state AS (
SELECT * FROM changed WHERE suid IS NOT NULL
UNION ALL
SELECT t.* FROM target t WHERE t.suid IS NOT NULL AND NOT EXISTS
  (SELECT 1 FROM changed c WHERE c.suid = t.suid AND c.cohortid = t.cohortid))
SELECT s.suid, s.cohortid, s.checksum, s.launchdate, s.target_family,
  coalesce(s.externalcampaign, t.externalcampaign) AS externalcampaign
FROM state s LEFT JOIN target t ON s.suid = t.suid AND s.cohortid = t.cohortid"""
)
def sync_upsert(spark, sf_dir):
    """The target after the sync: changed rows upserted by id and cohort, nulls leaving old values."""
    source, target = cohort_sides(spark, sf_dir)
    changed = require(cohort_changes(source, target, EXCLUDED), ["suid"])
    state = upsert(require(target, ["suid"]), changed, ["suid", "cohortid"], new_unique=True)
    return state.select("suid", "cohortid", "checksum", "launchdate", "target_family", "externalcampaign")


@query(
    """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_quantity > 25
  AND r.l_partkey = lineitem.l_partkey AND r.l_quantity = lineitem.l_quantity)
"""
)
def changed_with_copies(spark, sf_dir):
    """Change detection against a target that repeats its keys."""
    lineitem = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    target = A.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' AND l_quantity > 25")
    return changed_rows(lineitem, target, ["l_partkey", "l_quantity"])


@query(
    """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
WHERE l_partkey % 50 = 7 AND NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_partkey % 50 = 7 AND r.l_quantity <= 25
  AND r.l_partkey = lineitem.l_partkey AND r.l_quantity = lineitem.l_quantity)
UNION ALL
SELECT NULL, s_suppkey, NULL FROM supplier
"""
)
def changed_ranges(spark, sf_dir):
    """Changes in a fiftieth of the keys, found by range digests; the tables repeat keys and hold null ones."""
    lineitem = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    unmatched = A.table(spark, sf_dir, "supplier").selectExpr(
        "CAST(NULL AS bigint) AS l_orderkey", "s_suppkey AS l_partkey", "CAST(NULL AS double) AS l_quantity"
    )
    rows = lineitem.union(unmatched)
    target = rows.filter("l_partkey % 50 <> 7 OR l_quantity <= 25")
    return changed_rows_by_range(rows, target, ["l_partkey", "l_quantity"], ["l_partkey"])


# --- incremental exports -------------------------------------------------------------------


@query(
    """
SELECT * FROM events
WHERE ts > TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-31' - INTERVAL 24 HOURS
"""
)
def incremental_window(spark, sf_dir):
    """Rows between the high-water mark and the cut-off, both ends open."""
    return between_marks(A.table(spark, sf_dir, "events"), "ts", "2024-01-10", "2024-01-31")


@query(
    """
WITH logged AS (SELECT CASE WHEN event_type = 'error' THEN 'no time' ELSE
  strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END AS event_time FROM events)
SELECT max(try_strptime(event_time, '%Y-%m-%d %H:%M:%S.%g')) AS max_time,
  epoch_ms(max(try_strptime(event_time, '%Y-%m-%d %H:%M:%S.%g'))) AS max_time_ms
FROM logged
""",
    name="high_water",
)
def high_water_text(spark, sf_dir):
    """High-water mark of a text column; text that is no time is passed over."""
    logged = A.table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "no time").otherwise(format_ms("ts")).alias("event_time")
    )
    return flat(audit_mark(logged))


MACHINE_CTE = cte("machines", A.machine_source("duck"), "lineitem")


def machines_of(spark, sf_dir):
    return A.derive(spark, sf_dir, "lineitem", A.machine_source("spark"))


@query(
    f"""WITH {MACHINE_CTE}, mark AS (
SELECT greatest({", ".join(f"max({c})" for c in ACTIVITY_TIMES)}) AS max_time FROM machines)
SELECT max_time, epoch_ms(max_time) AS max_time_ms FROM mark"""
)
def high_water_multi(spark, sf_dir):
    """High-water mark over several columns."""
    return flat(machine_mark(machines_of(spark, sf_dir)))


EPOCH_SQL = "TIMESTAMP '1970-01-01'"
NEWEST_SQL = f"greatest({', '.join(f'coalesce({c}, {EPOCH_SQL})' for c in ACTIVITY_TIMES)})"


@query(f"WITH {MACHINE_CTE} SELECT suid, {NEWEST_SQL} AS newest FROM machines")
def newest_activity(spark, sf_dir):
    """Row-wise newest of four times, nulls as the epoch."""
    machines = machines_of(spark, sf_dir)
    floor = time_literal(0, machines.schema[ACTIVITY_TIMES[0]].dataType)
    return machines.select("suid", newest_of(ACTIVITY_TIMES, floor).alias("newest"))


@query(f"WITH {MACHINE_CTE} SELECT suid FROM machines WHERE {NEWEST_SQL} > TIMESTAMP '1969-12-31' "
       f"AND {NEWEST_SQL} < TIMESTAMP '1998-06-01' - INTERVAL 24 HOURS")  # fmt: skip
def newest_window(spark, sf_dir):
    """Window over the newest of four times; a row without any counts as the epoch."""
    machines = machines_of(spark, sf_dir)
    return between_marks(machines, ACTIVITY_TIMES, "1969-12-31", "1998-06-01").select("suid")


AUDIT_OUT = """suid, strftime(eventtime, '%Y-%m-%d %H:%M:%S.%g') AS event_time,
  coalesce(eventtype, '') AS event_type, coalesce(cartid, '') AS gid, coalesce(gtoken, '') AS gtoken,
  coalesce(city, 0) AS city, coalesce(region, 0) AS state, coalesce(country, 0) AS country,
  coalesce(activeleid, '') AS notifiedleid, coalesce(notifurl, '') AS notifurl,
  coalesce(notif_audit_id, '') AS notifauditid"""


@query(
    f"""WITH {AUDIT_CTE}
SELECT {AUDIT_OUT}, '2024-02-01' AS insert_date, '1' AS run_sequence FROM audit
WHERE eventtime > TIMESTAMP '2024-01-05' AND eventtime < TIMESTAMP '2024-01-28' - INTERVAL 24 HOURS"""
)
def audit_export(spark, sf_dir):
    """Audit events in export shape, inside the window."""
    events = A.derive(spark, sf_dir, "events", A.AUDIT)
    return audit_events(events, "2024-02-01", low="2024-01-05", as_of="2024-01-28")


@query(
    f"""WITH {AUDIT_CTE}
SELECT {AUDIT_OUT}, CASE WHEN eventtime < TIMESTAMP '2024-01-14' THEN '2024-01-15' ELSE '2024-01-31' END
  AS insert_date, '1' AS run_sequence
FROM audit WHERE eventtime < TIMESTAMP '2024-01-30'"""
)
def export_runs(spark, sf_dir):
    """Two incremental runs, the first of them run twice; the second starts at the first one's mark."""
    path = scratch_path(spark, "audit-export")
    events = A.derive(spark, sf_dir, "events", A.AUDIT)
    shape = audit_events(events, "2024-01-15").schema
    for as_of in ("2024-01-10", "2024-01-15"):
        write_run(audit_events(events, "2024-01-15", as_of=as_of), path, "2024-01-15", newest=newest_audit())
    low = last_mark(spark, path, "2024-01-31")
    write_run(audit_events(events, "2024-01-31", low=low, as_of="2024-01-31"), path, "2024-01-31", newest=newest_audit())
    return read_runs(spark, path, shape)


@query(
    f"""WITH {MACHINE_CTE}, timed AS (SELECT *, {NEWEST_SQL} AS newest FROM machines WHERE machineid IS NOT NULL)
SELECT suid, machineid, CASE WHEN newest < TIMESTAMP '1995-01-01' THEN '2024-02-01'
  WHEN newest < TIMESTAMP '1997-01-01' THEN '2024-02-02' ELSE '2024-02-10' END AS insert_date,
  CASE WHEN newest < TIMESTAMP '1997-01-01' THEN '1' ELSE '2' END AS run_sequence
FROM timed WHERE newest < TIMESTAMP '2001-01-01'"""
)
def machine_runs(spark, sf_dir):
    """The export loop for machines: mark, window, run, mark; the second run is run twice, one has no rows."""
    path = scratch_path(spark, "machine-export")
    machines = machines_of(spark, sf_dir)
    runs = [
        ("2024-02-01", "1", "1995-01-02"), ("2024-02-02", "1", "1996-01-02"), ("2024-02-02", "1", "1997-01-02"),
        ("2024-02-10", "1", "1997-01-02"), ("2024-02-10", "2", "2001-01-02"),
    ]
    for day, sequence, as_of in runs:
        low = last_mark(spark, path, day, sequence)
        rows = machine_snapshot(machines, day, sequence, low=low, as_of=as_of)
        write_run(rows.select("suid", "machineid", *ACTIVITY_TIMES), path, day, sequence, newest=newest_machines())
    return read_runs(spark, path, "suid string, machineid string, insert_date string, run_sequence string")


@query(
    """
SELECT 'orders' AS table_name, 'main' AS database_name, '2024-02-01' AS insert_date, '1' AS run_sequence,
  count(*) AS n_rows, epoch_ms(max(o_orderdate)) AS max_time_ms FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'orders', 'main', '2024-02-02', '1', 0, NULL
"""
)
def marked_audit(spark, sf_dir):
    """Audit lines with the newest time of each run, counted in its write; a run without rows has none."""
    path, audit = scratch_path(spark, "marked"), scratch_path(spark, "marked-audit")
    orders = A.table(spark, sf_dir, "orders")
    newest = F.unix_millis(F.max("o_orderdate").cast("timestamp"))
    for day, status in (("2024-02-01", "P"), ("2024-02-01", "F"), ("2024-02-02", "none")):
        rows = orders.filter(F.col("o_orderstatus") == status)
        export_run(rows, path, "orders", "main", day, "1", audit_path=audit, newest=newest)
    return read_tree(spark, audit, MARKED_AUDIT_SCHEMA)


DISABLED_TEXTS = {
    c: f"coalesce({c}, false)" for c in ("hostfilemod", "disabled", "isdeleted")
}


@query(
    f"""WITH {cte("cohorts", A.disabled_source("duck"), "orders")}
SELECT {flat_sql(column_types(DISABLED_COHORTS), DISABLED_TEXTS)},
  '2024-02-01' AS insert_date, '2' AS run_sequence
FROM cohorts WHERE disabled"""
)
def flag_export(spark, sf_dir):
    """Disabled cohorts in export shape."""
    cohorts = A.derive(spark, sf_dir, "orders", A.disabled_source("spark"))
    return flat(disabled_cohorts(cohorts, "2024-02-01", 2))


# --- machine snapshots ---------------------------------------------------------------------


def machine_texts() -> dict[str, str]:
    texts = dict(MACHINE_SOURCES)
    for out in ("licenses", "producthardeningappinfo", "files", "operatingconfigs"):
        texts[out] = f"map_values({out})"
    texts["leids"] = (
        "list_filter(list_transform(map_values(leids), lambda p: struct_update(p, "
        "nglapp := coalesce(p.nglapp, false))), lambda p: coalesce(cardinality(p.files), 0) > 0 "
        "OR coalesce(len(p.licenses), 0) > 0)"
    )
    for name, kind in column_types(MACHINES).items():
        if kind in ("int", "boolean"):
            zero = "0" if kind == "int" else "false"
            texts[name] = f"coalesce({texts.get(name, name)}, {zero})"
    return texts


MACHINE_WINDOW = (
    f"machineid IS NOT NULL AND {NEWEST_SQL} > TIMESTAMP '1994-01-01' "
    f"AND {NEWEST_SQL} < TIMESTAMP '2000-06-01' - INTERVAL 24 HOURS"
)


def machine_window_rows(spark, sf_dir):
    machines = machines_of(spark, sf_dir)
    return machine_snapshot(machines, "2024-02-01", low="1994-01-01", as_of="2000-06-01")


MACHINE_PLAIN = {c: t for c, t in column_types(MACHINES).items() if not is_nested(t)}
MACHINE_NESTED = {c: t for c, t in column_types(MACHINES).items() if c == "suid" or is_nested(t)}


@query(
    f"""WITH {MACHINE_CTE}
SELECT {flat_sql(MACHINE_PLAIN, machine_texts())}, '2024-02-01' AS insert_date, '1' AS run_sequence
FROM machines WHERE {MACHINE_WINDOW}"""
)
def machine_export(spark, sf_dir):
    """Machine snapshots: the plain output columns."""
    rows = machine_window_rows(spark, sf_dir)
    return flat(rows.select(*MACHINE_PLAIN, "insert_date", "run_sequence"))


@query(
    f"""WITH {MACHINE_CTE}
SELECT {flat_sql(MACHINE_NESTED, machine_texts())}
FROM machines WHERE {MACHINE_WINDOW}"""
)
def machine_nested(spark, sf_dir):
    """Machine snapshots: the nested output columns as text."""
    return flat(machine_window_rows(spark, sf_dir).select(*MACHINE_NESTED))


@query(
    f"""WITH {MACHINE_CTE}, products AS (
SELECT suid, unnest({machine_texts()["leids"]}) AS p FROM machines)
SELECT suid, p.leid AS leid, p.installerid AS installerid, p.nglapp AS nglapp,
  CAST(coalesce(cardinality(p.files), 0) AS integer) AS n_files,
  CAST(coalesce(len(p.licenses), 0) AS integer) AS n_licenses, p.lastrulefetched AS lastrulefetched
FROM products"""
)
def machine_products(spark, sf_dir):
    """Products in use, one row each: map to array, default inside the struct, element filter."""
    machines = machines_of(spark, sf_dir)
    rows = machines.select("suid", F.explode(products_in_use("leids")).alias("p"))
    return rows.select(
        "suid",
        "p.leid",
        "p.installerid",
        "p.nglapp",
        F.coalesce(F.size("p.files"), F.lit(0)).alias("n_files"),
        F.coalesce(F.size("p.licenses"), F.lit(0)).alias("n_licenses"),
        "p.lastrulefetched",
    )


@query(
    f"""WITH {MACHINE_CTE}
SELECT suid, clientupdateinfo.agsservicestatus AS agsservicestatus,
  coalesce(clientupdateinfo.updatesuppressed, false) AS updatesuppressed,
  clientupdateinfo.lastupdateattempted AS lastupdateattempted
FROM machines"""
)
def struct_flatten(spark, sf_dir):
    """Children of a struct as columns; a null struct gives nulls and the default."""
    machines = machines_of(spark, sf_dir)
    return flatten_struct(
        machines.select("suid", "clientupdateinfo"),
        "clientupdateinfo",
        ["agsservicestatus", "updatesuppressed", "lastupdateattempted"],
        {"updatesuppressed": False},
    )


@query(
    f"""WITH {MACHINE_CTE}
SELECT suid, CASE WHEN leids IS NOT NULL THEN CAST(to_json(list_transform(map_values(leids),
  lambda p: {{'nglapp': p.nglapp, 'leid': p.leid, 'added': CAST(NULL AS integer)}})) AS varchar) END AS leids
FROM machines"""
)
def struct_by_name(spark, sf_dir):
    """Structs inside a map brought to another field list by name."""
    machines = machines_of(spark, sf_dir)
    target = StructType.fromDDL("m map<string,struct<nglapp boolean, leid string, added int>>")
    shaped = reshape(F.col("leids"), machines.schema["leids"].dataType, target["m"].dataType)
    return flat(machines.select("suid", F.map_values(shaped).alias("leids")))
