"""A session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# year/month buckets and epoch days must agree at midnight
FIXED = {"spark.sql.session.timeZone": "UTC"}

# Used where the launcher does not say otherwise.
PREFERRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}
ON_A_CLUSTER = {"spark.sql.files.maxPartitionBytes": "512m"}
LOCAL = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def shuffle_width(largest_shuffle_gb: float, partition_gb: float = 1.0) -> int:
    """Shuffle partitions for the largest shuffle of a job.

    About a gigabyte each: adaptive execution joins what turns out small, but
    splits only joins and rebalances, so starting too narrow cannot be mended.
    """
    return int(max(200, largest_shuffle_gb / partition_gb))


def build_session(
    app_name: str = "tableferry",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session for a job; the master and all but the time zone can be left to the launcher."""
    builder = SparkSession.builder.appName(app_name)
    start = {**(LOCAL if master and master.startswith("local") else {}), **(extra or {})}
    if master is not None:
        builder = builder.master(master)
    for name, value in start.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()

    given = spark.sparkContext.getConf()
    local = given.get("spark.master", "").startswith("local")
    preferred = {**PREFERRED, **({"spark.sql.shuffle.partitions": "8"} if local else ON_A_CLUSTER)}
    settings = {k: v for k, v in preferred.items() if not given.contains(k)}
    settings.update(FIXED)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for name, value in settings.items():
        spark.conf.set(name, value)
    return spark
