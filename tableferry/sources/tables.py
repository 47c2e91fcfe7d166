"""Tables behind any Spark connector."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def session_options(spark: SparkSession, fmt: str) -> dict[str, str]:
    """What the session's settings say about a connector: ``spark.datasource.<format>.<option>``.

    The prefix is the one under which Spark passes session settings to those
    connectors that ask for them; here it works for any format.
    """
    prefix = f"spark.datasource.{fmt}."
    return {name.removeprefix(prefix): value for name, value in spark.conf.getAll.items() if name.startswith(prefix)}


def read_table(
    spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None, schema=None
) -> DataFrame:
    """A connector table by format name and options.

    Connection settings come from the session's own (:func:`session_options`);
    ``options`` add to them and go first. ``table`` as the format reads the
    catalog table named by the option ``name``.
    """
    options = {**session_options(spark, fmt), **(options or {})}
    if fmt == "table":
        return spark.table(options["name"])
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def write_table(df: DataFrame, fmt: str, options: Mapping[str, str] | None = None) -> None:
    """Append to a connector table; a keyed store turns this into an upsert by key.

    Whether nulls overwrite is that store's write option. For parquet, which
    has no keys, use ``merge_partitions``. Settings as in :func:`read_table`.
    """
    options = {**session_options(df.sparkSession, fmt), **(options or {})}
    if fmt == "table":
        df.write.mode("append").saveAsTable(options["name"])
    else:
        df.write.format(fmt).options(**options).mode("append").save()
