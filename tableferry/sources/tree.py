"""Parquet trees with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_tree(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Every parquet file under ``path`` at any depth, columns matched by name.

    Only the declared columns are read and a column a file lacks is null.
    Directory names are not turned into columns; for run-partitioned trees use
    ``read_partitions``.
    """
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def write_tree(df: DataFrame, path: str) -> None:
    """Write a new tree; an existing path is an error."""
    df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
