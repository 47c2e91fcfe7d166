"""Where intermediate tables may be written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder the session names in ``spark.checkpoint.dir``.

    A checkpoint folder set on the running context serves as well. Where both
    are unset, a folder of the warehouse is taken: executors reach that too.
    A machine-local temporary folder is never used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table to scratch once; its stored form and its path.

    The stored form has no lineage to recompute when executors are lost and
    gives the same rows on each read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Like :func:`stored`, giving the row count in place of the path."""
    counted = Observation()
    kept, _ = stored(df.observe(counted, F.count(F.lit(1)).alias("n_rows")), name)
    return kept, counted.get["n_rows"]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
