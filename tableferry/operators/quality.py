"""Null checks and null replacement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_audit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column (column_name, n_rows, n_null), counted in a single pass."""
    present = [F.count(F.col(c)).alias(f"present_{i}") for i, c in enumerate(cols)]
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *present)
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n_rows"),
            (F.col("n_rows") - F.col(f"present_{i}")).alias("n_null"),
        )
        for i, c in enumerate(cols)
    ]
    return counts.select(F.inline(F.array(*lines)))


def null_rows(df: DataFrame, col: str) -> DataFrame:
    """The rows a null audit counts for one column."""
    return df.filter(F.col(col).isNull())


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols``.

    Written as ``IS NOT NULL`` per column, which reaches the file scan;
    ``dropna`` would not, and would also drop NaN.
    """
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
    return df


def defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls column by column, keeping each column's type."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()}
    )
