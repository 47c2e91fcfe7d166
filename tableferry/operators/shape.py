"""Projections that end in a fixed list of output columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, MapType, StructType

from ..functions.nested import map_to_array, reshape


def project(df: DataFrame, spec: Sequence[tuple]) -> DataFrame:
    """Ordered select from (output, source column name or Column[, default]) entries."""
    out = []
    for name, source, *default in spec:
        c = F.col(source) if isinstance(source, str) else source
        if default:
            c = F.coalesce(c, F.lit(default[0]))
        out.append(c.alias(name))
    return df.select(*out)


def conform(
    df: DataFrame,
    target: StructType,
    sources: Mapping[str, str] | None = None,
    computed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Select the target's columns, in its order and types, matched by name.

    ``sources`` maps an output to a differently named (or struct child) source
    column and ``computed`` supplies outputs outright. By rule: a map whose
    output is an array becomes the array of its values, a null top-level int
    becomes 0, a null top-level boolean becomes false, and every other null
    stays null.
    """
    sources, computed = sources or {}, computed or {}
    given = [
        computed[f.name] if f.name in computed else F.col(sources.get(f.name, f.name))
        for f in target.fields
    ]
    given_types = [f.dataType for f in df.select(*given).schema.fields]
    out = []
    for field, c, source_type in zip(target.fields, given, given_types, strict=True):
        if isinstance(source_type, MapType) and isinstance(field.dataType, ArrayType):
            c, source_type = map_to_array(c), ArrayType(source_type.valueType)
        c = reshape(c, source_type, field.dataType)
        if isinstance(field.dataType, IntegerType):
            c = F.coalesce(c, F.lit(0))
        elif isinstance(field.dataType, BooleanType):
            c = F.coalesce(c, F.lit(False))
        out.append(c.alias(field.name))
    return df.select(*out)


def flatten_struct(
    df: DataFrame, col: str, fields: Sequence[str], defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Replace a struct column by its children; children of a null struct are null or the default.

    A child named like another column is refused.
    """
    defaults = defaults or {}
    taken = sorted(set(fields) & (set(df.columns) - {col}))
    if taken:
        raise ValueError(f"fields of {col} are named like columns: {taken}")
    lifted = [
        (
            F.coalesce(F.col(col)[f], F.lit(defaults[f])) if f in defaults else F.col(col)[f]
        ).alias(f)
        for f in fields
    ]
    return df.select(*[F.col(c) for c in df.columns if c != col], *lifted)


def union_all(dfs: Sequence[DataFrame], by_name: bool = True) -> DataFrame:
    """All rows of all tables, duplicates kept."""
    return reduce(DataFrame.unionByName if by_name else DataFrame.union, dfs)
