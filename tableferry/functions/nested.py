"""Maps, arrays and structs, reshaped in place by column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def prefix(c: Column | str, sep: str = ".", n: int = 1) -> Column:
    """Text before the n-th separator; the whole text where there is none."""
    return F.substring_index(F.col(c) if isinstance(c, str) else c, sep, n)


def map_to_array(c: Column | str) -> Column:
    """Values of a map as an array; a null map stays null."""
    return F.map_values(c)


def non_empty(c: Column) -> Column:
    """True for an array or map with at least one entry; null counts as empty."""
    return F.coalesce(F.size(c), F.lit(0)) > 0


def filter_elements(arr: Column | str, predicate: Callable[[Column], Column]) -> Column:
    """Keep the array elements the predicate accepts; a null array stays null."""
    return F.filter(arr, predicate)


def struct_defaults(c: Column, defaults: Mapping[str, object]) -> Column:
    """Replace null children of a struct; a null struct stays null."""
    for name, value in defaults.items():
        c = c.withField(name, F.coalesce(c.getField(name), F.lit(value)))
    return c


def reshape(c: Column, source: DataType, target: DataType) -> Column:
    """Bring a nested value to ``target``, matching struct fields by name at every depth.

    Fields the target does not name are dropped and fields the source lacks
    become null. A value that already has the target's shape is passed through.
    """
    if source.simpleString() == target.simpleString():
        return c
    if isinstance(source, StructType) and isinstance(target, StructType):
        have = {f.name: f.dataType for f in source.fields}
        fields = [
            (
                reshape(c.getField(f.name), have[f.name], f.dataType)
                if f.name in have
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in target.fields
        ]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(source, ArrayType) and isinstance(target, ArrayType):
        return F.transform(c, lambda x: reshape(x, source.elementType, target.elementType))
    if isinstance(source, MapType) and isinstance(target, MapType):
        if source.keyType != target.keyType:
            raise TypeError(f"map keys differ: {source.keyType} and {target.keyType}")
        return F.transform_values(c, lambda _, v: reshape(v, source.valueType, target.valueType))
    return c.cast(target)
