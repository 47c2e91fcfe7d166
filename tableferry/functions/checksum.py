"""Row checksum for change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def row_checksum(df: DataFrame, cols: list[str], sep: str = "") -> Column:
    """md5 over the text of ``cols`` in the given order, null as empty text.

    Scalars are cast to string, arrays, maps and structs written as JSON. The
    default has no separator, so neighbouring texts can run together
    (``a|bc`` and ``ab|c`` agree); pass ``sep`` to keep them apart.
    """
    parts = []
    for name in cols:
        nested = isinstance(df.schema[name].dataType, (ArrayType, MapType, StructType))
        text = F.to_json(F.col(name)) if nested else F.col(name).cast("string")
        parts.append(F.coalesce(text, F.lit("")))
    return F.md5(F.concat_ws(sep, *parts) if sep else F.concat(*parts))
