"""Batches cut by the bytes of their texts, so that a worker's memory does not follow a batch's row count."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 2 << 20
BATCH_ROWS = 1000


def short_batches(spark: SparkSession) -> None:
    """Bound the rows that go to a Python worker at a time, unless the launcher has."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(BATCH_ROWS))


def text_slices(batches: Iterable[pa.RecordBatch], text_at: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows in order, about ``limit`` text bytes at a time and one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)
        pa.default_memory_pool().release_unused()
