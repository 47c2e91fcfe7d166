"""Folders that are replaced whole, without a moment in which neither the old rows nor the new ones are there.

Each attempt writes a version of its own. An empty marker, created last, makes
it the one that readers see; the marker's name holds all it says, so it is there
whole or not at all. What it replaces is deleted afterwards.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# readers of plain files pass over names that start so
MARKERS = "_committed"


@dataclass(frozen=True, order=True)
class Committed:
    """A folder's valid version; of several markers the last attempt's counts."""

    attempt: int
    version: str
    n_rows: int
    max_time_ms: int | None

    @property
    def marker(self) -> str:
        mark = "none" if self.max_time_ms is None else self.max_time_ms
        return f"{self.attempt:08d}.{self.version}.{self.n_rows}.{mark}"

    @staticmethod
    def named(marker: str) -> Committed:
        attempt, version, n_rows, mark = marker.split(".")
        return Committed(int(attempt), version, int(n_rows), None if mark == "none" else int(mark))


def _files(spark: SparkSession, path: str):
    """The file system of a path and the path in its terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _children(spark: SparkSession, path: str) -> list:
    files, at = _files(spark, path)
    return list(files.listStatus(at)) if files.exists(at) else []


def new_version(root: str, place: str) -> tuple[str, str]:
    """A version's name and the folder to write it to; ``place`` is the folder below ``root`` it stands for."""
    version = uuid.uuid4().hex
    return version, f"{root}/{place}/version={version}"


def committed(spark: SparkSession, root: str, levels: int = 2) -> dict[str, Committed]:
    """The valid version of every place below ``root``; ``levels`` folders make a place. A listing, no file is read."""
    files, pattern = _files(spark, f"{root}/{MARKERS}{'/*' * (levels + 1)}")
    found: dict[str, Committed] = {}
    for status in files.globStatus(pattern) or []:
        names = status.getPath().toString().split("/")
        place, marker = "/".join(names[-levels - 1 : -1]), Committed.named(names[-1])
        found[place] = max(marker, found.get(place, marker))
    return found


def commit(spark: SparkSession, root: str, place: str, version: str, n_rows: int, max_time_ms: int | None = None) -> None:
    """Make a complete version the valid one, then delete what it replaces.

    A driver lost before the marker is there leaves the old version valid; one
    lost after it leaves files that nobody reads. Of two attempts at the same
    time, the later marker counts, and neither deletes what the other is writing.
    """
    folder = f"{root}/{MARKERS}/{place}"
    older = [Committed.named(s.getPath().getName()) for s in _children(spark, folder)]
    mine = Committed(max((m.attempt for m in older), default=0) + 1, version, n_rows, max_time_ms)
    files, at = _files(spark, f"{folder}/{mine.marker}")
    if not files.createNewFile(at):
        raise OSError(f"could not commit {at}")
    # files outside of any version are of a run written before there were versions
    loose = [s.getPath().toString() for s in _children(spark, f"{root}/{place}") if not s.getPath().getName().startswith("version=")]
    # its marker goes last: while it is there, what it names will be found and deleted
    for path in [*loose, *(p for m in older for p in (f"{root}/{place}/version={m.version}", f"{folder}/{m.marker}"))]:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def sweep(spark: SparkSession, root: str, levels: int = 2) -> int:
    """Delete the versions that are not valid, lost attempts among them; how many. For times at which nobody writes."""
    valid = {f"{place}/version={v.version}" for place, v in committed(spark, root, levels).items()}
    files, pattern = _files(spark, f"{root}{'/*=*' * levels}/version=*")
    found = [s.getPath().toString() for s in files.globStatus(pattern) or []]
    lost = [path for path in found if "/".join(path.split("/")[-levels - 1 :]) not in valid]
    for path in lost:
        _delete(spark, path)
    return len(lost)


def read_committed(spark: SparkSession, root: str, schema: StructType | str, levels: int = 2) -> DataFrame:
    """The rows of all valid versions; place columns that the schema declares keep their type and skip folders."""
    valid = committed(spark, root, levels)
    if not valid:
        return spark.createDataFrame([], schema)
    folders = [f"{root}/{place}/version={v.version}" for place, v in sorted(valid.items())]
    reader = spark.read.schema(schema).option("basePath", root)
    names = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
    return reader.parquet(*folders).select(*names)
