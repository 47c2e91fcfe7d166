"""Change detection between two tables."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .keyed import membership_keys
from .quality import require

RANGES = 1 << 14


def changed_rows(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], target_unique: bool = False
) -> DataFrame:
    """Rows of ``src`` with no equal ``keys`` (id and checksum) in ``tgt``: new or changed.

    A null key never matches, so such rows are kept, as are duplicates. Only the
    key columns of ``tgt`` are read. ``target_unique`` states that ``tgt`` holds
    each key once (true for a keyed table whose checksum covers its key), which
    saves the copy removal.
    """
    keys = list(keys)
    known = require(tgt.select(*keys), keys) if target_unique else membership_keys(tgt, keys)
    return src.join(known, keys, "left_anti").select(*src.columns)


def range_digests(df: DataFrame, keys: Sequence[str], range_keys: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """``key_range, n, bits, total``: what the ``keys`` of each hash range of ``range_keys`` come to.

    Equal rows in pairs cancel out in ``bits``, but not in their number and in the
    sum of their digests. One row a range and task is shuffled.
    """
    digest = F.xxhash64(*keys)
    return (
        df.select(_range(range_keys, ranges).alias("key_range"), digest.alias("digest"))
        .groupBy("key_range")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor("digest").alias("bits"),
            F.sum(F.col("digest").cast("decimal(20,0)")).alias("total"),
        )
    )


def _range(keys: Sequence[str], ranges: int):
    return F.pmod(F.xxhash64(F.lit("range"), *keys), F.lit(ranges)).cast("int")


def differing_ranges(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], range_keys: Sequence[str], ranges: int = RANGES
) -> DataFrame:
    """``key_range`` of the ranges of ``src`` in which the two tables differ, or that hold a null key: ``ranges`` rows at most."""
    keys = list(keys)
    null_key = reduce(or_, [F.col(k).isNull() for k in keys])
    mine = range_digests(src, keys, range_keys, ranges)
    other = range_digests(tgt, keys, range_keys, ranges).toDF("other_range", "other_n", "other_bits", "other_total")
    same = (
        F.col("n").eqNullSafe(F.col("other_n"))
        & F.col("bits").eqNullSafe(F.col("other_bits"))
        & F.col("total").eqNullSafe(F.col("other_total"))
    )
    differ = mine.join(other, F.col("key_range") == F.col("other_range"), "left").where(~same).select("key_range")
    # a null key matches nothing, not even itself
    unmatched = src.where(null_key).select(_range(range_keys, ranges).alias("key_range"))
    return differ.union(unmatched).distinct()


def changed_rows_by_range(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    range_keys: Sequence[str],
    ranges: int = RANGES,
    target_unique: bool = False,
) -> DataFrame:
    """The rows of :func:`changed_rows`, joining only the hash ranges of ``range_keys`` in which the tables differ.

    For tables that are equal but for some regions of their keys: both are read
    twice, but rows of equal ranges are not shuffled. ``ranges`` are cut so that
    changed rows touch a part of them only; where changes are all over, use
    :func:`changed_rows`. ``range_keys`` is a part of ``keys``, the id without the
    checksum. A range whose rows differ counts as equal only if number, xor and
    sum of their 64-bit digests all agree.
    """
    if not set(range_keys) <= set(keys):
        raise ValueError("range_keys must be part of the keys")
    # at most `ranges` numbers, stored: both sides must be cut by the same ones
    wanted, _ = stored(differing_ranges(src, tgt, keys, range_keys, ranges), "ranges")

    def cut(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(wanted), _range(range_keys, ranges) == F.col("key_range"), "left_semi")

    return changed_rows(cut(src), cut(tgt.select(*keys)), keys, target_unique)


def pick_rows(df: DataFrame, few: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys are in ``few``, a null equal to a null.

    Pass a stored table as ``few``: Spark knows its size then, and shuffles
    ``df`` only if it is above the session's broadcast threshold.
    """
    wanted = few.select(*[F.col(k).alias(f"__few_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__few_{k}")) for k in keys])
    return df.join(wanted, same, "left_semi")
