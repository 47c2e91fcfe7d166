"""Bloom filters over keys: rows leave where they are read, before anything is shuffled for an exact join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 32
PROBES = 4
# 2 MB at most, whatever the number of keys
LEAST_BITS, MOST_BITS = 1 << 12, 1 << 24


def _probes(keys: Sequence[Column], bits: int) -> list[Column]:
    """The places a key has in the filter, by double hashing; a null key has places like any other."""
    h = F.xxhash64(*keys)
    low, high = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 32)
    return [(low + high * i) % bits for i in range(PROBES)]


@dataclass(frozen=True)
class KeyFilter:
    """Whether a key may be among those given: never wrong for one that is."""

    words: DataFrame
    bits: int

    def may_hold(self, *keys: Column) -> Column:
        """A condition for the rows of any table; the filter reaches its tasks as a scalar subquery."""
        words = self.words.scalar()
        return reduce(and_, [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
                             for p in _probes(keys, self.bits)])


def key_filter(keys: DataFrame, cols: Sequence[str], most_bits: int = MOST_BITS) -> KeyFilter:
    """A filter over the values of ``cols``; pass a stored table, it is read twice.

    Its bits are set by Spark; the driver receives them as ``most_bits / 64``
    numbers at most. With 32 bits a key about one in 5,000 other keys passes.
    Beyond ``most_bits / 32`` keys (524,288) more do, up to all of them: the
    filter then saves nothing, and an exact join after it still gives the same rows.
    """
    wanted = keys.count() * BITS_PER_KEY
    bits = LEAST_BITS
    while bits < min(wanted, most_bits):
        bits *= 2
    at = F.explode(F.array(*_probes([F.col(c) for c in cols], bits))).alias("at")
    word = F.shiftright("at", 6).alias("word")
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    found = keys.select(at).select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bit")).collect()
    words = [0] * (bits // 64)
    for r in found:
        words[r["word"]] = r["bit"]
    return KeyFilter(keys.sparkSession.createDataFrame([(words,)], "words array<bigint>"), bits)


def _same(df_keys: Sequence[Column], names: Sequence[str]) -> Column:
    return reduce(and_, [k.eqNullSafe(F.col(n)) for k, n in zip(df_keys, names)])


def rows_with_keys(df: DataFrame, df_keys: Sequence[Column], keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose keys are a row of ``keys``, a null equal to a null.

    ``keys`` is a stored table, its columns in the order of ``df_keys`` and
    their types the same. Only the rows that pass the filter are shuffled.
    """
    names = [f"__key_{i}" for i in range(len(keys.columns))]
    kept = df.where(key_filter(keys, keys.columns).may_hold(*df_keys))
    return kept.join(keys.toDF(*names), _same(df_keys, names), "left_semi")


def rows_without_keys(df: DataFrame, df_keys: Sequence[Column], keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose keys are no row of ``keys``, a null equal to a null.

    As :func:`rows_with_keys`; ``df`` is read twice, and the rows that cannot
    match are not shuffled.
    """
    names = [f"__key_{i}" for i in range(len(keys.columns))]
    may = key_filter(keys, keys.columns).may_hold(*df_keys)
    rest = df.where(may).join(keys.toDF(*names), _same(df_keys, names), "left_anti")
    return df.where(~may).union(rest)
