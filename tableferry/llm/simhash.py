"""SimHash near-duplicates, with candidates pruned by the pigeonring principle.

A fingerprint's 64 bits are cut into ``max_distance + 1`` segments laid on a
ring. If two fingerprints differ in at most ``max_distance`` bits, some segment
starts a chain whose first ``l`` segments differ, for every ``l``, in at most
``l * max_distance / segments`` bits. The first segment of that chain is equal
and the first two differ in one bit at most, which makes an equi-join key; the
longer prefixes prune what the join finds before the full distance is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.llm.components import connected_components
from tableferry.llm.slices import text_slices
from tableferry.operators.keyfilter import rows_with_keys, rows_without_keys
from tableferry.sources.scratch import discard, stored

SEED = 42
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
HASHES_AT_ONCE = 1 << 16
# A bucket with more fingerprints than this is not paired up; see ball_links.
BUCKET_LIMIT = 32


def _hashes(text: bytes, size: int) -> Iterator[int]:
    """XXH64 of each shingle; bytes.split() cuts at space and \\x09-\\x0D, as the words are defined."""
    words = text.translate(LOWER).split()
    if not words:
        return
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        yield digest(joined, SEED)
        return
    starts = chain((0,), (e + 1 for e in ends))
    for start, end in zip(starts, ends[size - 1 :]):
        yield digest(joined[start:end], SEED)


def fingerprint(text: bytes | None, size: int) -> int:
    """The signed 64-bit fingerprint; zero where there is no word."""
    ones, total = np.zeros(64, dtype=np.int64), 0
    hashes = _hashes(text or b"", size)
    while True:
        block = np.fromiter((h for _, h in zip(range(HASHES_AT_ONCE), hashes)), dtype="<u8")
        if not len(block):
            break
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
        total += len(block)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int = 4) -> DataFrame:
    """``doc_id, text_key, fp`` of every row, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            fps = (fingerprint(v.as_py(), shingle_words) for v in batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(list(fps), pa.int64())], ["doc_id", "text_key", "fp"]
            )

    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType),
        T.StructField("text_key", T.StringType()), T.StructField("fp", T.LongType()),
    ])
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.sha2(text_col, 256).alias("text_key")
    )
    return rows.mapInArrow(run, schema)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _segments(count: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    widths = [64 // count + (i < 64 % count) for i in range(count)]
    return list(zip(accumulate([0, *widths[:-1]]), widths))


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def _ring(max_distance: int) -> list[list[list[int]]]:
    """For each start, the bits of the chain's first, first two, ... segments."""
    segments = [list(range(at, at + width)) for at, width in _segments(max_distance + 1)]
    n = len(segments)
    return [
        [[b for k in range(length) for b in segments[(start + k) % n]] for length in range(1, n + 1)]
        for start in range(n)
    ]


def _by_start(values: list[int], start: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), start + 1)


def near_pairs(fps: DataFrame, max_distance: int, limit: int = BUCKET_LIMIT) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a < b`` of distinct fingerprints within the distance, and those left to :func:`ball_links`.

    ``fps`` holds distinct values of ``fp``. A pair meets where the key of one,
    as it is, equals the key of the other with at most one bit of the second
    segment flipped. Keys shared by more than ``limit`` fingerprints make no
    pairs: the second result holds every fingerprint that has or probes such a key.
    """
    ring = _ring(max_distance)
    starts = range(len(ring))
    key = F.col("fp").bitwiseAND(_by_start([_mask(c[1]) for c in ring], F.col("start")))
    indexed = fps.select("fp", F.explode(F.array(*[F.lit(s) for s in starts])).alias("start")).select(
        "start", key.alias("key"), F.col("fp").alias("a")
    )
    flips = F.array(*[
        F.struct(F.lit(s).alias("start"), F.lit(f).cast("long").alias("flip"))
        for s, c in enumerate(ring)
        for f in [0, *(_signed(1 << b) for b in c[1][len(c[0]) :])]
    ])
    probes = fps.select("fp", F.explode(flips).alias("p")).select(
        F.col("p.start").alias("start"), "fp", F.col("p.flip").alias("flip")
    )
    probes = probes.select("start", key.bitwiseXOR(F.col("flip")).alias("key"), F.col("fp").alias("b"))

    crowded = indexed.groupBy("start", "key").count().where(F.col("count") > limit).select("start", "key")
    # stored, so that a join with it has two fresh exchanges and a crowded key can be split
    crowded, _ = stored(crowded, "simhash-crowded")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    n = len(ring)
    chain_ok = [
        F.bit_count(differ.bitwiseAND(_by_start([_mask(c[length - 1]) for c in ring], F.col("start"))))
        <= length * max_distance // n
        for length in range(1, n + 1)
    ]
    found = probes.join(crowded, ["start", "key"], "left_anti").join(indexed, ["start", "key"])
    found = found.where(F.col("a") < F.col("b"))
    for ok in chain_ok:
        found = found.where(ok)
    probing = probes.join(crowded, ["start", "key"], "left_semi").select(F.col("b").alias("fp"))
    return found.select("a", "b").distinct(), probing.distinct()


def ball_links(fps: DataFrame, max_distance: int) -> DataFrame:
    """Links between distinct fingerprints of crowded buckets, without pairing them up.

    Two values are within ``2 r`` bits exactly if some value is within ``r`` bits
    of both. All that share such a middle are within ``2 r`` of each other, so
    each is linked to the smallest of them. A middle has at most as many
    neighbours as there are values within ``r`` bits, 2,081 for two bits: the
    work grows with the rows whatever the size of a group of near copies.
    """
    near = fps.select("fp", F.col("fp").alias("middle"), F.lit(0).alias("at"))
    for _ in range(max_distance // 2):
        # bit 64 stands for no flip
        near = near.select("fp", "middle", F.explode(F.sequence("at", F.lit(64))).alias("bit"))
        flip = F.when(F.col("bit") < 64, F.expr("shiftleft(1L, bit)")).otherwise(F.lit(0).cast("long"))
        near = near.select(
            "fp",
            F.col("middle").bitwiseXOR(flip).alias("middle"),
            F.least(F.col("bit") + 1, F.lit(64)).alias("at"),
        )
    groups = near.groupBy("middle").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    links = groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    return links.where(F.col("a") < F.col("b")).distinct()


def _components(rows: DataFrame, max_distance: int, bucket_limit: int) -> tuple[DataFrame, str]:
    """``fp, component_key, component_id`` of the fingerprints whose component has more than one row, stored, and its path."""
    spark = rows.sparkSession
    smallest = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    smallest, smallest_at = stored(smallest, "simhash-distinct")
    if max_distance:
        pairs, crowded = near_pairs(smallest.select("fp"), max_distance, bucket_limit)
        parts = connected_components(pairs.union(ball_links(crowded, max_distance)), "a", "b")
        keyed = smallest.join(parts, F.col("fp") == F.col("node"), "left").select(
            "fp", "first_id", "copies", F.coalesce("component", "fp").alias("component_key")
        )
    else:
        keyed = smallest.withColumn("component_key", F.col("fp"))
    # both stored, so that the join has two fresh exchanges and a large component can be split
    keyed, keyed_at = stored(keyed, "simhash-keyed")
    firsts = keyed.groupBy("component_key").agg(F.min("first_id").alias("component_id"), F.sum("copies").alias("members"))
    # only what differs from the row's own values has to reach the rows
    firsts, firsts_at = stored(firsts.where(F.col("members") > 1).select("component_key", "component_id"), "simhash-firsts")
    known, known_at = stored(keyed.join(firsts, "component_key").select("fp", "component_key", "component_id"), "simhash-known")
    for path in (smallest_at, keyed_at, firsts_at):
        discard(spark, path)
    return known, known_at


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 4,
    max_distance: int = 4,
    bucket_limit: int = BUCKET_LIMIT,
) -> DataFrame:
    """``doc_id, text_key, fp, fingerprint, component_key, component_id`` of every row.

    Documents are in one component if a chain of links leads from one to the
    other; ``component_id`` is the smallest id in it, ``component_key`` its
    smallest fingerprint. Texts that are null, empty or blank have fingerprint
    zero and link like any other. Rows repeat if they repeat in the input. A row
    without id takes part, and ``component_id`` is null if no row of its
    component has an id. ``max_distance`` must be even, 0 to 8. Other columns of
    ``docs`` are ignored, whatever their names.
    """
    if max_distance % 2 or not 0 <= max_distance <= 8:
        raise ValueError("max_distance must be even and at most 8")
    rows, _ = stored(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    known, _ = _components(rows, max_distance, bucket_limit)
    known = known.select(F.col("fp").alias("known_fp"), "component_key", "component_id")
    return rows.join(known, rows.fp == known.known_fp, "left").select(
        "doc_id",
        "text_key",
        "fp",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.coalesce("component_key", "fp").alias("component_key"),
        F.when(F.col("known_fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def first_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, max_distance: int = 4
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id.

    Rows without id come last; of rows with the same id the one whose text has
    the smallest digest stays, of wholly equal rows one. The rows to drop are
    picked by id and digest; no text is shuffled but of rows that repeat wholly.
    """
    spark = docs.sparkSession
    rows, rows_at = stored(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    known, known_at = _components(rows, max_distance, BUCKET_LIMIT)
    known = known.select(F.col("fp").alias("known_fp"), "component_key")
    # a component of one row keeps it
    members, members_at = stored(
        rows.join(known, F.col("fp") == F.col("known_fp")).groupBy("component_key", "doc_id", "text_key").agg(F.count("*").alias("times")),
        "simhash-members",
    )
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    firsts = members.groupBy("component_key").agg(F.min(order).alias("first"))
    firsts, firsts_at = stored(firsts.withColumnRenamed("component_key", "of"), "simhash-first-rows")
    picked = members.join(firsts, F.col("component_key") == F.col("of")).withColumn("is_first", order.eqNullSafe(F.col("first")))
    # the first row goes too if it repeats, and one of its copies comes back
    drop, _ = stored(picked.where(~F.col("is_first") | (F.col("times") > 1)).select("doc_id", "text_key"), "simhash-drop")
    again, _ = stored(picked.where(F.col("is_first") & (F.col("times") > 1)).select("doc_id", "text_key"), "simhash-again")
    for path in (rows_at, known_at, members_at, firsts_at):
        discard(spark, path)
    keys = [F.col(id_col), F.sha2(text_col, 256)]
    one = rows_with_keys(docs, keys, again).withColumn("__text_key", keys[1]).dropDuplicates([id_col, "__text_key"])
    return rows_without_keys(docs, keys, drop).union(one.drop("__text_key"))
