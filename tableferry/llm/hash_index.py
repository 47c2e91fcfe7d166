"""Nearest neighbours by multi-index hashing: binary codes cut into substrings, each indexed by its values.

Rotations learned from a bounded sample turn vectors into codes whose bits follow
the data's main directions. If two codes differ in ``r`` bits and the substrings
have reaches that sum up to more than ``r`` less their number, one substring at
least is within its reach; so a join of the rows' substring values with those
that queries probe retrieves every code within the radius. The vectors of the
few that may be among the nearest are fetched and ranked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.sources.scratch import stored

BITS, SUBSTRING_BITS = 256, 16
PARTS = BITS // SUBSTRING_BITS
# Rows that codes and radii are learned from, at most about so many, and queries tried on them.
FIT_ROWS, FIT_QUERIES = 10_000, 256
FIT_RECALL = 0.97
# The part of these queries, those with the farthest neighbours, that has to reach a recall by itself.
HARD_PART, HARD_RECALL = 0.1, 0.9
# Rows of the index and queries that one task compares at a time.
BLOCK_ROWS, QUERY_ROWS = 8_192, 4_096
CODED = "vec_id long, code binary, sketch binary, scale double, rest double, keys array<int>"
ASKING = "query_id long, code binary, vec array<double>, radius int, keys array<int>"


def _lift(rows: np.ndarray, longest: float) -> np.ndarray:
    """One more dimension gives all rows the same length, so that the largest product is the smallest angle."""
    rest = np.sqrt(np.maximum(longest**2 - (rows**2).sum(axis=1), 0.0))
    return np.column_stack([rows, rest])


def _aim(queries: np.ndarray, longest: float) -> np.ndarray:
    lengths = np.sqrt((queries**2).sum(axis=1, keepdims=True))
    return np.column_stack([queries * (longest / lengths), np.zeros(len(queries))])


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, the same for equal rows wherever they stand."""
    return (rows * query).sum(axis=1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]


@dataclass
class Codes:
    """Learned rotations to binary codes, and what tells the radius of a query."""

    mean: np.ndarray
    rotation: np.ndarray
    longest: float
    sample_ids: np.ndarray
    sample: np.ndarray
    near: int
    margin: int

    def of(self, lifted: np.ndarray) -> np.ndarray:
        """Codes as rows of four 64-bit words, the same as 16 substrings in turn."""
        return np.packbits((lifted - self.mean) @ self.rotation > 0, axis=1, bitorder="little").view("<u8")

    def radius(self, query_id: object, code: np.ndarray) -> int:
        """The distance of the nearest codes of the sample, and the margin that holds the nearest vectors.

        The sample is part of the table, so at least as many codes are within it.
        """
        apart = distances(self.sample, code)[self.sample_ids != query_id]
        if not self.near or len(apart) < self.near:
            return BITS
        return int(min(BITS, np.partition(apart, self.near - 1)[self.near - 1] + self.margin))


def distances(coded: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Bits in which codes differ from one."""
    return np.bitwise_count(coded ^ code).sum(axis=1, dtype=np.int64)


def fit(
    sample: np.ndarray, longest: float, k: int, rounds: int = 20, recall: float = FIT_RECALL, ids: np.ndarray | None = None
) -> Codes:
    """Rotations of the principal directions under which signs lose least; the margin from exact neighbours.

    Vectors have fewer dimensions than codes have bits, so several rotations are
    learned, each from a start of its own. The queries tried are spread over the
    whole sample, whatever its order. The margin holds the recall over all of
    them, and a lower one for the hardest alone; beside a query's nearest codes it
    gives rows with close copies a small radius, and those far from all others a
    large one. Neighbours within a sample are farther than within the table, so the radius
    errs to the safe side.
    """
    ids = np.arange(len(sample)) if ids is None else ids
    lifted = _lift(sample, longest)
    mean = lifted.mean(axis=0)
    centred = lifted - mean
    _, _, directions = np.linalg.svd(centred.T @ centred)
    main = directions[: min(64, lifted.shape[1])].T
    flat = centred @ main
    turns = []
    for seed in range(-(-BITS // main.shape[1])):
        rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((main.shape[1], main.shape[1])))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(flat @ rotation > 0, 1.0, -1.0).T @ flat)
            rotation = (left @ right).T
        turns.append(main @ rotation)
    near = min(k, len(sample) - 1)
    codes = Codes(mean, np.hstack(turns)[:, :BITS], longest, ids, np.empty((0, BITS // 64), "<u8"), near, 0)
    codes.sample = codes.of(lifted)
    if not near:
        return codes
    tried = np.random.default_rng(1).choice(len(sample), min(FIT_QUERIES, len(sample)), replace=False)
    beyond = []
    for i, code in zip(tried, codes.of(_aim(sample[tried], longest))):
        scores, apart = products(sample, sample[i]), distances(codes.sample, code)
        scores[i], apart[i] = -np.inf, BITS
        nearest = best(scores, np.arange(len(scores)), near)
        beyond.append(apart[nearest] - np.partition(apart, near - 1)[near - 1])
    hardest = sorted(beyond, key=np.mean)[-max(1, round(HARD_PART * len(beyond))) :]
    margin = max(np.quantile(np.concatenate(beyond), recall), np.quantile(np.concatenate(hardest), HARD_RECALL))
    codes.margin = max(0, ceil(margin))
    return codes


def reaches(radius: int, depth: int) -> np.ndarray:
    """How many bits each substring may differ in, -1 for none, so that no code within the radius is missed.

    The index is cut by the first ``depth`` bits of each substring. Equal reaches
    are taken where they meet fewer of its cuts than one substring has; else
    one substring is searched whole, which finds every code.
    """
    reach = (radius + 1) // PARTS - 1 + (np.arange(PARTS) < (radius + 1) % PARTS)
    reach = np.minimum(reach, SUBSTRING_BITS)
    near = np.bitwise_count(np.arange(1 << depth))
    if sum((near <= t).sum() for t in reach) < 1 << depth:
        return reach
    return np.where(np.arange(PARTS) == 0, SUBSTRING_BITS, -1)


def _keys(substrings: np.ndarray, depth: int) -> np.ndarray:
    """The cut of the index each substring belongs to: its number and its first bits."""
    first = substrings.astype(np.int32) >> (SUBSTRING_BITS - depth)
    return (np.arange(PARTS, dtype=np.int32) << SUBSTRING_BITS) + first


def indexed(rows: DataFrame, codes: Codes, depth: int) -> DataFrame:
    """Code, coarse vector and cuts of each row of ``vec_id, vec``.

    The coarse vector has a byte a component; ``rest`` is the length of what it leaves out.
    """

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            vecs = np.stack(batch["vec"].to_list())
            coded = codes.of(_lift(vecs, codes.longest))
            scale = np.maximum(np.abs(vecs).max(axis=1) / 127, np.finfo(float).tiny)
            coarse = np.rint(vecs / scale[:, None]).astype(np.int8)
            rest = np.sqrt(((vecs - coarse * scale[:, None]) ** 2).sum(axis=1))
            yield pd.DataFrame({
                "vec_id": batch["vec_id"], "code": [c.tobytes() for c in coded], "sketch": [c.tobytes() for c in coarse],
                "scale": scale, "rest": rest, "keys": list(_keys(coded.view("<u2"), depth)),
            })

    return rows.select("vec_id", "vec").mapInPandas(build, CODED)


def probing(queries: DataFrame, codes: Codes, depth: int) -> DataFrame:
    """Code, radius and the cuts of the index to search for each row of ``vec_id, vec``."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cuts = np.arange(1 << depth, dtype=np.int32)
        for batch in batches:
            if not len(batch):
                continue
            vecs = np.stack(batch["vec"].to_list())
            coded = codes.of(_aim(vecs, codes.longest))
            radii = [codes.radius(i, c) for i, c in zip(batch["vec_id"], coded)]
            keys = []
            for radius, own in zip(radii, _keys(coded.view("<u2"), depth)):
                within = [own[i] ^ cuts[np.bitwise_count(cuts) <= t] for i, t in enumerate(reaches(radius, depth))]
                keys.append(np.concatenate(within))
            yield pd.DataFrame({
                "query_id": batch["vec_id"], "code": [c.tobytes() for c in coded], "vec": list(vecs), "radius": radii, "keys": keys,
            })

    return queries.select("vec_id", "vec").mapInPandas(build, ASKING)


def _words(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def _numbers(count: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), count - 1)


def retrieve(index: DataFrame, probes: DataFrame, depth: int, k: int | None) -> DataFrame:
    """``query_id, vec_id`` of codes within the queries' radius, found by a join on the cuts of the index.

    A pair may be found in several cuts and comes once. With ``k``, of a cut's
    rows only those come that can be among the query's ``k`` nearest, as told by the coarse
    vectors and the most they can be wrong; none of the nearest is lost. Cuts with many rows
    or queries are dealt out, so no task compares more than a block and a set.
    """
    held = index.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n_rows"))
    asked = probes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n_asked"))
    sizes = held.join(asked, "key").select(
        "key",
        F.ceil(F.col("n_rows") / BLOCK_ROWS).alias("blocks"),
        F.ceil(F.col("n_asked") / QUERY_ROWS).alias("sets"),
    )
    # stored, so that joins with it have two fresh exchanges and common cuts can be split
    sizes, _ = stored(sizes, "cuts")
    left = index.withColumn("key", F.explode("keys")).drop("keys").join(sizes, "key")
    left = left.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.col("blocks")))
    left = left.withColumn("set", F.explode(_numbers(F.col("sets")))).drop("blocks", "sets")
    right = probes.withColumn("key", F.explode("keys")).drop("keys").join(sizes, "key")
    right = right.withColumn("set", F.pmod(F.xxhash64(F.lit("set"), "query_id"), F.col("sets")))
    right = right.withColumn("block", F.explode(_numbers(F.col("blocks")))).drop("blocks", "sets")

    def meet(rows: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asking):
            return pd.DataFrame({"query_id": [], "vec_id": []})
        part = int(rows["key"].iloc[0]) >> SUBSTRING_BITS
        ids, coded, coarse = rows["vec_id"].to_numpy(), _words(rows["code"], "<u8"), _words(rows["sketch"], np.int8)
        scale, rest = rows["scale"].to_numpy(), rows["rest"].to_numpy()
        own = np.ascontiguousarray(coded.view("<u2")[:, part])
        pairs = []
        for one in asking.itertuples():
            code = np.frombuffer(one.code, "<u8")
            reach = reaches(one.radius, depth)[part]
            found = np.arange(len(ids)) if reach >= SUBSTRING_BITS else (
                np.flatnonzero(np.bitwise_count(own ^ code.view("<u2")[part]) <= reach)
            )
            found = found[(distances(coded[found], code) <= one.radius) & (ids[found] != one.query_id)]
            if k is not None and len(found) > k:
                length = np.sqrt((one.vec**2).sum())
                score = (coarse[found] * one.vec).sum(axis=1) * scale[found]
                # what the byte leaves out, and rounding
                wrong = length * (rest[found] + 1e-9 * scale[found] * 127 * len(one.vec))
                found = found[score + wrong >= np.partition(score - wrong, -k)[-k]]
            pairs.append(pd.DataFrame({"query_id": one.query_id, "vec_id": ids[found]}))
        return pd.concat(pairs)

    met = left.groupBy("key", "block", "set").cogroup(right.groupBy("key", "block", "set"))
    return met.applyInPandas(meet, "query_id long, vec_id long").distinct()


def _usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0)


def search(
    vectors: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 20,
    fit_rows: int = FIT_ROWS,
    recall: float = FIT_RECALL,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``queries`` selects its k nearest among the others.

    Nearest is the largest inner product, ties to the smaller id. Vectors that
    are null, empty or zero, or hold a null or non-finite component, take no
    part, nor do rows without an id or with another length than most rows have.
    Of rows with one id the smallest vector counts. Other columns are ignored.

    The sample, about ``fit_rows`` rows, decides codes and radii; every row is
    indexed. Index and queries meet by a join on substring values, without the
    vectors of rows; those are fetched for the pairs that may be among the nearest.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"), queries.alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("vec")))
    sizes = rows.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vec") == sizes["size"])
    rows = rows.groupBy("vec_id").agg(F.min("vec").alias("vec"), F.max(F.coalesce("asks", F.lit(False))).alias("asks"))
    rows, _ = stored(rows.withColumn("vec_id", F.col("vec_id").cast("long")), "vectors")
    facts = rows.agg(
        F.count("*").alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("longest")
    ).first()
    share = fit_rows / facts["n"]
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("fit"), "vec_id"), F.lit(1 << 30)) < share * (1 << 30)) if share < 1 else rows
    sample = drawn.orderBy("vec_id").toPandas()
    longest = float(np.sqrt(facts["longest"]))
    codes = fit(np.stack(sample["vec"].to_list()), longest, k, recall=recall, ids=sample["vec_id"].to_numpy())

    # as many cuts as there are blocks, so that a spread substring fills them evenly
    depth = min(SUBSTRING_BITS, max(0, ceil(log2(facts["n"] / BLOCK_ROWS))))
    index, _ = stored(indexed(rows, codes, depth), "codes")
    probes, _ = stored(probing(rows.where("asks"), codes, depth), "probes")
    pairs, _ = stored(retrieve(index, probes, depth, k), "pairs")
    near = pairs.join(rows.select("vec_id", F.col("vec").alias("there")), "vec_id")
    near = near.join(rows.where("asks").select(F.col("vec_id").alias("query_id"), "vec"), "query_id")
    product = F.aggregate(F.zip_with("vec", "there", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    # stored, so that the join's partitions are not those of the ranking and one query's many pairs can be split
    found, _ = stored(near.select("query_id", "vec_id", product.alias("score")), "scored")
    order = "row_number() over (partition by query_id order by score desc, vec_id)"
    return found.withColumn("rank", F.expr(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
