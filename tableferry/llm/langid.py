"""Language by rank-order profiles: a text's most frequent n-grams against each language's."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tableferry.llm.slices import text_slices

UNKNOWN = "und"
SPACE = 32
# The driver holds a profile of each language; more distinct labels than this are refused.
MOST_LANGUAGES = 10_000
# characters counted together; the counts of a longer text's pieces are summed and equal those of the whole
PIECE = 1 << 20
# a code point takes 21 bits, so three fit a key
SHIFT = np.uint64(21)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _piece_grams(codes: np.ndarray, before: int) -> np.ndarray:
    """Keys of the 1- to 3-grams that end after the first ``before`` characters; a word has a space on each side."""
    space, codes = codes == SPACE, codes.astype(np.uint64)
    two = codes[:-1] | (codes[1:] << SHIFT)
    three = two[:-1] | (codes[2:] << (SHIFT + SHIFT))
    return np.concatenate([codes[before:][~space[before:]], two[max(before - 1, 0) :], three[~space[1:-1]]])


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a whole text as keys in order, and their counts; none without a letter."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype="<u4")
    keys, counts = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    # the last characters kept, so that n-grams across a cut count too
    tail = np.empty(0, dtype=np.uint32)
    for start in range(0, len(codes), PIECE):
        piece = codes[start : start + PIECE]
        piece = np.where(_letters()[piece], piece, np.uint32(SPACE))
        space = piece == SPACE
        kept = np.r_[tail, piece[~(space & np.r_[tail[-1:] == SPACE if len(tail) else False, space[:-1]])]]
        found = np.sort(_piece_grams(kept, len(tail)))
        tail = kept[-2:]
        if not len(found):
            continue
        at = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
        new_keys, new_counts = found[at], np.diff(np.r_[at, len(found)])
        if len(keys):
            merged = np.concatenate([keys, new_keys])
            keys, where = np.unique(merged, return_inverse=True)
            counts = np.bincount(where, weights=np.concatenate([counts, new_counts])).astype(np.int64)
        else:
            keys, counts = new_keys, new_counts
    return keys, counts


def _ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent keys first; equal counts in key order."""
    return keys[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """For each language the rank of its most frequent n-grams."""

    def __init__(self, ranked: dict[str, list[int]], size: int):
        self.size = size
        self.names = sorted(ranked)
        tables = [np.array(ranked[name], dtype=np.int64).view(np.uint64)[:size] for name in self.names]
        orders = [np.argsort(t, kind="stable") for t in tables]
        self.tables = [(t[o], o) for t, o in zip(tables, orders)]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and how near it is, from 0 (shares no n-gram) to 1."""
        if not self.names or not text or not (any(map(str.isalpha, text[:64])) or any(map(str.isalpha, text))):
            return UNKNOWN, 0.0
        top = _ranked(*grams(text), self.size)
        rank = np.arange(len(top))
        best, best_distance = UNKNOWN, len(top) * self.size + 1
        for name, (keys, ranks) in zip(self.names, self.tables):
            at = np.minimum(np.searchsorted(keys, top), len(keys) - 1)
            out = np.where(keys[at] == top, np.abs(ranks[at] - rank), self.size)
            distance = int(np.minimum(out, self.size).sum())
            if distance < best_distance:
                best, best_distance = name, distance
        return best, 1.0 - best_distance / (len(top) * self.size)


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(id_col.cast("string")) % 4


def learn(labelled: DataFrame, text_col: str, lang_col: str, key_col: str, size: int = 400, fit_rows: int = 3000) -> Profiles:
    """Profiles of every language found among the labelled rows.

    Each language is learned from about ``fit_rows`` of its rows, those with the
    smallest hashes of ``key_col`` (all, where there are fewer); a row with a
    null language, text or key teaches nothing. The n-gram counts of these are
    summed by Spark; the driver receives ``size`` n-grams per language.
    """
    rows = labelled.select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(key_col).cast("string").alias("key")
    ).dropna()
    spread = F.pmod(F.xxhash64(F.lit("fit"), "key"), F.lit(1 << 30)) / float(1 << 30)
    shares = rows.groupBy("lang").agg((F.lit(float(fit_rows)) / F.count("*")).alias("share"))
    shares = shares.limit(MOST_LANGUAGES + 1).collect()
    if len(shares) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    shares = labelled.sparkSession.createDataFrame(shares, "lang string, share double")
    # bounded just above; rows are picked where they are, and no text is shuffled
    fit = rows.withColumn("spread", spread).join(F.broadcast(shares), "lang").where(F.col("spread") < F.col("share"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            held: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(lang, []).append(grams(text.as_py()))
            for lang, found in held.items():
                keys, where = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                sums = np.bincount(where, weights=np.concatenate([c for _, c in found])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(sums)],
                    ["lang", "gram", "n"],
                )

    counted = fit.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    summed = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = summed.withColumn("place", F.row_number().over(place)).where(F.col("place") <= size)
    ranked: dict[str, list[int]] = {}
    for row in sorted(top.collect(), key=lambda r: (r["lang"], r["place"])):
        ranked.setdefault(row["lang"], []).append(row["gram"])
    return Profiles(ranked, size)


def with_language(docs: DataFrame, text_col: str, profiles: Profiles, lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """Add the predicted language and its score, from the whole text alone.

    ``und`` with score 0 where the text is null or has no letter, or nothing was
    learned. Equal distances go to the language first in the alphabet. Columns
    of the two names are replaced. Rows stay where they are.
    """
    others = [c for c in docs.columns if c not in (lang_col, score_col)]
    text_at = others.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_at):
            found = [profiles.predict(t.as_py()) for t in batch.column(text_at)]
            langs, scores = pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, langs, scores], [*others, lang_col, score_col])

    fields = [docs.schema[c] for c in others] + [
        T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType()),
    ]
    return docs.select(*[F.col(f"`{c}`") for c in others]).mapInArrow(run, T.StructType(fields))


def learn_unheld(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fit) -> Profiles:
    """Learn from the labelled rows that have an id and are not held out."""
    return learn(docs.where(remainder(F.col(id_col)) != 2), text_col, lang_col, id_col, **fit)


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fit) -> DataFrame:
    """Learn from the rows that are not held out and predict for all: adds ``held_out, lang_pred, score``.

    Held out are the rows whose id has remainder 2. A row without id is neither
    held out nor learned from.
    """
    found = with_language(docs, text_col, learn_unheld(docs, id_col, text_col, lang_col, **fit))
    return found.withColumn("held_out", F.coalesce(remainder(F.col(id_col)) == 2, F.lit(False)))
