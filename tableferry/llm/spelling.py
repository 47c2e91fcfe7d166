"""Spelling variants: words one edit apart, found through blocked Gram matrices of letter counts.

An edit changes the counts of two letters at most, each by one: two words of the
same length that differ in one letter have squared distance 2 between their
letter counts, two of adjacent lengths that differ by one letter have 1. The
letters are dealt to a few groups; an edit leaves all but two of them untouched,
so words that are near agree on the counts of some ``groups - 2`` groups. Words
are blocked by these counts and by length, a block's squared distances come from
one matrix product, and what is near enough is compared letter by letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.sources.scratch import discard, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-zÀ-ÿ"
# Words of a block whose product is taken at once; a larger block is cut into tiles that meet pairwise.
TILE = 2048
PAIRS_AT_ONCE = 1 << 17
# no letter is beyond U+00FF
CODES = 256


def _runs(text: Column) -> Column:
    """The maximal runs of letters of a text, one a row; the ends may be empty."""
    return F.explode(F.split(text, f"[^{LETTERS}]+"))


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 31, min_length: int = 7) -> DataFrame:
    """One row (``word``) per run of letters of the whole texts that gives a word of ``min_length`` or more.

    A-Z are lower-cased, no other letter. Where ``every`` divides the crc32 of
    ``<id>:<run>``, one letter is deleted, at the crc32 modulo the length. A null
    text has no words; a null id reads as empty text.
    """
    ids = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(ids.alias("id"), _runs(F.col(text_col)).alias("run")).where(F.length("run") >= min_length)
    # lower() agrees with the rule on ASCII and is much faster
    ascii_only = F.octet_length("run") == F.length("run")
    runs = runs.select("id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= min_length)


def letter_groups(words: DataFrame, groups: int) -> list[str]:
    """The letters of the words dealt to groups of about equal weight; the driver sees a row a letter (90 at most)."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where(F.col("letter") != "")
    counts = letters.groupBy("letter").count().collect()
    dealt, weight = [""] * groups, [0] * groups
    for letter, count in sorted(counts, key=lambda r: (-r[1], r[0])):
        lightest = weight.index(min(weight))
        dealt[lightest] += letter
        weight[lightest] += count
    return dealt


class _Block:
    """Words of one length as letter counts and as codes."""

    def __init__(self, words: list[str], length: int, group_of: np.ndarray):
        self.words = words
        codes = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), length)
        self.codes = codes
        flat = np.arange(len(words))[:, None] * CODES + codes
        counts = np.bincount(flat.ravel(), minlength=len(words) * CODES).reshape(len(words), CODES)
        self.counts = counts.astype(np.float32)
        self.squares = (self.counts * self.counts).sum(axis=1)


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the equal starts and the equal ends cover the shorter word."""
    head = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= short.shape[1]


def _near(a: _Block, b: _Block, combo: int, combos: list[tuple[int, ...]], in_group: np.ndarray, upper: bool) -> Iterator[tuple]:
    """Index pairs of near words of two blocks, of those that this combination of groups answers for."""
    replaced = a.codes.shape[1] == b.codes.shape[1]
    # letters no word of the block has add nothing
    used = np.flatnonzero(a.counts.any(axis=0) | b.counts.any(axis=0))
    distance = a.squares[:, None] + b.squares[None, :] - 2 * (a.counts[:, used] @ b.counts[:, used].T)
    close = distance == (2 if replaced else 1)
    if upper:
        close = np.triu(close, 1)
    at, to = np.nonzero(close)
    for start in range(0, len(at), PAIRS_AT_ONCE):
        i, j = at[start : start + PAIRS_AT_ONCE], to[start : start + PAIRS_AT_ONCE]
        same = (_one_replaced if replaced else _one_inserted)(a.codes[i], b.codes[j])
        i, j = i[same], j[same]
        touched = (np.abs(a.counts[i] - b.counts[j]) @ in_group) > 0
        # the first combination left untouched answers for the pair, so no pair counts twice
        answers = np.full(len(i), -1)
        for number in range(len(combos) - 1, -1, -1):
            answers[~touched[:, list(combos[number])].any(axis=1)] = number
        mine = answers == combo
        yield i[mine], j[mine]


def _block_links(rows: list[tuple], combos: list, in_group: np.ndarray) -> list[tuple]:
    """``(word, n_near, near_n, near)`` over the pairs of one block: how many, and the best of them.

    A row is (combo, first tile, second tile, tile, longer, word, n); words of
    tile ``first`` meet those of tile ``second``.
    """
    combo, first, second = rows[0][:3]
    words = [r[5] for r in rows]
    ns = np.array([r[6] for r in rows], dtype=np.int64)
    # the largest n first, ties by code points
    order = sorted(range(len(rows)), key=lambda r: (-rows[r][6], words[r]))
    rank = np.empty(len(rows), dtype=np.int64)
    rank[order] = np.arange(len(rows))
    parts: dict[tuple, list[int]] = {}
    for place, row in enumerate(rows):
        parts.setdefault((row[3], row[4]), []).append(place)
    blocks = {k: (_Block([words[p] for p in v], len(words[v[0]]), in_group), np.array(v)) for k, v in parts.items()}
    if first == second:
        meets = [((first, False), (first, False), True), ((first, False), (first, True), False)]
    else:
        meets = [((x, False), (y, longer), False) for x, y, longer in
                 ((first, second, False), (first, second, True), (second, first, True))]
    found = np.zeros(len(rows), dtype=np.int64)
    best = np.full(len(rows), len(rows), dtype=np.int64)
    for left, right, upper in meets:
        if left not in blocks or right not in blocks:
            continue
        (a, a_at), (b, b_at) = blocks[left], blocks[right]
        for i, j in _near(a, b, combo, combos, in_group, upper):
            i, j = a_at[i], b_at[j]
            for x, y in ((i, j), (j, i)):
                found += np.bincount(x, minlength=len(rows))
                np.minimum.at(best, x, rank[y])
    return [
        (words[p], int(found[p]), int(ns[order[best[p]]]), words[order[best[p]]]) for p in np.flatnonzero(found).tolist()
    ]


def near_words(words: DataFrame, groups: int = 3, tile: int = TILE) -> DataFrame:
    """``word, n_near, near_n, near`` of every word that has a word one edit apart; of distinct ``word, n``.

    ``near`` is the near word of largest n, ties by code points. Every pair of
    words is met in one block at least and counted in one. A block of more than
    about ``tile`` words is dealt out by tile pairs, so a task never holds more
    than two tiles of each length.
    """
    if groups < 3:
        raise ValueError("an edit touches two groups: at least 3 are needed")
    dealt = letter_groups(words, groups)
    everything = "".join(dealt)
    combos = list(combinations(range(groups), groups - 2))
    in_group = np.zeros((CODES, groups), dtype=np.float32)
    for g, letters in enumerate(dealt):
        in_group[[ord(c) for c in letters], g] = 1

    def signature(combo: tuple[int, ...]) -> Column:
        """The word's letters that are in the groups, in order: its counts of them."""
        mine = "".join(dealt[g] for g in combo)
        rest = "".join(c for c in everything if c not in mine)
        # translate() without a replacement deletes
        own = F.translate("word", rest, "") if rest else F.col("word")
        return F.array_join(F.array_sort(F.split(own, "")), "")

    keyed = words.select(
        "word", "n", F.explode(F.array(*[F.struct(F.lit(c).alias("combo"), signature(g).alias("sig")) for c, g in enumerate(combos)])).alias("k")
    )
    # a word meets those of its own length, and one longer
    keyed = keyed.select("word", "n", "k.*", F.explode(F.array(F.lit(False), F.lit(True))).alias("longer"))
    length = F.length("word") - F.col("longer").cast("int")
    # equal hashes of different counts only put more words into a block
    keyed = keyed.select("word", "n", "combo", "longer", F.xxhash64("combo", length, "sig").alias("block"))
    crowded = keyed.groupBy("block").agg(F.ceil(F.count("*") / (2 * tile)).cast("int").alias("tiles")).where("tiles > 1")
    # stored, so that the join has two fresh exchanges and the rows of one block can be split
    crowded, crowded_at = stored(crowded.withColumnRenamed("block", "of"), "spelling-crowded")
    tiled = keyed.join(crowded, F.col("block") == F.col("of"), "left").drop("of")
    tiled = tiled.withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64(F.lit("tile"), "word"), "tiles").cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.select(
        "block", "combo", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"),
        "tile", "longer", "word", "n",
    )
    place = ["block", "first", "second"]
    dealt_out = tiled.repartition(*place).sortWithinPartitions(*place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out: list[tuple] = []
        # rows of one hash may be of two combinations
        for _, block in groupby(rows(), key=lambda r: (r[0], r[2], r[3])):
            held: dict[int, list[tuple]] = {}
            for r in block:
                held.setdefault(r[1], []).append(r[1:])
            for mine in held.values():
                if len(mine) > 1:
                    # rows of one hash may be of different lengths
                    out += _by_length(mine, combos, in_group)
            if len(out) > 50_000:
                yield _links_batch(out)
                out = []
        yield _links_batch(out)

    links = dealt_out.mapInArrow(run, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("down"), "near"))
    found, _ = stored(links.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")), "spelling-near")
    discard(words.sparkSession, crowded_at)
    return found.select("word", "n_near", (-F.col("best.down")).alias("near_n"), F.col("best.near").alias("near"))


def _by_length(rows: list[tuple], combos: list, in_group: np.ndarray) -> list[tuple]:
    """Links of the rows of one block, taken by the length the block stands for."""
    lengths: dict[int, list[tuple]] = {}
    for r in rows:
        lengths.setdefault(len(r[5]) - r[4], []).append(r)
    return [link for mine in lengths.values() if len(mine) > 1 for link in _block_links(mine, combos, in_group)]


def _links_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n_near", "near_n", "near"])


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every row of ``word, form``: the form reached by following forms to the last.

    Each round doubles the steps taken and is one join, kept in the shared
    folder; the rounds grow with the logarithm of the longest chain, which the
    growth of n from word to form keeps short. The driver sees one count a round.
    """
    spark = forms.sparkSession
    at, path = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = at.select(F.col("word").alias("via"), F.col("root").alias("onto"))
        step = at.join(onward, F.col("root") == F.col("via"), "left")
        nxt, nxt_path = stored(
            step.select("word", F.coalesce("onto", "root").alias("root"), F.col("onto").isNotNull().alias("moved")), "spelling-roots"
        )
        moved = not nxt.where("moved").isEmpty()
        discard(spark, path)
        at, path = nxt.select("word", "root"), nxt_path
        if not moved:
            return at


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    every: int = 31,
    min_length: int = 7,
    min_count: int = 2,
    factor: int = 10,
    groups: int = 3,
    tile: int = TILE,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every distinct word of the texts that occurs ``min_count`` times.

    Words are those of :func:`words_of`; two are near if one inserted, deleted or
    replaced letter makes one the other. The ``form`` of a word is its near word
    of largest n (ties: the smallest), if that is at least ``factor`` times its
    own n, and null otherwise; ``root`` is reached by following forms, the word
    itself if it has none. ``n_near`` counts the near words. Null and empty
    texts, and an empty table, give no words; repeated rows count again; other
    columns are ignored, whatever their names.
    """
    counted = words_of(docs, id_col, text_col, every, min_length).groupBy("word").agg(F.count("*").alias("n"))
    words, _ = stored(counted.where(F.col("n") >= min_count), "spelling-words")
    near = near_words(words, groups, tile).withColumnRenamed("word", "of")
    has_form = F.col("near_n") >= factor * F.col("n")
    known, _ = stored(
        words.join(near, F.col("word") == F.col("of"), "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(has_form, F.col("near")).alias("form"),
            F.when(has_form, F.col("near_n")).alias("form_n"),
        ),
        "spelling-known",
    )
    last = roots(known.where(F.col("form").isNotNull())).withColumnRenamed("word", "of")
    return known.join(last, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
