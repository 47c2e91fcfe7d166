"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text's fingerprints are the smallest hash of ``k`` words in each stretch of
``window`` words. A stretch of that length shared by two texts has the same
smallest hash in both, so joining fingerprints misses none. Hits are extended to
the stretches they stand for, and these are compared word by word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.operators.keyfilter import key_filter, rows_with_keys, rows_without_keys
from tableferry.sources.scratch import discard, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# everything below U+0080 but digits and letters
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text after lower-casing A-Z; none for null."""
    # lower() agrees with the ASCII rule on text that is all ASCII, and is much faster
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    parts = F.split(lowered, NOT_WORD)
    # only the ends can be empty
    skip = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    drop = F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
    return F.slice(parts, skip + 1, F.greatest(F.size(parts) - skip - drop, F.lit(0)))


def _stretch(words: Column, start: Column, length: Column | int) -> Column:
    """The words from a 0-based start, as one text; words hold no space."""
    return F.array_join(F.slice(words, start + 1, length), " ")


def _gram_hashes(words: Column, k: int) -> Column:
    """At each position the hash of the k words that start there (fewer near the end)."""
    return F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]))


def _winnow(hashes: Column, span: int) -> Column:
    """At each position the smallest of ``span`` hashes from there on."""
    return F.transform(hashes, lambda h, i: F.least(h, *[F.get(hashes, i + j) for j in range(1, span)]))


def _fingerprinted(texts: DataFrame, window: int, k: int) -> DataFrame:
    """Add ``words``, ``n`` and ``mins``: the winnowed hash of the stretch at each position."""
    out = texts.withColumn("words", words_of(F.col("text")))
    out = out.withColumn("n", F.coalesce(F.size("words"), F.lit(0)))
    out = out.withColumn("hashes", _gram_hashes(F.col("words"), k))
    return out.withColumn("mins", _winnow(F.col("hashes"), window - k + 1))


def _short_lengths(items: DataFrame, window: int) -> list[int]:
    """Lengths of items below the window: at most ``window - 1`` numbers."""
    short = items.where(F.col("n").between(1, window - 1)).select("n").distinct()
    return sorted(r[0] for r in short.collect())


def _text_key(text: Column) -> Column:
    return F.sha2(text, 256)


def _found(docs: DataFrame, benchmark: DataFrame, window: int, k: int) -> tuple[DataFrame, DataFrame, str]:
    """``doc_id, text_key, n_words`` of all rows, ``found_key, n_hit, items`` of the contaminated texts, both stored, and the former's path."""
    spark = docs.sparkSession
    docs = docs.withColumn("text_key", _text_key(F.col("text")))
    items = _fingerprinted(benchmark, window, k)
    sizes = [window, *_short_lengths(items, window)]
    no_marks = F.array().cast("array<bigint>")

    def mark(at: Column, size: int) -> Column:
        """What joins a stretch: the winnowed hash, or the hash of all its words if it is short."""
        return F.get("mins", at) if size == window else F.xxhash64(_stretch(F.col("words"), at, size))

    def each(size: int, empty: Column) -> Column:
        starts = F.sequence(F.lit(0), F.col("n") - size)
        return F.when(F.col("n") >= size, F.transform(starts, lambda at: mark(at, size))).otherwise(empty)

    def spans(texts: DataFrame, size: int, *keys: str) -> DataFrame:
        span = F.transform(
            F.sequence(F.lit(0), F.col("n") - size),
            lambda at: F.struct(
                at.alias("at"), mark(at, size).alias("mark"), _stretch(F.col("words"), at, size).alias("stretch")
            ),
        )
        fit = F.col("n") == size if size < window and "item" in keys else F.col("n") >= size
        rows = texts.where(fit).select(*keys, F.explode(span).alias("span"))
        return rows.select(*keys, F.lit(size).alias("size"), "span.at", "span.mark", "span.stretch")

    def all_spans(texts: DataFrame, *keys: str) -> DataFrame:
        return reduce(DataFrame.union, [spans(texts, size, *keys) for size in sizes])

    stretches = all_spans(items, "item").select("item", "size", "mark", "stretch").distinct()
    stretches, stretches_at = stored(stretches, "stretches")
    marks, marks_at = stored(stretches.select("mark").distinct(), "stretch-marks")
    texts = _fingerprinted(docs, window, k)
    winnowed = F.when(F.col("n") >= window, F.slice("mins", 1, F.col("n") - window + 1)).otherwise(no_marks)
    short = [each(size, no_marks) for size in sizes[1:]]
    index, index_at = stored(
        texts.select(
            "doc_id",
            "text_key",
            F.col("n").cast("long").alias("n_words"),
            F.array_distinct(F.concat(winnowed, *short)).alias("marks"),
        ),
        "winnow",
    )
    # the marks leave where they are read, but for those of the benchmark and few others
    met = index.select("text_key", F.explode("marks").alias("mark"))
    met = met.where(key_filter(marks, ["mark"]).may_hold(F.col("mark"))).join(marks, "mark", "left_semi")
    met, met_at = stored(met.select("text_key").distinct(), "met")

    # the texts that share a fingerprint: extend its hits and compare the words. Only these are shuffled, one copy
    # of each from a task; stored, so that words are not worked out for the others again
    close = rows_with_keys(docs.select("text_key", "text"), [F.col("text_key")], met)
    close, close_at = stored(close.groupBy("text_key").agg(F.first("text").alias("text")), "close")
    close = _fingerprinted(close, window, k)
    hits = all_spans(close, "text_key").join(stretches, ["size", "mark", "stretch"])
    hits, hits_at = stored(hits.select("text_key", "at", "size", "item").distinct(), "hits")
    places = hits.select("text_key", "at", "size").distinct()
    places = places.select("text_key", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("at"))
    n_hit = places.distinct().groupBy("text_key").agg(F.count("*").alias("n_hit"))
    listed = hits.groupBy("text_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    # stored, so that a join with it has two fresh exchanges and a text with many copies can be split
    found, _ = stored(n_hit.join(listed, "text_key").withColumnRenamed("text_key", "found_key"), "found")
    for path in (stretches_at, marks_at, met_at, close_at, hits_at):
        discard(spark, path)
    return index.select("doc_id", "text_key", "n_words"), found, index_at


def _inputs(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_id_col: str, item_text_col: str):
    return (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
        benchmark.select(F.col(item_id_col).cast("string").alias("item"), F.col(item_text_col).alias("text")),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    k: int = 5,
) -> DataFrame:
    """``doc_id, text_key, n_words, n_hit, items, contaminated`` of every row of ``docs``.

    A stretch is ``window`` consecutive words of an item; an item of fewer words
    is one stretch, one without words none. A document's word inside any
    occurrence of a stretch is hit; ``items`` holds the ids of the items with
    occurring stretches as text, sorted. Null and empty texts have no words.
    Items without id hit but are not listed; an id that repeats counts once. The
    result depends on the text alone, so repeated rows and ids are harmless; an
    empty benchmark hits nothing. Other columns are ignored.

    Documents that share no fingerprint with the benchmark leave after one pass;
    positions are worked out only for the rest, and no other text is shuffled.
    """
    index, found, _ = _found(*_inputs(docs, benchmark, id_col, text_col, item_id_col, item_text_col), window, k)
    # rows that cannot be found stay where they are
    may = key_filter(found, ["found_key"]).may_hold(F.col("text_key"))
    clean = index.where(~F.coalesce(may, F.lit(False))).select("*", *[F.lit(None).cast(t).alias(c) for c, t in found.dtypes])
    rest = index.where(may).join(found, F.col("text_key") == F.col("found_key"), "left")
    return clean.union(rest).select(
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 10, k: int = 5
) -> DataFrame:
    """The rows of ``docs`` that :func:`decontaminate` does not call contaminated, whole, in their columns.

    Texts of other rows than those in question are not shuffled.
    """
    _, found, index_at = _found(*_inputs(docs, benchmark, id_col, text_col, "item_id", "text"), window, k)
    discard(docs.sparkSession, index_at)
    return rows_without_keys(docs, [_text_key(F.col(text_col))], found.select("found_key"))
