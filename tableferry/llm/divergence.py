"""How the sources of a language differ in their use of terms, with the terms' text joined back last.

Terms are counted under fixed-width digests. The smallest and the largest text
of each digest tell whether several terms share it; those are split, so every
count is exact. The shuffles of counts carry digests, and text is looked up
again only for the terms that are reported.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableferry.llm.slices import text_slices
from tableferry.sources.scratch import discard, stored

# everything below U+0080 but letters
NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
# text bytes counted together, from as many batches as hold them
SLICE = 16 << 20
GROUP = ["lang", "source"]
# a term is known by its digest and, among terms that share one, by a number
KEY = ["digest", "split"]
SCALE = 1_000_000_000


def _gathered(batches: Iterable[pa.RecordBatch], text_at: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows in order, cut and joined to about ``limit`` text bytes at a time and one row at least."""
    held, size = [], 0
    for part in text_slices(batches, text_at, limit):
        more = pc.sum(pc.binary_length(part.column(text_at))).as_py() or 0
        if held and size + more > limit:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(part)
        size += more
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents, summed over slices of the rows only."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, 2, SLICE):
            numbers: dict[tuple[str, str], int] = {}
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            group_of = pa.array([numbers.setdefault(pair, len(numbers)) for pair in pairs], pa.int32())
            # ascii_lower() lowers A-Z and nothing else
            parts = pc.split_pattern_regex(pc.ascii_lower(batch.column(2)), NO_TERM)
            terms = parts.flatten().dictionary_encode()
            found = pa.table({"row": pc.list_parent_indices(parts), "term": terms.indices})
            # only the ends of a text can be empty
            found = found.filter(pc.not_equal(terms.dictionary, "").take(terms.indices))
            found = found.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
            found = pa.table({"g": group_of.take(found["row"]), "term": found["term"], "n": found["count_all"]})
            summed = found.group_by(["g", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
            for part in summed.combine_chunks().to_batches():
                at = part.column("g")
                lang, source = (pa.array([pair[i] for pair in numbers], pa.string()).take(at) for i in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [lang, source, terms.dictionary.take(part.column("term")), part.column("n_sum"), part.column("n_count")],
                    ["lang", "source", "term", "n", "docs"],
                )

    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def with_keys(rows: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the key columns in place of ``term``, and the text of each key.

    Where the smallest and the largest text of a digest differ, its terms are
    numbered in order and told apart by ``split``; it is 0 for all others.
    """
    digest = F.xxhash64("term")
    rows = rows.withColumn("digest", digest if bits == 64 else F.pmod(digest, F.lit(1 << bits)))
    seen, _ = stored(rows.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "terms")
    alone = seen.where(F.col("low") == F.col("high")).select("digest", F.lit(0).alias("split"), F.col("low").alias("term"))
    shared = seen.where(F.col("low") != F.col("high")).select(F.col("digest").alias("of"))
    if shared.isEmpty():
        return rows.withColumn("split", F.lit(0)).drop("term"), alone
    number = F.row_number().over(Window.partitionBy("digest").orderBy("term")) - 1
    several = rows.join(shared, F.col("digest") == F.col("of"), "left_semi").select("digest", "term").distinct()
    several, _ = stored(several.select("digest", number.alias("split"), "term"), "terms-split")
    to = several.select(F.col("digest").alias("to_digest"), F.col("term").alias("to_term"), "split")
    same = (F.col("digest") == F.col("to_digest")) & (F.col("term") == F.col("to_term"))
    keyed = rows.join(to, same, "left").withColumn("split", F.coalesce("split", F.lit(0)))
    return keyed.drop("to_digest", "to_term", "term"), alone.union(several)


def _share(n: str, total: str) -> Column:
    """``1 + floor(SCALE * (n + 1) / total)``, exact at any count."""
    return F.expr(f"1 + (CAST({n} + 1 AS DECIMAL(20, 0)) * {SCALE}BD) div CAST({total} AS DECIMAL(20, 0))")


def _excess(p: str, q: str) -> str:
    """``floor((p - q)^2 / q)``; shares are at most SCALE + 1, so it fits a long."""
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def _all_groups(docs: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Every (lang, source) of the table, also one without terms."""
    cols = {"lang": lang_col, "source": source_col}
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for a, c in cols.items()]).distinct()


def _pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the excess over another source of the language, summed over all its kept terms.

    Terms that neither source has count through their number alone, those of one
    source through how many have which count, and only terms of both meet in a
    join: a term makes a row for each pair of its sources, so never more than
    the result has for the language.
    """
    a = groups.select("lang", "source", F.col("p0").alias("pa"), "v")
    b = groups.select(F.col("lang").alias("b_lang"), F.col("source").alias("item"), F.col("p0").alias("pb"))
    pairs = a.join(b, (F.col("lang") == F.col("b_lang")) & (F.col("source") != F.col("item"))).drop("b_lang")
    none = F.expr(f"CASE WHEN v = 0 THEN 0 ELSE v * ({_excess('pa', 'pb')}) END")
    base = pairs.select(*GROUP, "item", none.alias("value"))

    counted, _ = stored(kept.groupBy(*GROUP, "p").agg(F.count("*").alias("m")), "divergence-counts")
    mine = counted.select(F.col("lang").alias("c_lang"), F.col("source").alias("c_source"), "p", "m")
    is_lang = F.col("lang") == F.col("c_lang")
    first = pairs.join(mine, is_lang & (F.col("source") == F.col("c_source"))).select(
        *GROUP, "item", F.expr(f"m * (({_excess('p', 'pb')}) - ({_excess('pa', 'pb')}))").alias("value")
    )
    second = pairs.join(mine, is_lang & (F.col("item") == F.col("c_source"))).select(
        *GROUP, "item", F.expr(f"m * (({_excess('pa', 'p')}) - ({_excess('pa', 'pb')}))").alias("value")
    )

    # each pair of sources meets once per term, and both directions are summed
    left = kept.select("lang", *KEY, F.col("source").alias("s"), F.col("p").alias("ps"), F.col("p0").alias("s0"))
    right = kept.select("lang", *KEY, F.col("source").alias("t"), F.col("p").alias("pt"), F.col("p0").alias("t0"))
    met = left.join(right, ["lang", *KEY]).where(F.col("s") < F.col("t"))

    def both(p: str, q: str, p0: str, q0: str) -> Column:
        return F.sum(F.expr(f"({_excess(p, q)}) - ({_excess(p, q0)}) - ({_excess(p0, q)}) + ({_excess(p0, q0)})"))

    met = met.groupBy("lang", "s", "t").agg(both("ps", "pt", "s0", "t0").alias("st"), both("pt", "ps", "t0", "s0").alias("ts"))
    met, _ = stored(met, "divergence-met")
    there = met.select("lang", F.col("s").alias("source"), F.col("t").alias("item"), F.col("st").alias("value"))
    back = met.select("lang", F.col("t").alias("source"), F.col("s").alias("item"), F.col("ts").alias("value"))
    parts = base.union(first).union(second).union(there).union(back)
    return parts.groupBy(*GROUP, "item").agg(F.sum("value").alias("value"))


def _top_terms(kept: DataFrame, spelled: DataFrame, top: int) -> DataFrame:
    """``lang, source, item, value, rank``: the terms a group has more often than its language, by excess.

    The value of the last place is found from how many terms have which value, so
    text is joined to the terms at or above it only. Ties there are settled by
    the text, after every task has cut its rows to ``top`` a group.
    """
    rows = kept.where(F.col("p") > F.col("q")).select(*GROUP, *KEY, F.expr(_excess("p", "q")).alias("value"))
    rows, _ = stored(rows, "divergence-terms")
    by_value = Window.partitionBy(*GROUP).orderBy(F.desc("value"))
    # that many values have that many terms at least
    values = rows.groupBy(*GROUP, "value").agg(F.count("*").alias("m"))
    values = values.withColumn("place", F.row_number().over(by_value)).where(F.col("place") <= top)
    above = F.sum("m").over(by_value.rowsBetween(Window.unboundedPreceding, -1))
    values = values.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < top)
    cuts = values.groupBy(*GROUP).agg(F.min("value").alias("cut"))
    cuts, _ = stored(cuts.select(F.col("lang").alias("cut_lang"), F.col("source").alias("cut_source"), "cut"), "divergence-cuts")
    mine = (F.col("lang") == F.col("cut_lang")) & (F.col("source") == F.col("cut_source"))
    rows = rows.join(cuts, mine).where(F.col("value") >= F.col("cut")).select(*GROUP, *KEY, "value")
    text = spelled.select(*KEY, F.col("term").alias("item"))
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    named = rows.join(text, KEY).select(*GROUP, "item", "value", F.row_number().over(order).alias("rank"))
    return named.where(F.col("rank") <= top)


def source_divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = 3,
    top: int = 200,
    bits: int = 64,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) of the table.

    A language keeps the V terms found in ``min_docs`` of its documents. With n
    occurrences of a kept term in a group and N of all kept terms,
    ``p = 1 + floor(1e9 * (n + 1) / (N + V))``, and the excess of p over q is
    ``floor((p - q)^2 / q)``. Part ``pair`` sums a source's excess over each
    other source of its language over all kept terms (0 if there is none). Part
    ``term`` lists the ``top`` terms that occur in the group with p above the
    language's, by excess over it. Ranks go by value, largest first, then item.

    Null lang, source and text read as empty; rows count as documents, so
    repeated rows count again; an empty table gives no rows; other columns are
    ignored. Digests have ``bits`` bits: fewer only make more terms share one.
    """
    groups = _all_groups(docs, lang_col, source_col)
    rows, rows_at = stored(term_counts(docs, lang_col, source_col, text_col), "divergence-rows")
    rows, spelled = with_keys(rows, bits)
    counts = rows.groupBy(*KEY, *GROUP).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts, counts_at = stored(counts, "divergence-groups")
    discard(docs.sparkSession, rows_at)
    known = counts.groupBy(*KEY, "lang").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    known, _ = stored(known.where(F.col("docs") >= min_docs).select(*KEY, "lang", "lang_n"), "divergence-known")
    kept, kept_at = stored(counts.drop("docs").join(known, [*KEY, "lang"]), "divergence-kept")
    discard(docs.sparkSession, counts_at)

    langs = known.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    langs = langs.select(F.col("lang").alias("of_lang"), "v", "lang_total")
    totals = kept.groupBy(*GROUP).agg(F.sum("n").alias("total")).toDF("t_lang", "t_source", "total")
    groups = groups.join(totals, (F.col("lang") == F.col("t_lang")) & (F.col("source") == F.col("t_source")), "left")
    groups = groups.join(langs, F.col("lang") == F.col("of_lang"), "left").select(
        *GROUP,
        F.coalesce("v", F.lit(0)).alias("v"),
        F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
        F.coalesce("total", F.lit(0)).alias("total"),
    )
    # without a kept term there is no share
    groups = groups.withColumn("p0", F.when(F.col("v") > 0, _share("0L", "(total + v)")))
    # stored, so that the join below has two fresh exchanges and the rows of one group can be split
    groups, _ = stored(groups, "divergence-sizes")
    sizes = groups.toDF("g_lang", "g_source", *groups.columns[2:])
    kept = kept.join(sizes, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source")))
    kept, shares_at = stored(
        kept.select(
            *GROUP, *KEY, _share("n", "(total + v)").alias("p"), _share("lang_n", "(lang_total + v)").alias("q"), "p0"
        ),
        "divergence-shares",
    )
    discard(docs.sparkSession, kept_at)
    by_value = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    pairs = _pair_sums(kept, groups).select(*GROUP, "item", "value", F.row_number().over(by_value).alias("rank"))
    terms = _top_terms(kept, spelled, top)
    found, _ = stored(
        pairs.withColumn("part", F.lit("pair"))
        .unionByName(terms.withColumn("part", F.lit("term")))
        .select(*GROUP, "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")),
        "divergence",
    )
    discard(docs.sparkSession, shares_at)
    return found
