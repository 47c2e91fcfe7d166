import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableferry.llm import divergence


def plain(rows, top=200):
    """Shares of every kept term in every group, one by one."""
    counts, lang_docs, lang_n = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered))
        counts[lang, source].update(found)
        lang_docs[lang].update(list(found))
        lang_n[lang].update(found)
    out = set()
    for lang, source in counts:
        kept = [t for t, n in lang_docs[lang].items() if n >= 3]

        def shares(of):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 1) // (total + len(kept)) for t in kept}

        p, whole = shares(counts[lang, source]), shares(lang_n[lang])
        pairs = []
        for other_lang, other in counts:
            if other_lang == lang and other != source:
                q = shares(counts[lang, other])
                pairs.append((sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other))
        terms = [((p[t] - whole[t]) ** 2 // whole[t], t) for t in kept if counts[lang, source][t] and p[t] > whole[t]]
        for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
            out |= {(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)}
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


def prose_rows(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abéß", k=rng.randrange(1, 4))) for _ in range(40)]
    rows = []
    for _ in range(n):
        # a third in one source; some texts repeat
        source = rng.choice(["hot", "hot", "s1", "s2", "s3"])
        text = " ".join(rng.choices(words, range(1, 41), k=rng.randrange(0, 60)))
        rows.append((rng.choice([str.upper, str.lower])(text), rng.choice(["en", "de"]), source))
    return rows + rows[:5]


ODD = [(None, "en", "s1"), ("", None, None), ("Solo 12", "fr", None), ("!!! 123", "es", "s9"), ("a A b", "en", ""),
       ("x y z", "it", "s1"), ("x y z", "it", "s1"), ("x y Z", "it", "s2"), ("q", "it", "s3")]


@pytest.mark.parametrize("bits", [64, 3])
def test_against_plain_sums(spark, bits):
    """With three bits nearly every digest is shared by several terms."""
    for rows in (prose_rows(1), [*prose_rows(2), *ODD]):
        found = divergence.source_divergence(table(spark, rows), bits=bits)
        assert {tuple(r) for r in found.collect()} == plain(rows)


def test_few_places_and_ties(spark):
    rows = [("a b c d e f g", "en", s) for s in ("s1", "s1", "s1", "s2")] + [("z", "en", "s2")] * 3
    found = divergence.source_divergence(table(spark, rows), top=3)
    assert {tuple(r) for r in found.collect()} == plain(rows, top=3)
    items = found.where((F.col("source") == "s1") & (F.col("part") == "term")).orderBy("rank").collect()
    assert [r["item"] for r in items] == ["a", "b", "c"]


def test_no_rows_clashing_names_and_a_long_text(spark):
    assert divergence.source_divergence(table(spark, [])).count() == 0
    rows = [("aa bb cc " * 200_000, "en", "s1"), ("aa bb", "en", "s1"), ("aa cc", "en", "s2"), ("aa bb cc", "en", "s2")]
    df = table(spark, rows)
    for name in ("digest", "split", "n", "docs", "p", "q", "p0", "v", "total", "term", "item", "value", "rank", "part"):
        df = df.withColumn(name, F.lit("clash"))
    assert {tuple(r) for r in divergence.source_divergence(df).collect()} == plain(rows)


def test_only_digests_are_shuffled_for_counts(spark, first_plan):
    rows = divergence.term_counts(table(spark, prose_rows(3)), "lang", "source", "text")
    keyed, _ = divergence.with_keys(rows, 64)
    plan = first_plan(keyed.groupBy(*divergence.KEY, *divergence.GROUP).agg(F.sum("n")))
    assert "term" not in re.search(r"Exchange hashpartitioning\(([^)]*)\)", plan)[1]


def test_large_counts_stay_exact(spark):
    big = 10**12
    df = spark.range(1).select(F.lit(big).alias("n"), F.lit(3 * big).alias("total"))
    assert df.select(divergence._share("n", "total")).first()[0] == 1 + 10**9 * (big + 1) // (3 * big)


def test_terms_are_counted_across_batches(spark, conf):
    conf({"spark.sql.execution.arrow.maxRecordsPerBatch": 10})
    rows = [("en", "ab"[i % 2], f"the house the sea {'x' * (i % 7)}") for i in range(500)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    want = Counter((lang, source, t) for lang, source, text in rows for t in text.split())
    got = divergence.term_counts(docs, "lang", "source", "text").collect()
    assert len(got) == len(want) and {(r["lang"], r["source"], r["term"]): r["n"] for r in got} == want
    # a limit that cuts gives more rows and the same sums
    pieces = list(divergence._gathered([pa.record_batch({"t": ["abc", None, "d" * 50, ""]})] * 3, 0, 60))
    assert [len(p) for p in pieces] == [4, 4, 4] and sum(len(p) for p in pieces) == 12
    assert len(list(divergence._gathered([pa.record_batch({"t": ["abc"]})] * 40, 0, 60))) == 2
    assert list(divergence._gathered([], 0, 60)) == []
