import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tableferry.llm import simhash


def plain_fingerprint(text, size=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(values, distance):
    """Smallest value reachable over links of at most the distance, by trying all pairs."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def test_fingerprints_match_the_definition(docs_of, prose):
    texts = [None, "", " \t\n", "One", "One two THREE", "a b c d", "É é\xa0x y z ẞ", prose(1, 500), "x " * 40_000, "a" * 300_000]
    rows = simhash.fingerprints(docs_of(list(enumerate(texts))), "doc_id", "text").collect()
    assert {r["doc_id"]: r["fp"] & (2**64 - 1) for r in rows} == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_links_match_all_pairs(spark, limit):
    """Also when every bucket with more than one fingerprint counts as crowded."""
    rng = random.Random(7)
    values = {rng.getrandbits(64) - 2**63 for _ in range(60)}
    for base in list(values)[:12]:
        for _ in range(8):
            value = base & (2**64 - 1)
            for _ in range(rng.randrange(1, 7)):
                value ^= 1 << rng.randrange(64)
            values.add(value - 2**64 if value >= 2**63 else value)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    pairs, crowded = simhash.near_pairs(fps, 4, limit)
    links = pairs.union(simhash.ball_links(crowded, 4))
    found = {r["node"]: r["component"] for r in simhash.connected_components(links, "a", "b").collect()}
    assert {v: found.get(v, v) for v in values} == plain_components(values, 4)
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 4 for a, b in links.collect())
    if limit == 1:
        assert crowded.count() > 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    found = simhash.connected_components(links, "a", "b").collect()
    assert {r["component"] for r in found} == {0} and len(found) == 201


def test_documents_of_every_kind(docs_of, prose):
    text = prose(3, 300)
    rows = [(5, text), (2, text), (2, text), (None, text), (9, None), (8, ""), (7, "  "), (6, prose(4, 300)), (None, "alone here")]
    found = simhash.near_duplicates(docs_of(rows, clash=True)).select("doc_id", "component_id").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or 0)
    expected = [(2, 2), (2, 2), (5, 2), (6, 6), (7, 7), (8, 7), (9, 7), (None, 2), (None, None)]
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def test_first_of_each(docs_of, prose):
    text = prose(3, 300)
    rows = [(5, text), (2, text), (2, text), (None, text), (9, None), (8, ""), (6, prose(4, 300)), (None, "alone here")]
    docs = docs_of(rows, clash=True)
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 2, 6, 8]


def test_empty_and_odd_distance(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.first_of_each(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        simhash.near_duplicates(docs_of([]), max_distance=3)


def test_large_group_of_near_copies_makes_few_pairs(spark):
    """A third of all rows within two bits of one value: pairs stay bounded, the component is whole."""
    flips = [(1 << i) ^ (1 << j) for i in range(0, 60) for j in range(i)][:1500]
    near = [(0x0F0F0F0F0F0F0F0F ^ f,) for f in flips]
    fps = spark.createDataFrame(near, "fp long").distinct()
    pairs, crowded = simhash.near_pairs(fps, 4)
    assert pairs.count() < 70 * simhash.BUCKET_LIMIT * len(near)
    links = pairs.union(simhash.ball_links(crowded, 4))
    found = simhash.connected_components(links, "a", "b")
    assert found.agg(F.countDistinct("component")).first()[0] == 1 and found.count() == len(near)
