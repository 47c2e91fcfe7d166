import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tableferry.llm import spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, factor=10):
    """Every pair of words compared."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= factor * n[w]}
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def variants(seed):
    """Words and their near words at very different counts, chains of forms among them."""
    rng = random.Random(seed)
    alphabet = "abcdeéÀÿ"
    rows, doc_id = [], 0
    for _ in range(12):
        word = "".join(rng.choices(alphabet, k=rng.randrange(7, 11)))
        for n in (400, 30, 2):
            for _ in range(n // 10 + 1):
                rows.append((doc_id, " ".join([word if rng.random() < 0.7 else word.upper()] * min(n, 10)) + "!"))
                doc_id += 1
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + "é" + word[at:], word[:at] + "c" + word[at + 1 :]])
    return rows


@pytest.mark.parametrize("groups, tile", [(3, spelling.TILE), (3, 4), (4, 16)])
def test_against_all_pairs(spark, docs_of, groups, tile):
    for seed in (1, 2):
        rows = variants(seed)
        found = spelling.spelling_variants(docs_of(rows, clash=True), groups=groups, tile=tile)
        want = plain(rows)
        assert {tuple(r) for r in found.collect()} == want
        assert any(w[2] not in (w[0], w[1]) for w in want) and found.count() == len(want)


def test_odd_rows(docs_of, spark):
    long = "abcdefg " * 300_000
    rows = [(1, None), (2, ""), (3, "123 ?!"), (None, "Größere größere"), (5, "ABCDEFG"), (5, "ABCDEFG"), (6, long), (7, "×÷×÷×÷× ×÷×÷×÷×")]
    found = {tuple(r) for r in spelling.spelling_variants(docs_of(rows)).collect()}
    assert found == plain(rows)
    assert spelling.spelling_variants(docs_of([])).count() == 0
    assert spelling.spelling_variants(docs_of([])).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_every_block_is_bounded_by_tiles(spark):
    """All words share their letters, so one block holds them all."""
    words = spark.range(0, 4000).select(
        F.concat(F.lit("aaaaaaa"), F.translate(F.lpad(F.col("id").cast("string"), 4, "0"), "0123456789", "bcdefghijk")).alias("word"),
        F.lit(2).cast("long").alias("n"),
    )
    found = spelling.near_words(words, tile=128).collect()
    # each of four places has nine other letters
    assert len(found) == 4000 and all(r["n_near"] >= 9 * 3 for r in found)


@pytest.mark.parametrize("seed", range(3))
def test_edits(seed):
    import numpy as np

    rng = random.Random(seed)
    pairs = []
    for _ in range(3000):
        a = "".join(rng.choices("ab", k=7))
        pairs.append((a, "".join(rng.choices("ab", k=8)), "".join(rng.choices("ab", k=7))))
    codes = [np.array([list(p[i].encode()) for p in pairs], dtype=np.uint8) for i in range(3)]
    assert spelling._one_inserted(codes[0], codes[1]).tolist() == [one_edit(a, b) for a, b, _ in pairs]
    assert spelling._one_replaced(codes[0], codes[2]).tolist() == [one_edit(a, c) for a, _, c in pairs]
