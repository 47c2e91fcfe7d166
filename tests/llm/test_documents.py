import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tableferry.llm import decontaminate, langid, pii, sharding

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_hits(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        v = words(body)
        size = min(window, len(v))
        for s in range(len(v) - size + 1) if v else ():
            for i in range(len(w) - size + 1):
                if w[i : i + size] == v[s : s + size]:
                    hit |= set(range(i, i + size))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_decontamination_matches_all_windows(spark, docs_of, prose):
    rng = random.Random(5)
    items = [(i, prose(100 + i, rng.choice([3, 9, 10, 11, 40]))) for i in range(12)]
    items += [(3, "again under one id " * 4), (None, prose(150, 20)), (50, None), (51, "..."), (52, "Éa ÉA x")]
    texts = [None, "", "!!", "x", "éa Éa X y", prose(1, 3000)]
    for i in range(40):
        base = prose(i, 60).split()
        part = words(rng.choice(items)[1])
        if part and i % 2:
            cut = rng.randrange(max(1, len(part) - 5))
            base[rng.randrange(60) : 0] = [x.upper() + rng.choice(["", ",", "."]) for x in part[cut:]]
        texts.append(" ".join(base))
    docs = docs_of([*enumerate(texts), (3, texts[10]), (None, texts[11])], clash=True)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1)).withColumn("words", F.lit("x"))
    rows = decontaminate.decontaminate(docs, bench).collect()
    assert len(rows) == len(texts) + 2
    keyed = {hashlib.sha256(t.encode()).hexdigest() if t is not None else None: t for t in texts}
    for row in rows:
        expected = plain_hits(keyed[row["text_key"]], items)
        assert (row["n_words"], row["n_hit"], row["items"]) == expected
        assert row["contaminated"] == (expected[1] > 0)


def test_decontamination_of_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.decontaminate(docs_of([]), one).count() == 0
    row = decontaminate.decontaminate(docs_of([(1, "a b c")]), none).first()
    assert (row["n_words"], row["n_hit"], row["items"], row["contaminated"]) == (3, 0, [], False)


def test_a_benchmark_text_on_a_third_of_the_documents_is_split(spark, docs_of, prose, tmp_path, small_skew, final_plan, monkeypatch):
    leak = prose(1, 60)
    rows = [(i, leak if i % 3 == 0 else f"own {i}") for i in range(9000)]
    docs_of(rows).repartition(10).write.parquet(str(tmp_path / "docs"))
    plans, kept = {}, decontaminate.stored

    def watched(df, name):
        plans[name] = final_plan(df)
        return kept(df, name)

    monkeypatch.setattr(decontaminate, "stored", watched)
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    found = decontaminate.decontaminate(spark.read.parquet(str(tmp_path / "docs")), bench)
    assert found.where("contaminated").count() == 3000
    assert "SortMergeJoin(skew=true)" in plans["close"]


def test_decontamination_runs_no_python(docs_of, spark, first_plan):
    plan = first_plan(decontaminate.decontaminate(docs_of([(1, "a b c")]), spark.createDataFrame([(1, "b")], "item_id long, text string")))
    assert not re.search("Python|Pandas|Arrow", plan)


SAMPLES = {"en": "the man and the house of the town with a river ", "de": "der mann und das haus der stadt mit einem fluss ",
           "fr": "le monsieur et la maison de la ville avec une rivière "}


def test_language(docs_of):
    rows = [(i, SAMPLES[lang] * (1 + i % 3), lang) for i, lang in enumerate(list(SAMPLES) * 20)]
    rows += [(900, None, "en"), (901, "", "en"), (902, "123 !!", "de"), (903, "der Fluss und die Stadt " * 50_000, None), (None, SAMPLES["de"], "fr"), (1, rows[1][1], "de")]
    found = langid.predict_languages(docs_of(rows, clash=True))
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == len(rows)
    assert all(by_id[i]["lang_pred"] == lang for i, _, lang in rows[:60])
    assert [(by_id[i]["lang_pred"], by_id[i]["score"]) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert by_id[903]["lang_pred"] == "de" and by_id[None]["lang_pred"] == "de" and not by_id[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in by_id.values())


def test_language_ignores_the_label_of_a_held_out_row(docs_of):
    import zlib

    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    rows = [(i, SAMPLES["en"], "en") for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    found = {r["doc_id"]: r for r in langid.predict_languages(docs_of([*rows, (held, SAMPLES["de"], "de")])).collect()}
    assert found[held]["held_out"] and found[held]["lang_pred"] == "en"


def test_language_without_labels_or_rows(docs_of):
    assert langid.predict_languages(docs_of([])).count() == 0
    row = langid.predict_languages(docs_of([(1, "text", None)])).first()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)


@pytest.mark.parametrize("piece", [1, 2, 3, 5, 101])
def test_long_texts_are_counted_whole(monkeypatch, piece):
    for text in ("ab cd abc " * 30, " .. a  b\n\ncd!?e   " * 9, "x", "é", "", " ", "Straße 12 und über"):
        with monkeypatch.context() as patch:
            whole = langid.grams(text)
            patch.setattr(langid, "PIECE", piece)
            cut = langid.grams(text)
        assert [x.tolist() for x in cut] == [x.tolist() for x in whole]


def plain_profile(text, size):
    """N-grams of the words, most frequent first, equal counts in the order of their characters from the last on."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    found = Counter()
    for word in words:
        padded = f" {word} "
        found.update(word)
        found.update(padded[i : i + 3] for i in range(len(padded) - 2))
    # spaces between two words are one and the same
    line = " " + " ".join(words) + " "
    found.update(line[i : i + 2] for i in range(len(line) - 1))

    def key(gram):
        return sum(ord(c) << (21 * i) for i, c in enumerate(gram))

    return [g for g, _ in sorted(found.items(), key=lambda x: (-x[1], key(x[0])))][:size], key


def test_language_against_plain_out_of_place_distances():
    rng = random.Random(8)
    alphabets = {"aa": "abcde", "bb": "cdefg", "cc": "aeéß"}
    texts = {lang: " ".join("".join(rng.choices(letters, k=rng.randrange(1, 6))) for _ in range(300)) for lang, letters in alphabets.items()}
    size = 40
    ranked = {lang: plain_profile(t, size)[0] for lang, t in texts.items()}
    key = plain_profile("x", size)[1]
    profiles = langid.Profiles({lang: [key(g) for g in grams] for lang, grams in ranked.items()}, size)
    for _ in range(60):
        text = " ".join("".join(rng.choices("abcdefgé.1", k=rng.randrange(1, 7))) for _ in range(rng.randrange(1, 30)))
        top, _ = plain_profile(text, size)
        if not top:
            continue
        distance = {
            lang: sum(min(abs(grams.index(g) - i), size) if g in grams else size for i, g in enumerate(top))
            for lang, grams in ranked.items()
        }
        best = min(sorted(distance), key=distance.get)
        want = 1 - distance[best] / (len(top) * size)
        lang, score = profiles.predict(text)
        assert score == pytest.approx(want) and (lang == best or want == 0)


def plain_base(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_match_the_patterns():
    rng = random.Random(11)
    texts = ["".join(rng.choice("a1@.+- ()é23%45\n") for _ in range(rng.randrange(60))) for _ in range(20_000)]
    texts += ["".join(rng.choice("12345. 0+@a") for _ in range(rng.randrange(70))) for _ in range(20_000)]
    texts += ["4111 1111 1111 1111", "a@b.c@d.e", "0000255.1.1.256 1.2.3.4.5.6.7.8", "+1 (456) 555-2186"]
    for text in texts:
        assert [tuple(s[:3]) for s in pii.find(text) if s.kind in pii.BASE] == plain_base(text)


@pytest.mark.parametrize("text", ["a" * 500_000, "1" * 200_000, "1." * 100_000, "+1" + "." * 200_000, "@" * 200_000, "1-" * 100_000])
def test_long_runs_take_linear_time(text):
    pii.find(text)


def test_checksums_and_context():
    kinds = lambda t: [s.kind for s in pii.find(t)]
    assert kinds("DE89 3704 0044 0532 0130 00") == ["iban"] and kinds("DE88 3704 0044 0532 0130 00") == []
    assert kinds("call (555) 123-4567 now") == ["local_phone"] and kinds("order (555) 123-4567") == []
    assert kinds("ssn 123-45-6789") == ["national_id"] and kinds("part 123-45-6789") == []
    near, far = pii.find("credit card 4111111111111111")[0], pii.find("4111111111111111")[0]
    assert near.score > far.score


@pytest.mark.parametrize("code", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82WEST12345698765432", "NO9386011117947"])
@pytest.mark.parametrize("after", ["", " BIC COBADEFF", " 2024-01-02", " A NEW ONE", " 12", " AND GB82 WEST 1234 5698 7654 32", ". A", " Bank"])
@pytest.mark.parametrize("before", ["", "IBAN ", "REF AB12 ", "XY00 1234 "])
def test_account_numbers_among_capitals_and_numbers(code, after, before):
    text = before + code + after
    found = [text[s.start : s.end] for s in pii.find(text) if s.kind == "iban"]
    assert found == [code] + ["GB82 WEST 1234 5698 7654 32"] * ("WEST" in after)
    assert pii.redact(text, pii.find(text)).startswith(f"{before}<IBAN>")


def test_account_numbers_of_other_countries():
    check = next(f"{n:02}" for n in range(2, 99) if pii.mod97(f"ZZ{n:02}ABCD1234567890"))
    text = f"ZZ{check} ABCD 1234 5678 90 THE END"
    assert [text[s.start : s.end] for s in pii.find(text)] == [text[:22]]


def test_redaction_and_columns(docs_of):
    rows = [(1, "é mail a.b@c.de, +1 (456) 555-2186."), (2, None), (3, ""), (4, "clean"), (4, "clean")]
    docs = docs_of(rows, clash=True)
    found = pii.with_personal_data(docs, "text", "spans", "text")
    assert sorted(found.columns) == sorted(docs.columns)
    assert sorted((r["doc_id"], r["text"]) for r in found.collect() if r["text"] is not None) == [
        (1, "é mail <EMAIL>, <PHONE>."), (3, ""), (4, "clean"), (4, "clean")
    ]
    assert pii.with_personal_data(docs_of([])).count() == 0


def check_shards(rows, shards):
    held = [[r for r in rows if r["shard"] == s] for s in range(shards)]
    assert sum(map(len, held)) == len(rows)
    assert max(map(len, held)) - min(map(len, held)) <= 1
    for one in held:
        assert sorted(r["slot"] for r in one) == list(range(len(one)))


def test_shards(docs_of, prose):
    texts = [prose(i, 20) for i in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i % 40]) for i in range(120)]
    rows += [(None, "x"), (7, texts[7]), (7, texts[7]), (2000, None), (2001, None), (2002, ""), (2003, "é")]
    found = sharding.shard_documents(docs_of(rows, clash=True)).collect()
    assert len(found) == len(rows)
    check_shards(found, 8)
    groups = {}
    for r in found:
        if r["group"] is not None:
            groups.setdefault(r["group"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in groups.values())
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["size"] for i in (2000, 2002, 2003)] == [1, 1, 3]
    assert by_id[2000]["text_crc32"] is None and by_id[2002]["text_crc32"] == 0


def test_a_group_larger_than_a_shard_is_split(docs_of):
    rows = [(i, "same") for i in range(400)] + [(1000 + i, f"own {i}") for i in range(200)]
    found = sharding.shard_documents(docs_of(rows)).collect()
    check_shards(found, 8)


@pytest.mark.parametrize("n", [0, 1, 7, 9])
def test_shards_of_few_rows(docs_of, n):
    found = sharding.shard_documents(docs_of([(i, "t") for i in range(n)])).collect()
    assert len(found) == n
    if n:
        check_shards(found, 8)


def split_groups(found):
    """The sizes of the groups that are on several shards."""
    held = {}
    for r in found:
        held.setdefault(r["group"], []).append(r["shard"])
    return [len(s) for s in held.values() if len(set(s)) > 1]


@pytest.mark.parametrize("size", [2, 3, 5])
def test_groups_stay_whole_where_every_row_is_linked(docs_of, size):
    rows = [(i, f"text {i // size}") for i in range(8 * 60 * size)]
    found = sharding.shard_documents(docs_of(rows)).collect()
    check_shards(found, 8)
    assert split_groups(found) == []


def test_groups_stay_whole_beside_a_text_on_a_third_of_the_rows(docs_of):
    rows = [(i, "same") for i in range(800)] + [(1000 + i, f"text {i // 4}") for i in range(1600)]
    found = sharding.shard_documents(docs_of(rows)).collect()
    check_shards(found, 8)
    assert split_groups(found) == [800]


def test_groups_of_many_sizes(docs_of):
    rng = random.Random(4)
    sizes = [rng.choice([2, 3, 4, 7, 20, 55]) for _ in range(300)]
    texts = [f"text {i}" for i, n in enumerate(sizes) for _ in range(n)]
    found = sharding.shard_documents(docs_of([*enumerate(texts)])).collect()
    check_shards(found, 8)
    # only what is left when every shard is all but full
    assert len(split_groups(found)) < 8


def placed_by(spark, held, quota):
    """What the propagation does with hubs given as {hub: labels of its documents}."""
    rows = [(hub, label) for hub, labels in held.items() for label in labels]
    placed, cuts = sharding.propagate(spark.createDataFrame(rows, "hub string, label int"), quota)
    placed = {r["hub"]: ([(t["end"], t["shard"]) for t in r["targets"]], r["level"]) for r in placed.collect()}
    cut = {h: len(labels) - max(labels.count(s) for s in labels) for h, labels in held.items()}
    assert cuts[0] == sum(cut[h] for h, labels in held.items() if len(labels) <= max(quota))
    assert cuts == sorted(cuts, reverse=True)
    return placed, cuts, cut


def test_hubs_go_where_most_of_their_documents_are(spark):
    rng = random.Random(5)
    held = {f"h{i}": [rng.randrange(4) for _ in range(rng.randint(2, 9))] for i in range(200)}
    placed, cuts, _ = placed_by(spark, held, [2000] * 4)
    assert cuts[1:] == [0]
    for hub, labels in held.items():
        ((end, shard),), level = placed[hub]
        most = max(labels.count(s) for s in labels)
        assert (end, level) == (len(labels), sharding.WHOLE) and labels.count(shard) == most


@pytest.mark.parametrize("seed", [1, 2])
def test_propagation_ends_where_nothing_fits(spark, seed):
    rng = random.Random(seed)
    held = {f"h{i}": [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(rng.choice([2, 3, 5, 8, 40]))] for i in range(250)}
    total = sum(map(len, held.values()))
    quota = sharding._quota(total, 4)
    placed, cuts, cut = placed_by(spark, held, quota)
    assert set(placed) == set(held)
    room, left = list(quota), []
    for hub, (targets, level) in placed.items():
        ((end, shard),) = targets
        assert end == len(held[hub])
        if level == sharding.WHOLE:
            room[shard] -= end
        else:
            left.append(hub)
            assert held[hub].count(shard) == end - cut[hub]
    # full, but not beyond; what is left fits nowhere, and so is less than a hub a shard
    assert min(room) >= 0 and len(left) < 4
    assert all(len(held[hub]) > max(room) for hub in left)
    assert cuts[-1] == sum(cut[hub] for hub in left)
    # it took more than one round of requests
    assert len(cuts) > 2


def test_hubs_larger_than_a_shard_take_whole_shards(spark):
    held = {"a": [0] * 260, "b": [1] * 110, **{f"h{i}": [i % 4, i % 3] for i in range(15)}}
    placed, _, _ = placed_by(spark, held, [100] * 4)
    targets, level = placed["a"]
    assert level == sharding.SPLIT and [end for end, _ in targets] == [100, 200, 260]
    assert placed["b"][1] == sharding.SPLIT and placed["b"][0][0][0] == 100
    assert all(placed[f"h{i}"][1] == sharding.WHOLE for i in range(15))
