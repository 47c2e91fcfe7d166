import hashlib
from pathlib import Path

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tableferry.llm import bpe, pii, simhash
from tableferry.llm.queries import ORACLES, QUERIES, VOCABULARY
from verification.check import oracle_connection

SF_DIR = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables not present")


@given
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    answer = oracle_connection(SF_DIR).execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, answer.fetchall()))


@given
@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op10_neighbours", "op6_warc_zip", "op4_url_rules", "op11_spelling", "op12_divergence"}))
def test_a_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(r[0] for r in found.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


@given
def test_pipeline_against_a_plain_version(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    texts = {i: r["text"] for i, r in docs.items()}
    # every given document is in a language learned, so the first stage keeps all
    prints = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id", "text").collect()}
    first = {}
    groups = {}
    for i in sorted(prints):
        near = [g for g, members in groups.items() if any(bin((prints[i] ^ prints[m]) & (2**64 - 1)).count("1") <= 4 for m in members)]
        into = min(near, default=i)
        groups.setdefault(into, []).append(i)
        for g in near:
            if g != into:
                groups[into] += groups.pop(g)
        first[i] = into
    kept = set(groups)
    hit = {r["doc_id"] for r in QUERIES["op8_decontaminate"](spark, SF_DIR).where("contaminated").collect()}
    kept -= hit
    with open(VOCABULARY, "rb") as lines:
        import public_tokenizers as P

        library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(lines), special_tokens={})
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"] for r in rows} == kept
    for r in rows:
        clean = pii.redact(texts[r["doc_id"]], pii.find(texts[r["doc_id"]]))
        assert (r["text"], r["n_chars"], r["token_ids"]) == (clean, len(clean), library.encode_ordinary(clean))


def test_stages_keep_columns_and_survive_odd_rows(spark, docs_of, prose, tmp_path):
    spark.createDataFrame([(1, prose(9, 12))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, prose(1, 200)), (2, None), (3, ""), (None, prose(2, 200)), (1, prose(1, 200)), (4, "x " * 50_000), (5, prose(9, 12)), (6, "a.b@c.de writes to the house")]
    for docs in (docs_of(rows), docs_of(rows, clash=True), docs_of([])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "token_ids":
                assert out.columns == docs.columns, name
            assert out.count() <= docs.count()


def test_language_stage_keeps_all_where_nothing_is_labelled(spark, docs_of):
    docs = docs_of([(1, "some text", None), (2, "more", None)]).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.STAGES[0][1](spark, docs, "").count() == 2


def test_language_stage_keeps_all_where_nothing_is_learned(spark, docs_of):
    import zlib

    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    other = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2)
    docs = docs_of([(held, "some text", "en"), (None, "more text", "en"), (other, "and more", None), (other, "123", "en")])
    assert corpus_pipeline.STAGES[0][1](spark, docs, "").count() == 4


def test_language_stage_keeps_short_texts_of_a_large_alphabet(spark, docs_of):
    import random

    rng = random.Random(6)
    alphabet = [chr(0x4E00 + i) for i in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)]
    rows = [(i, "".join(rng.choices(alphabet, weights, k=rng.randrange(20, 60))), "zh") for i in range(300)]
    rows += [(1000, "ξένο κείμενο", None), (1001, "123", None)]
    kept = corpus_pipeline.STAGES[0][1](spark, docs_of(rows), "").collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(300))


def test_digests_follow_the_contract(spark, docs_of, tmp_path):
    docs_of([(1, "Hi"), (2, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    empty = hashlib.sha256(b"").hexdigest()
    rows = {r["doc_id"]: r for r in QUERIES["op2_byte_bpe"](spark, str(tmp_path)).collect()}
    assert rows[2]["ids_sha256"] == rows[2]["decoded_sha256"] == empty and rows[2]["n_tokens"] == 0
    assert rows[1]["decoded_sha256"] == hashlib.sha256(b"Hi").hexdigest()
    rows = {r["doc_id"]: r for r in QUERIES["op7_personal_data"](spark, str(tmp_path)).collect()}
    assert rows[2]["base_sha256"] == empty and rows[2]["spans"] == "" and rows[2]["n_email"] == 0
