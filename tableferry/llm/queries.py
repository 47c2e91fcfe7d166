"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import (
    bpe,
    decontaminate,
    divergence,
    hash_index,
    langid,
    pii,
    sharding,
    simhash,
    spelling,
    token_count,
    toxicity,
    url_rules,
    warc_zip,
)
from tableferry.llm.slices import short_batches

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4096
URL_RULES = [
    url_rules.Rule("org", "/", "allow"),
    url_rules.Rule("example.org", "/es/", "block"),
    url_rules.Rule("example.org", "/en/1", "block"),
    url_rules.Rule("com", "/fr/", "allow"),
    url_rules.Rule("com", "/de/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4, max_distance=4)
    return found.select("doc_id", "fingerprint", "component_id")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.with_ids(docs, "text", "ids", VOCABULARY, public_tokenizers.PATTERN, bytes_col="bytes")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.with_token_count(docs, "text", "n_tokens", PIECES)
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.predict_languages(docs).select("doc_id", "held_out", "lang_pred", "score")


def op6_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder = warc_zip.new_folder(pages)
    records = warc_zip.read_packages(warc_zip.write_packages(pages, folder), folder)
    return records.select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_personal_data(docs)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *map(count, pii.BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_index.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    short_batches(spark)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = toxicity.predict_toxicity(docs, _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_byte_bpe, op3_token_counts, op4_url_rules, op5_language,
        op6_warc_zip, op7_personal_data, op8_decontaminate, op9_shards, op10_neighbours,
        op11_spelling, op12_divergence, op13_toxicity,
    )
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES: dict[str, str] = {
    "op4_url_rules": f"""
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(r_host, r_path, r_verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), judged AS (
  SELECT page_id, host, path,
         (SELECT max(printf('%04d', length(r_host || r_path)) || r_verdict || r_host || r_path) FROM rules
          WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS best
  FROM parts
)
SELECT page_id, host, path, substr(best, 10) AS rule, coalesce(substr(best, 5, 5), 'allow') AS verdict FROM judged
""",
    "op6_warc_zip": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM m
""",
    "op8_decontaminate": rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iwin AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM iw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM iwin),
dwin AS (
  SELECT doc_id, size, s, array_to_string(w[s : s + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM dw, sizes WHERE len(w) >= size)
), hits AS (SELECT doc_id, s, d.size, item FROM dwin d JOIN iwin i ON d.words = i.words AND d.size = i.size),
places AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(places.n, 0) AS n_hit, coalesce(listed.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(places.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN places USING (doc_id) LEFT JOIN listed USING (doc_id)
""",
    "op12_divergence": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, {_AZ}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), known AS (
  SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM known GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM d
), counts AS (
  SELECT t.lang, source, term, count(*) AS n FROM t JOIN known USING (lang, term) GROUP BY ALL
), totals AS (
  SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         (1 + (1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT) // (coalesce(total, 0) + v))::HUGEINT AS p,
         (1 + (1000000000 * (lang_n + 1)::HUGEINT) // (lang_total + v))::HUGEINT AS q
  FROM groups g JOIN known k USING (lang) JOIN langs USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN totals s ON s.lang = g.lang AND s.source = g.source
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
""",
}
