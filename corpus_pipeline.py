"""From raw documents to token ids: five stages, each written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import bpe, langid, pii, simhash
from tableferry.llm.decontaminate import without_contaminated
from tableferry.llm.queries import VOCABULARY
from tableferry.sources.scratch import stored

# Rows that go to a Python worker at a time: whole texts, held by it and by Spark.
BATCH_ROWS = 1000


def _short_batches(spark: SparkSession) -> None:
    """Bound what a batch of texts takes, unless the launcher has."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(BATCH_ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is recognised.

    Texts that are null or have no letter go, and those that share no n-gram with
    any language learned (score 0); how high other scores are depends on the
    alphabet and the length, so they reject nothing. Where no language could be
    learned, nothing is rejected.
    """
    _short_batches(spark)
    profiles = langid.learn_unheld(docs)
    if not profiles.names:
        return docs
    found = langid.with_language(docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns}), "in_text", profiles)
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") > 0))
    return kept.select(*[F.col(f"in_{c}").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the one with the smallest id (4-word shingles, 4 bits)."""
    _short_batches(spark)
    return simhash.first_of_each(docs, shingle_words=4, max_distance=4)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold ten consecutive words of a benchmark item, or a whole shorter one."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without_contaminated(docs, items, window=10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind in place of each span of personal data; ``n_chars`` follows the text."""
    _short_batches(spark)
    clean = pii.with_personal_data(docs, "text", "__spans", "text").drop("__spans")
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return clean.withColumn("n_chars", n_chars).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the token ids, checked by decoding; only documents that come back as they were go out."""
    _short_batches(spark)
    checked = bpe.with_ids(docs, "text", "token_ids", VOCABULARY, public_tokenizers.PATTERN, bytes_col="__bytes")
    same = F.col("__bytes") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return checked.where(same).withColumn("n_tokens", F.size("token_ids").cast("long")).drop("__bytes")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

#: No stage but the benchmark's can be written in SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
