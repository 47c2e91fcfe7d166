import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text) or (id, text, lang); further columns clash with names the operators use inside."""

    def make(rows, clash=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOC)
        if clash:
            from pyspark.sql import functions as F

            for name in ("fp", "text_key", "words", "hashes", "mins", "shard", "label", "hub", "ids", "spans", "score",
                         "n_tokens", "lang_pred", "n", "a", "b", "key", "token", "item", "count"):
                df = df.withColumn(name, F.lit("clash"))
        return df

    return make


WORDS = "the of and to in is was for on that with as it at by from or an be this".split()


@pytest.fixture
def prose():
    import random

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + rng.choice(["", "er", "ing", "ly", "s"]) for _ in range(n))

    return make


@pytest.fixture
def small_skew(conf):
    """Joins are sorted, and small ones with a hot key count as skewed."""
    conf({
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    })
