"""The corpus pipeline: quality filter, near-duplicates, secrets, mixing, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), where docs is what the
stage before it kept, and returns a DataFrame. Between stages ``run`` writes Parquet to the
checkpoint folder and reads it again, so a lost executor costs one stage's tasks at most. All
but the last stage return the columns of ``documents``.

``ORACLE_SQL`` is None: a fitted classifier, XXH64 and the tokenizer can't be said in SQL. The stages
are tested against brute-force versions in tests/llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import bpe, mixing, quality_classifier, secrets, simhash
from affinity.llm.common import materialize, one_label, table

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, learnt from the labels of ``sf_dir``."""
    labels = one_label(table(spark, sf_dir, "labels"), "quality")
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest id."""
    return simhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets masked."""
    findings, _ = secrets.scan(docs)
    return secrets.redact(docs, findings)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to equal source weights, in shuffled order."""
    return mixing.mix(docs).drop("copy", "shuffle_key")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the token ids of the text and their number. Every text is decoded from its ids in the same
    call; one that doesn't come back fails the stage."""
    ids = bpe.encode(docs.select("doc_id", "source", "text"), bpe.public_encoder(TOKENIZER), checked=True)
    return ids.select("doc_id", "source", "ids", F.size("ids").alias("n_tokens"))


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mixing", mix),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
