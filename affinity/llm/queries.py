"""The registered queries of the operators, over the driver's tables.

Each applies its operator with production parameters to the whole table and derives the digest
columns of its contract. ``ORACLES`` (from ``sql``) has the DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

import uuid
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import (
    bpe, embeddings, mixing, pieces, quality_classifier, quality_rules, secrets, sharding, simhash, toxicity, trie, url_filter,
    whitening,
)
from affinity.llm.common import fold, one_label, table
from affinity.llm.sql import ORACLES
from affinity.session import scratch_path

#: The files of the tokenizers, by their public names.
TOKENIZER = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
#: Texts whose ids a worker holds at a time.
CODEC_TEXTS = 256

QUERIES: dict = {}
__all__ = ["ORACLES", "QUERIES"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-negative positive-unlabelled toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = one_label(table(spark, sf_dir, "labels"), "toxic")
    model = toxicity.fit(
        docs,
        labels.where(fold(F.col("doc_id"), 3) != 1),
        docs.select("doc_id").where(fold(F.col("doc_id"), 3) != 1),
    )
    return toxicity.score(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the bytes they decode to, as digests.

    Encodes, decodes and digests a text at a time, so that no column of ids leaves the worker.
    """
    encoder = bpe.public_encoder(TOKENIZER)

    @F.pandas_udf("n_tokens long, ids_sha256 binary, decoded_sha256 binary")
    def codec(texts: pd.Series) -> pd.DataFrame:
        counts, digests, decoded = [], [], []
        for text in texts:
            ids = encoder.encode(text).tolist()
            counts.append(len(ids))
            digests.append(sha256(",".join(map(str, ids)).encode()).digest())
            decoded.append(sha256(encoder.decode(ids)).digest())
        return pd.DataFrame({
            "n_tokens": np.array(counts, dtype=np.int64),
            "ids_sha256": pd.Series(digests, dtype=object),
            "decoded_sha256": pd.Series(decoded, dtype=object),
        })

    coded = table(spark, sf_dir, "documents").select("doc_id", codec("text").alias("c"))
    return coded.select("doc_id", "c.n_tokens", *[F.lower(F.hex(f"c.{d}")).alias(d) for d in ("ids_sha256", "decoded_sha256")])


@query
def op3_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards whose counts are at most one apart."""
    return sharding.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of the fixed rules on every page's url."""
    rules = sharding.literal_table(
        spark, [dict(zip(("action", "host", "path"), r)) for r in url_filter.RULES], "action:string,host:string,path:string"
    )
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return url_filter.judge(table(spark, sf_dir, "pages"), rules, 4 * buckets)


@query
def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and near-duplicate components of all documents."""
    docs = table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics, the base rule and the verdict of the fitted cutoffs for every document."""
    good = one_label(table(spark, sf_dir, "labels"), "quality").where("label = 1").select("doc_id")
    return quality_rules.judge(table(spark, sf_dir, "documents"), good)


@query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all embeddings within their labels."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op8_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes support vector quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = one_label(table(spark, sf_dir, "labels"), "quality")
    model = quality_classifier.fit(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return quality_classifier.score(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, scanned once per distinct text, against a ledger stored in the checkpoint folder."""
    ledger = scratch_path(spark, f"secret-ledger-{uuid.uuid4().hex}")
    findings = secrets.scan_stored(table(spark, sf_dir, "documents").select("doc_id", "text"), ledger)
    text = secrets.span_text(F.col("spans"))
    counts = [secrets.span_count(F.col("spans"), k).alias(f"n_{r.kind}") for k, r in enumerate(secrets.BASE_RULES)]
    return findings.select("doc_id", *counts, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


@query
def op10_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents replicated to equal weights of their sources, in shuffled order."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return trie.trie(trie.grafted(trie.sequences(table(spark, sf_dir, "conversations"))))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the text they decode to, as digests of what each worker encodes."""
    encoder = pieces.public_encoder(PIECES)

    @F.pandas_udf("n_tokens long, ids_sha256 binary, decoded_sha256 binary")
    def codec(texts: pd.Series) -> pd.DataFrame:
        counts, digests, decoded = [], [], []
        for lo in range(0, len(texts), CODEC_TEXTS):
            for ids in encoder.encode(texts.iloc[lo:lo + CODEC_TEXTS]):
                counts.append(len(ids))
                digests.append(sha256(" ".join(map(str, ids.tolist())).encode()).digest())
                decoded.append(sha256(encoder.decode(ids).encode()).digest())
        return pd.DataFrame({
            "n_tokens": np.array(counts, dtype=np.int64),
            "ids_sha256": pd.Series(digests, dtype=object),
            "decoded_sha256": pd.Series(decoded, dtype=object),
        })

    coded = table(spark, sf_dir, "documents").select("doc_id", codec("text").alias("c"))
    return coded.select("doc_id", "c.n_tokens", *[F.lower(F.hex(f"c.{d}")).alias(d) for d in ("ids_sha256", "decoded_sha256")])
