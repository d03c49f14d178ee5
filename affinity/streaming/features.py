"""Fitted click features applied to a file stream (stream-static joins, no state).

Fit on a batch table once (min/max, vocabulary, offsets), then every micro-batch of arriving
click rows is scaled, coded by a left join with the static vocabulary, and written as FM
lines. The vocabulary is a static DataFrame; Spark joins it per micro-batch (broadcast when
small). Nothing is kept in streaming state, so the query restarts from its checkpoint alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from affinity.operators import features
from affinity.sources import writers


@dataclass
class ClickEncoder:
    numeric: list[str]
    category: list[str]
    stats: dict
    vocab: DataFrame
    offsets: dict


def fitted_click_encoder(spark: SparkSession, train: DataFrame, numeric: Sequence[str], category: Sequence[str],
                         clips: Sequence[float], cutoff: int = 10) -> ClickEncoder:
    stats = features.fit_minmax(train, numeric, clips)
    vocab = features.written_vocab(train, category, cutoff).select("field", "value", "code")
    offsets = features.collect_offsets(features.vocab_offsets(spark, vocab, category))
    return ClickEncoder(list(numeric), list(category), stats, vocab, offsets)


def stream_fm_lines(stream: DataFrame, enc: ClickEncoder, label: str | None = None, key: str | None = None) -> DataFrame:
    """FM lines (``label`` optional, as for the unlabeled test file) of a streaming frame."""
    out = features.apply_minmax(stream, enc.stats, suffix="_s")
    for c in enc.category:
        v = enc.vocab.where(F.col("field") == c).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"{c}_code"))
        out = out.join(v, out[c].cast("string") == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
    idx = [(F.coalesce(F.col(f"{c}_code"), F.lit(0)) + F.lit(enc.offsets[c] + len(enc.numeric))).alias(f"{c}_idx")
           for c in enc.category]
    out = out.select(*([key] if key else []), *([label] if label else []), *[f"{c}_s" for c in enc.numeric], *idx)
    line = writers.fm_line([f"{c}_s" for c in enc.numeric], [f"{c}_idx" for c in enc.category], label)
    return out.select(*([key] if key else []), line.alias("value"))


def start_text_sink(lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the lines as text files; progress is tracked in ``checkpoint`` (shared storage)."""
    return (lines.select("value").writeStream.format("text").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append").start())
