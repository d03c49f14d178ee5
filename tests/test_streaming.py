"""The fitted click transform applied to a file stream equals the batch transform."""

import tempfile

from pyspark.sql import functions as F

from affinity.operators import features
from affinity.sources import tables, writers
from affinity.streaming import fitted_click_encoder, stream_fm_lines

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="affinity-stream-")
    clicks = tables.clicks(spark, SF)
    enc = fitted_click_encoder(spark, clicks, tables.CLICK_NUMERIC, tables.CLICK_CATEGORY, tables.CLICK_CLIPS)
    clicks.write.parquet(d + "/in")
    stream = spark.readStream.schema(clicks.schema).parquet(d + "/in")
    lines = stream_fm_lines(stream, enc, label="label", key="row_key")
    q = lines.writeStream.format("memory").queryName("fm_stream").option("checkpointLocation", d + "/ck").start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r["row_key"], r["value"]) for r in spark.sql("SELECT * FROM fm_stream").collect())
    # batch form of the same transform (row keys may repeat: compare multisets)
    batch = stream_fm_lines(clicks, enc, label="label", key="row_key")
    want = sorted((r["row_key"], r["value"]) for r in batch.collect())
    assert got == want and len(got) == clicks.count()
