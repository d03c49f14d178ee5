"""Writer -> reader round trips in a scratch folder."""

import tempfile

from pyspark.sql import functions as F

from affinity.sources import readers, writers


def test_tsv_missing_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="affinity-rt-")
    df = spark.createDataFrame([(1, None, "x"), (0, 5, None)], "label int, i1 int, c1 string")
    writers.write_csv(df, d + "/t", header=False, sep="\t", null_value="")
    back = readers.read_tsv_positional(spark, d + "/t", "label int, i1 int, c1 string")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_shards_have_headers(spark):
    d = tempfile.mkdtemp(prefix="affinity-rt-")
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    writers.write_shards(df, d + "/s", 3, header=True, key=["k"])
    import glob
    files = glob.glob(d + "/s/part-*.csv")
    assert len(files) == 3
    assert all(open(f).readline().strip() == "k,v" for f in files)
    assert readers.read_csv(spark, d + "/s", schema="k long, v long").count() == 100


def test_ordered_shards_keep_the_order(spark):
    d = tempfile.mkdtemp(prefix="affinity-rt-")
    df = spark.range(300).select((F.col("id") * 7919 % 300).alias("k"))
    writers.write_shards(df, d + "/s", 3, ordered_by=["k"])
    import glob
    shards = [open(f).read().split() for f in sorted(glob.glob(d + "/s/part-*.csv"))]
    assert len(shards) == 3 and all(s[0] == "k" for s in shards)
    assert [int(v) for s in shards for v in s[1:]] == list(range(300))


def test_user_history_reads_its_dump(spark):
    from affinity.operators import history
    from affinity.plans import QUERIES
    from affinity.sources import tables

    sf = "/root/testdata/sf0.001"
    query = QUERIES["agg_user_history"](spark, sf)
    files = query.inputFiles()
    assert files and all("/user-history-" in f for f in files)
    back = spark.read.parquet(files[0].rsplit("/", 1)[0])
    fresh = history.user_history(tables.interactions(spark, sf))
    assert [t for _, t in back.dtypes] == [t for _, t in fresh.dtypes]
    assert sorted(back.collect()) == sorted(fresh.collect())
    text = history.history_text("history", "item_id").alias("history")
    assert sorted(query.collect()) == sorted(fresh.select("user_id", "chunk", text).collect())
