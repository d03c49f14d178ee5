"""Source and sink queries: CSV/TSV round trips, shards, text scans, head, random columns.

Each writes to a fresh folder under the session's checkpoint folder (``spark.checkpoint.dir``)
and returns what reading it back gives, so the check covers writer and reader together.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from affinity.functions.columns import hash_bucket
from affinity.operators import features, split
from affinity.plans import sql as S
from affinity.plans.clicks import CAT, _VALS, _encoded, _fm_sql, _with, _ENC
from affinity.plans.registry import query
from affinity.session import scratch_path
from affinity.sources import readers, tables, writers

INTER_SCHEMA = "user_id bigint, item_id bigint, rating int, ts timestamp_ntz"
CLICK_SCHEMA = ("row_key string, label int, i1 int, i2 int, i3 int, i4 int, "
                "c1 string, c2 string, c3 string, c4 string, c5 string")
CLICK_COLS = "row_key, label, i1, i2, i3, i4, c1, c2, c3, c4, c5"


def _path(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("src_csv_roundtrip", _with(S.INTER) + "SELECT user_id, item_id, rating, ts FROM interactions")
def q_src_csv_roundtrip(spark, sf):
    """Header CSV written, read back with the declared schema."""
    path = _path(spark, "ratings-csv")
    writers.write_csv(tables.interactions(spark, sf), path, header=True)
    return readers.read_csv(spark, path, schema=INTER_SCHEMA, header=True)


@query("src_csv_infer", _with(S.INTER) + """SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id,
       rating, ts FROM interactions""")
def q_src_csv_infer(spark, sf):
    """Header CSV read back with inferred types (ids fit in int, so they come back as int)."""
    path = _path(spark, "ratings-csv-infer")
    writers.write_csv(tables.interactions(spark, sf), path, header=True)
    return readers.read_csv(spark, path, header=True, infer=True)


@query("src_tsv_roundtrip", _with(S.CLICKS) + f"SELECT {CLICK_COLS} FROM clicks")
def q_src_tsv_roundtrip(spark, sf):
    """S3: headerless TSV by position, '' written for and read back as missing."""
    path = _path(spark, "clicks-tsv")
    writers.write_csv(tables.clicks(spark, sf), path, header=False, sep="\t", null_value="")
    return readers.read_tsv_positional(spark, path, CLICK_SCHEMA)


@query("sink_shards", _with(S.CLICKS) + f"SELECT {CLICK_COLS} FROM clicks")
def q_sink_shards(spark, sf):
    """4 CSV shards, each with its header, hash-partitioned on the row key."""
    path = _path(spark, "clicks-shards")
    writers.write_shards(tables.clicks(spark, sf), path, 4, header=True, key=["row_key"])
    return readers.read_csv(spark, path, schema=CLICK_SCHEMA, header=True)


# fields of a row after the damage: one lost, one too many, words for a number
_DAMAGED = f"""SELECT {CLICK_COLS}, {S.bucket('row_key', 50)} AS b FROM clicks"""


@query("src_tsv_rejects", _with(S.CLICKS) + f"""SELECT row_key, label, i2, c3, CASE b WHEN 0 THEN 'fields: 10 of 11' WHEN 1 THEN 'fields: 12 of 11'
       WHEN 2 THEN 'value: i3' END AS reason
FROM (SELECT row_key, CASE WHEN b > 2 THEN label END AS label, CASE WHEN b > 2 THEN i2 END AS i2, CASE WHEN b > 2 THEN c3 END AS c3, b
      FROM ({_DAMAGED}))""")
def q_src_tsv_rejects(spark, sf):
    """S3 with a reject channel: the clicks as lines, some damaged by their key's hash, read back as good rows and rejects."""
    path = _path(spark, "clicks-damaged")
    clicks = tables.clicks(spark, sf).select(*CLICK_COLS.split(", "))
    b = hash_bucket(["row_key"], 50)
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in clicks.columns}
    text["i3"] = F.when(b == 2, F.lit("many")).otherwise(text["i3"])
    line = F.concat_ws("\t", *text.values())
    short = F.concat_ws("\t", *list(text.values())[:-1])
    damaged = F.when(b == 0, short).when(b == 1, F.concat(line, F.lit("\textra"))).otherwise(line)
    writers.write_text(clicks.select(damaged.alias("line")), "line", path)
    good, rejects = readers.read_csv_checked(spark, path, CLICK_SCHEMA)
    lost = rejects.select(F.split("line", "\t").getItem(0).alias("row_key"), "reason")
    return good.select("row_key", "label", "i2", "c3").unionByName(lost, allowMissingColumns=True)


@query("sink_shards_consecutive", _with(S.INTER) + """SELECT user_id, item_id, rating, CAST(ntile(7) OVER (ORDER BY user_id, item_id) - 1 AS INTEGER) AS shard
FROM interactions""")
def q_sink_shards_consecutive(spark, sf):
    """7 consecutive files, each with its header, whose sizes differ by one row at most; the shard is the file's number."""
    path = _path(spark, "ratings-consecutive")
    inter = tables.interactions(spark, sf).select("user_id", "item_id", "rating")
    writers.write_consecutive_shards(inter, path, 7, ["user_id", "item_id"])
    back = readers.read_csv(spark, path, schema="user_id bigint, item_id bigint, rating int", header=True)
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    return back.select("user_id", "item_id", "rating", number.alias("shard"))


@query("sink_dump_columns", _with(S.INTER) + f"""SELECT i.user_id, i.item_id, i.ts, CASE WHEN i.rating >= 4 THEN 1 ELSE 0 END AS label, p.p_type AS genres,
       {S.bucket('user_id, item_id')} < 7 AS is_train
FROM interactions i LEFT JOIN part p ON p.p_partkey = i.item_id""")
def q_sink_dump_columns(spark, sf):
    """The selected columns of the training table, dumped as one table and as train and test, and read again."""
    inter = tables.interactions(spark, sf).select("*", features.threshold_label()).join(tables.items(spark, sf), "item_id", "left")
    cols = ["user_id", "item_id", "ts", "label", "genres"]
    whole = writers.dump_columns(inter, cols, _path(spark, "movies-data"))
    train, test = split.split_hash(whole, ["user_id", "item_id"])
    train, test = (writers.dump_columns(part, cols, _path(spark, name)) for part, name in ((train, "train-data"), (test, "test-data")))
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


@query("limit_head", _with(S.INTER) + "SELECT user_id, item_id, rating FROM interactions ORDER BY user_id, item_id LIMIT 5")
def q_limit_head(spark, sf):
    """A stable peek at the first rows."""
    inter = tables.interactions(spark, sf).select("user_id", "item_id", "rating")
    return readers.head(inter, ["user_id", "item_id"], 5)


@query("filter_prefix", _with(*_ENC) + f"SELECT line AS value FROM (SELECT {_fm_sql(chr(39) + ' ' + chr(39), True)} AS line FROM coded) WHERE line LIKE '1 %'")
def q_filter_prefix(spark, sf):
    """FM lines written as text, scanned back, lines of positive rows kept."""
    path = _path(spark, "fm-text")
    e = _encoded(spark, sf)
    writers.write_text(e.select(writers.fm_line(_VALS, [f"{c}_idx" for c in CAT], "label").alias("line")), "line", path)
    return readers.filter_prefix(readers.read_lines(spark, path), "1 ")


def _unit_sql(salt: int) -> str:
    key = " || '-' || ".join(f"CAST({k} AS VARCHAR)" for k in tables.CLICK_KEY)
    return f"CAST(CAST('0x' || substr(md5('2020-{salt}-' || {key}), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296"


@query("src_synthetic", f"""SELECT l_orderkey, l_linenumber, {_unit_sql(0)} AS u,
       round(sqrt(-2 * ln(1 - {_unit_sql(1)})) * cos(2 * pi() * {_unit_sql(2)}), 6) AS z FROM lineitem""")
def q_src_synthetic(spark, sf):
    """A uniform and a normal random column attached to every lineitem row, from a hash of its key."""
    li = tables.load(spark, sf, "lineitem").select(*tables.CLICK_KEY)
    out = readers.with_random_columns(li, tables.CLICK_KEY, 2020)
    return out.select("l_orderkey", "l_linenumber", "u", F.round("z", 6).alias("z"))
