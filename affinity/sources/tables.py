"""Adapters from the driver's parquet tables to the input shapes of the reference.

The reference reads MovieLens-style ratings/tags CSVs and a click-log TSV. The test tables are a
TPC-H-like star schema, so each shape is derived from them (see FIXTURES.md section 2):

* ``interactions(user_id, item_id, rating, ts)`` - customer x part, rating = ceil(quantity/10)
* ``items(item_id, genres)``                     - part dimension
* ``tag_rows(user_id, item_id, tag)``            - customer x part x brand, duplicates kept
* ``logs(user_id, item_id)``                     - one row per lineitem, repeats kept
* ``clicks``                                     - labelled click rows, 4 numeric + 5 category
* ``event_ids(user_id, event_id, k, value)``     - sparse id per event (for embedding pooling)

Every adapter is a lazy plan; Catalyst prunes the parquet columns and pushes filters.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Numeric field names, category field names and the clip points of the clicks
# table (95 % quantiles measured at sf0.01, used as constants like the reference's clip list).
CLICK_NUMERIC = ["i1", "i2", "i3", "i4"]
CLICK_CATEGORY = ["c1", "c2", "c3", "c4", "c5"]
CLICK_CLIPS = [48, 99730, 475383, 48]
CLICK_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _lineitem_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    od = load(spark, sf_dir, "orders")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user, item): the highest rating and the latest time of that pair.

    Deduplicated on load, so a pair self-join can never meet the same (user, item) twice.
    """
    lo = _lineitem_orders(spark, sf_dir)
    return (
        lo.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(
            F.max(F.ceil(F.col("l_quantity") / 10)).cast("int").alias("rating"),
            F.max("o_orderdate").alias("ts"),
        )
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item dimension, all of it."""
    p = load(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("item_id"), F.col("p_type").alias("genres"))


def tag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _lineitem_orders(spark, sf_dir)
    p = load(spark, sf_dir, "part")
    return lo.join(p, lo.l_partkey == p.p_partkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), F.col("p_brand").alias("tag")
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User logs as flat rows, repeats kept (a list per user would put a heavy user's log in one row)."""
    lo = _lineitem_orders(spark, sf_dir)
    return lo.select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled click rows: label, i1..i4 (ints, two NULLs injected), c1..c5 (strings)."""
    def fl(x):
        return F.floor(x).cast("int")

    # made before the joins: whole numbers are dealt in fewer bytes than prices
    li = load(spark, sf_dir, "lineitem").select(
        *CLICK_KEY,
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.when(F.col("l_linenumber") != 7, fl(F.col("l_quantity"))).alias("i1"),
        fl(F.col("l_extendedprice")).alias("i2"),
    )
    od = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", fl(F.col("o_totalprice")).alias("i3"), F.col("o_orderpriority").alias("c4"))
    p = load(spark, sf_dir, "part").select("p_partkey", fl(F.col("p_size")).alias("i4"), "p_brand", "p_type", "p_name")
    c = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("c5"))
    # the customer goes to the order rows, which are fewer; the part, whose columns are the widest, comes last: line rows are dealt by customer no more
    od = od.join(c, od.o_custkey == c.c_custkey)
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(p, li.l_partkey == p.p_partkey)

    return j.select(
        F.concat_ws("-", *[F.col(k).cast("string") for k in CLICK_KEY]).alias("row_key"),
        "label", "i1", "i2", "i3", "i4",
        F.when(F.col("l_linenumber") != 6, F.col("p_brand")).alias("c1"),
        F.col("p_type").alias("c2"),
        F.col("p_name").alias("c3"),
        "c4", "c5",
    )


def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event the sparse id k (0 = empty) from the JSON props, with the event value."""
    e = load(spark, sf_dir, "events")
    return e.select(
        "user_id",
        "event_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "value",
    )


def embedding_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
