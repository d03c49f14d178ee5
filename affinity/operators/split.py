"""Reproducible splits and samples.

The reference splits with seeded RNGs of Python, numpy, scikit-learn and Spark RDDs, which no
other engine can reproduce. Every rule here is a function of an md5 hash of the row key, so the
same rows land on the same side in Spark and in the SQL oracle, and a recomputed partition
(after an executor loss) gives the same split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.columns import hash_bucket, hash_u32
from affinity.session import materialize

# Positional cuts rank by the 32-bit hash; its top bits give 2^16 histogram buckets.
HIST_SHIFT = 16


def split_hash(df: DataFrame, key: Sequence[str], train_buckets: int = 7, buckets: int = 10):
    """(train, test) with bucket < train_buckets in train; 70/30 by default."""
    b = hash_bucket(key, buckets)
    return df.where(b < train_buckets), df.where(b >= train_buckets)


def with_split_flag(df: DataFrame, key: Sequence[str], train_buckets: int = 7, buckets: int = 10,
                    name: str = "is_train") -> DataFrame:
    return df.withColumn(name, hash_bucket(key, buckets) < train_buckets)


def sample_hash(df: DataFrame, key: Sequence[str], fraction: float, buckets: int = 1000) -> DataFrame:
    """Bernoulli-like sample without replacement of about ``fraction`` of the rows."""
    return df.where(hash_bucket(key, buckets) < int(round(fraction * buckets)))


def split_90_10(df: DataFrame, key: Sequence[str], name: str = "is_train") -> DataFrame:
    """T4: ``bucket % 10 != 0`` goes to train (90 %), the rest to validation."""
    return df.withColumn(name, hash_bucket(key, 10) != 0)


def first_n_by_hash(df: DataFrame, key: Sequence[str], n, by: Sequence[str] = (), name: str = "is_first") -> DataFrame:
    """Flag the first ``n`` rows of each ``by`` group in (hash, key) order.

    Equivalent to ``row_number() over (partition by <by> order by hash, key) <= n`` without sorting
    a group in one task. Two histograms find where a group's cut falls: one of the hash's top 16
    bits, then one of the hashes inside the boundary bucket (each at most 65,536 rows a group). Only
    the rows that share the boundary hash are ranked (about group / 2^32 rows), which gives one
    (hash, key) per group; all rows are flagged by comparing with it, in one pass without a shuffle.
    ``n`` is an int or a column over ``by`` and the group size ``_cnt``. Keys are not
    null; rows that share the key at the cut stay together.
    """
    by = list(by)
    rows = df.withColumn("_h", hash_u32(key)).withColumn("_hb", F.shiftright("_h", HIST_SHIFT))
    rows = materialize(rows, "hashed-rows")  # read by each level and by the final pass
    n_col = n if not isinstance(n, int) else F.lit(n)

    hist = rows.groupBy(*by, "_hb").agg(F.count(F.lit(1)).alias("_c"))
    hist = hist.withColumn("_cnt", F.sum("_c").over(Window.partitionBy(*by))).withColumn("_left", n_col.cast("bigint"))
    bucket = _boundary(hist, by, "_hb")
    inside = _same(rows, bucket, [*by, "_hb"])
    level2 = inside.groupBy(*by, "_h", "_left").agg(F.count(F.lit(1)).alias("_c"))
    exact = _boundary(level2, by, "_h")
    last = _same(rows, exact, [*by, "_h"])
    place = Window.partitionBy(*by).orderBy(*key)
    at = F.struct("_h", *key)
    cut = last.withColumn("_rk", F.row_number().over(place)).where(F.col("_rk") == F.col("_left")).select(
        *by, at.alias("_cut"))
    if by:
        match = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in by]
        flagged = rows.alias("r").join(cut.alias("c"), match, "left").select("r.*", "_cut")
    else:
        flagged = rows.join(F.broadcast(cut), how="left")  # one row: the cut
    return flagged.withColumn(name, F.coalesce(at <= F.col("_cut"), F.lit(False))).drop("_h", "_hb", "_cut")


def _boundary(hist: DataFrame, by: list, bucket: str) -> DataFrame:
    """(by, bucket, _left): the last bucket of each group that starts before ``_left`` rows are taken,
    and how many of its rows still belong to them. ``hist`` has (by, bucket, _c, _left)."""
    upto = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = hist.withColumn("_before", F.coalesce(F.sum("_c").over(upto), F.lit(0)))
    started = before.where(F.col("_before") < F.col("_left"))
    return started.groupBy(*by).agg(
        F.max_by(F.struct(F.col(bucket), F.least(F.col("_left") - F.col("_before"), F.col("_c")).alias("_left")),
                 F.col(bucket)).alias("_b")).select(*by, f"_b.{bucket}", "_b._left")


def _same(rows: DataFrame, groups: DataFrame, cols: list) -> DataFrame:
    """Rows whose ``cols`` equal (nulls too) a row of ``groups``, with its ``_left``."""
    match = [F.col(f"r.{c}").eqNullSafe(F.col(f"g.{c}")) for c in cols]
    return rows.alias("r").join(groups.alias("g"), match).select("r.*", "g._left")


def split_positional(df: DataFrame, key: Sequence[str], n_train: int, name: str = "is_train") -> DataFrame:
    """Shuffle by hash, the first ``n_train`` rows are train (reference: 3,500)."""
    return first_n_by_hash(df, key, n_train, name=name)


def split_stratified(df: DataFrame, key: Sequence[str], label: str, test_fraction: float = 0.3,
                     name: str = "is_train") -> DataFrame:
    """T5: per label stratum, n - ceil(test_fraction * n) rows (in hash order) are train."""
    n_train = F.col("_cnt") - F.ceil(F.col("_cnt") * F.lit(test_fraction))
    return first_n_by_hash(df, key, n_train, by=[label], name=name)
