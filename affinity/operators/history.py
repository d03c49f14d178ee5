"""Keyed histories, norms, popularity, group filters.

The reference keeps ``user -> [(item, rating), ...]`` lists (combineByKey / groupByKey /
reduceByKey on lists). A list per key would put a heavy user's whole history in one row and
one task, so ``histories`` numbers a key's entries in the order of their ids and cuts them into
chunks of ``chunk`` entries: (key, chunk, [(id, rating), ...]). All chunks of a key but its last are
full; concatenated in chunk order they are its sorted history. The numbering is range-partitioned,
so a heavy key is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators.ranking import global_rank
from affinity.session import materialize

HISTORY_CHUNK = 1024


def histories(ratings: DataFrame, key: str, member: str, rating: str = "rating",
              chunk: int = HISTORY_CHUNK) -> DataFrame:
    """A1-A5: (key, chunk, history) with history = sorted array<struct<member, rating>>."""
    rows = global_rank(ratings.select(key, member, rating), [F.col(member), F.col(rating)], by=[key], name="_pos")
    c = F.floor((F.col("_pos") - 1) / F.lit(chunk)).cast("bigint")
    return rows.groupBy(key, c.alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(member), F.col(rating)))).alias("history")
    )


def history_text(history: str = "history", member: str = "item_id", rating: str = "rating") -> F.Column:
    """'id:rating id:rating ...' of a history array (the dump form)."""
    return F.array_join(
        F.transform(F.col(history), lambda s: F.concat(s[member].cast("string"), F.lit(":"), s[rating].cast("string"))),
        " ",
    )


def user_history(ratings: DataFrame, chunk: int = HISTORY_CHUNK) -> DataFrame:
    return histories(ratings, "user_id", "item_id", chunk=chunk)


def item_history(ratings: DataFrame, chunk: int = HISTORY_CHUNK) -> DataFrame:
    return histories(ratings, "item_id", "user_id", chunk=chunk)


def dump(histories: DataFrame, name: str) -> DataFrame:
    """Write histories as parquet under the checkpoint folder and return the reread rows."""
    return materialize(histories, name)


def distinct_users(ratings: DataFrame) -> DataFrame:
    """A4: the set of users."""
    return ratings.select("user_id").distinct()


def n_unique(df: DataFrame, col: str) -> DataFrame:
    """Distinct count of a column, one row."""
    return df.agg(F.countDistinct(col).alias(f"n_{col}"))


def keep_multi_member_groups(ratings: DataFrame, group: str, min_members: int = 2) -> DataFrame:
    """P10: rows whose group has at least ``min_members`` rows (reference: more than one).

    Group sizes are an aggregate semi-joined back, not a window over each group.
    """
    sizes = ratings.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_members)
    return ratings.join(sizes.select(group), group, "left_semi")
