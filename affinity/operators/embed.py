"""Embedding pooling over sparse ids.

The reference feeds TensorFlow: a padded id matrix is made sparse (non-zero positions), and
``embedding_lookup_sparse(..., combiner="sum")`` adds the embedding rows of each row's ids;
a second cell multiplies each numeric value by its field's embedding. Here a row's ids are
flat rows, so pooling is: count ids per (row, id) first (a hot id collapses to one row per
owner before any shuffle), join the embedding table on the id and sum every dimension of the whole vector in one
aggregate. The result is long (row, dim, value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 6
# Dimensions summed by one row of the aggregate; vectors are cut into blocks of so many.
BLOCK_DIMS = 8


def dense_to_sparse(df: DataFrame, row: str, vec: str) -> DataFrame:
    """(row, idx, value) of the non-zero entries of an array column, idx 0-based."""
    return df.select(row, F.posexplode(vec).alias("idx", "value")).where(F.col("value") != 0)


def bag_sum(ids: DataFrame, table: DataFrame, row: str = "user_id", id_col: str = "k",
            table_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """Sum of the embedding rows of each row's ids; id 0 is empty and dropped.

    Returns (row, dim, value) with value rounded to 6 places. Vectors are joined whole; one hash aggregate holds a sum per
    dimension (per block of ``BLOCK_DIMS`` dimensions of a longer vector), so what is shuffled is one row per owner and
    block, and the sums are unfolded at the end. Vectors may differ in length: a dimension that none of a row's vectors has
    is not in the result.
    """
    counts = ids.where(F.col(id_col).isNotNull() & (F.col(id_col) != 0)).groupBy(row, id_col).agg(
        F.count(F.lit(1)).alias("_n")
    )
    emb = table.select(F.col(table_id).alias(id_col), F.col(vec).alias("_e"))
    blocks = F.sequence(F.lit(0), F.floor((F.greatest(F.size("_e"), F.lit(1)) - 1) / BLOCK_DIMS).cast("int"))
    joined = counts.join(emb, id_col).select(row, "_n", "_e", F.explode(blocks).alias("_b"))
    entry = lambda i: F.get("_e", F.col("_b") * BLOCK_DIMS + i).cast("double") * F.col("_n")
    sums = joined.groupBy(row, "_b").agg(*[F.sum(entry(i)).alias(f"_s{i}") for i in range(BLOCK_DIMS)])
    unfolded = sums.select(row, "_b", F.posexplode(F.array(*[f"_s{i}" for i in range(BLOCK_DIMS)])).alias("_i", "_v"))
    return unfolded.where(F.col("_v").isNotNull()).select(
        row, (F.col("_b") * BLOCK_DIMS + F.col("_i")).alias("dim"), F.round("_v", DIGITS).alias("value"))


def value_weighted(values: DataFrame, table: DataFrame, row: str, field: str, value: str,
                   table_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """per (row, field) the field's embedding scaled by the field's value, no sum.

    ``values`` is long (row, field, value) with ``field`` the embedding row id; rows whose field has
    no embedding are left out. The result keeps the vector as an array, each entry rounded to 6 places.
    """
    emb = table.select(F.col(table_id).alias(field), F.col(vec).alias("_e"))
    # few fields meet a large table: only the vectors that some row uses enter the join
    used = emb.join(values.select(field).distinct(), field, "left_semi")
    return values.join(used, field).select(
        row, field, F.transform("_e", lambda x: F.round(x.cast("double") * F.col(value), DIGITS)).alias("weighted")
    )
