"""Dense 1-based ranks over a whole table without sorting it in one task.

``row_number() over (order by ...)`` with no partition (or with a partition that holds one
field's entire vocabulary) moves every row to a single task. Here the rows are range
partitioned on the ordering, sorted inside each partition, numbered locally with
``monotonically_increasing_id`` (partition index in the upper bits, position in the lower),
and shifted by the row counts of the earlier partitions of the same group. The offset table
has one row per (partition, group) that actually occurs: at most partitions + groups rows. A group
that spans several partitions stays split between them. Rows with a null in ``by`` are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.session import cut_lineage


def global_rank(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Attach ``name`` = row_number() over (partition by ``by`` order by ``order``).

    ``order`` must make rows unique inside a group for the result to be deterministic.
    """
    by_cols = [F.col(c) for c in by]
    keys = by_cols + list(order)
    # without a number Spark sizes the partitions at run time; neighbors are merged, so order holds
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *keys).sortWithinPartitions(*keys)
    numbered = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    # The numbering is read twice below (counts, then the join). A recomputation could resample
    # the range bounds, so it is written once to the reliable checkpoint folder first.
    numbered = cut_lineage(numbered)
    stats = numbered.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_pc"), F.min("_mid").alias("_pm"))
    w = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_pc").over(w), F.lit(0)))
    # one row per (partition, group): Spark broadcasts it where it is small at run time
    out = numbered.join(stats.select("_pid", *by, "_pm", "_off"), ["_pid", *by])
    rank = (F.col("_off") + (F.col("_mid") - F.col("_pm")) + 1).cast("bigint")
    return out.withColumn(name, rank).drop("_pid", "_mid", "_pm", "_off")
