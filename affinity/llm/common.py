"""Column expressions and small plan helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import materialize

#: The white space that separates words, as a Java character class body: space and TAB..CR.
WORD_SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(n)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores added until ``df`` has no column of it (however it is capitalised)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, label): one row per labelled document. Null ids and null labels are left out and
    repeated rows count once; a document labelled both ways takes 1."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col(name).cast("int")).alias("label"))
    )


def bounded_ids(labelled: DataFrame, per_label: int, seed: int) -> DataFrame:
    """At most ``per_label`` documents of each label value, chosen by a hash of the id.

    Ranks by a window over the label would sort a label's rows in one task; a global
    ``orderBy().limit()`` per label keeps ``per_label`` rows per map task instead.
    """
    order = F.xxhash64(F.lit(seed), "doc_id")
    parts = [
        labelled.where(F.col("label") == v).orderBy(order, "doc_id").limit(per_label) for v in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


__all__ = ["WORD_SPACE", "bounded_ids", "fold", "free_names", "materialize", "one_label", "table", "text_or_empty"]
