"""Mixing sources to target weights by Poisson replication, in DataFrame expressions only.

A source with weight w of a mixture of T documents and n documents of its own has the
repetition rate ``T * w / n``. Each document draws its number of copies by inverting the
Poisson distribution of its source's rate at a number hashed from the seed, its id and its
text, is exploded by that count, and all copies are dealt out and sorted by a hashed key.

Nothing but the draw decides a document's copies, so partitions can be recomputed at any
time with the same result. The only aggregate is the count per source, combined before its
shuffle; the one large shuffle is the global one, dealt by the hashed key, so that a source
with a third of all rows is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import free_names

SEED = 10
#: A larger rate is split into equal parts of at most this, whose draws add up (sums of Poisson numbers are
#: Poisson): exp(-rate) stays far from underflow.
MAX_RATE = 400.0
#: The table of rates is broadcast up to this many sources; beyond, the join is left to Spark.
BROADCAST_SOURCES = 10_000


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / float(1 << 52)


def repetition_rates(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None,
                     source: str = "source") -> DataFrame:
    """(source, rate): mean copies per document. Without ``weights`` every source weighs the same (a null
    source is one); with them, sources that they lack weigh 0. ``total`` (default: the
    number of documents) is the expected size of the mixture."""
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        cases = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))])
        weight = F.coalesce(F.element_at(cases, F.col("source")), F.lit(0.0)) if weights else F.lit(0.0)
    weighed = counts.withColumn("weight", weight)
    sums = weighed.agg(F.sum("weight").alias("w"), F.sum("n").alias("n")).first()
    if not sums.w:
        return weighed.select("source", F.lit(0.0).alias("rate"))
    size = float(sums.n if total is None else total)
    return weighed.select("source", (F.lit(size) * F.col("weight") / F.lit(float(sums.w)) / F.col("n")).alias("rate"))


def poisson_table(rates: DataFrame) -> DataFrame:
    """``rates`` with ``parts`` and ``cdf``: P(X <= 0), P(X <= 1), ... for the rate of one part, to within double precision of 1."""
    parted = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_RATE).cast("int"))).withColumn(
        "part_rate", F.col("rate") / F.col("parts")
    )
    last = F.ceil(F.col("part_rate") + 12 * F.sqrt("part_rate") + 30).cast("int")

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * F.col("part_rate") / k
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"),
                        F.concat(acc["cdf"], F.array(acc["sum"] + term)).alias("cdf"))

    zero = F.exp(-F.col("part_rate"))
    first = F.struct(zero.alias("term"), zero.alias("sum"), F.array(zero).alias("cdf"))
    return parted.withColumn("cdf", F.aggregate(F.sequence(F.lit(1), last), first, step)["cdf"]).drop("part_rate")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None, seed: int = SEED,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixture: the columns of ``docs``, then ``copy`` (1, 2, ...) and ``shuffle_key`` (bigint), in shuffled order.

    Columns named copy or shuffle_key are replaced. Null sources form a source; null ids and
    texts hash like empty ones. Rows equal in id and text draw the same count. A document drawn
    0 times isn't in the result.
    """
    base = docs.drop("copy", "shuffle_key")
    of_source, law, key, draws, count = free_names(base, "of_source", "law", "text_key", "draws", "n_copies")
    rates = poisson_table(repetition_rates(docs, weights, total, source)).select(
        F.col("source").alias(of_source), F.struct("parts", "cdf").alias(law)
    )
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))))
    drawn = base.withColumn(key, digest).join(rates, F.col(source).eqNullSafe(F.col(of_source)))
    # the draws are a column, not part of the search: each is hashed once, not once for every entry of the table of probabilities
    uniform = F.transform(F.sequence(F.lit(1), F.col(law)["parts"]), lambda part: _uniform(F.lit(str(seed)), part.cast("string"), F.col(key)))
    counted = drawn.withColumn(draws, uniform).withColumn(count, F.aggregate(
        F.col(draws), F.lit(0), lambda acc, u: acc + F.size(F.filter(F.col(law)["cdf"], lambda c: c <= u))
    ))
    exploded = counted.where(F.col(count) > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(count))))
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), F.col("copy").cast("string"), key)), 1, 15), 16, 10)
    keyed = exploded.withColumn("shuffle_key", place.cast("bigint"))
    kept = keyed.select(*base.columns, "copy", "shuffle_key")
    # rebalance: dealt by the hashed key, and a key that very many equal rows share is split
    return kept.hint("rebalance", "shuffle_key").sortWithinPartitions("shuffle_key", "copy")
